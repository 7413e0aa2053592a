"""Operators on texts against brute force on a small corpus."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tallyhouse.llm import bpe, jaccard, langid, lm, packing, quality, shards, substring, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df):
    return {row[0]: tuple(row)[1:] for row in df.collect()}


def test_bpe_is_the_library_and_decodes(docs, corpus, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    ids = by_id(found)
    assert ids == {i: (library.encode_ordinary(t or ""),) for i, t in corpus}
    assert by_id(bpe.decode(found, RANKS)) == {i: ((t or "").encode(),) for i, t in corpus}
    digests = by_id(bpe.digests(docs, RANKS, public_tokenizers.PATTERN))
    for i, t in corpus:
        text = " ".join(map(str, ids[i][0])).encode()
        assert digests[i] == (len(ids[i][0]), hashlib.sha256(text).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def components_by_force(corpus, size, least):
    sets = {}
    for i, t in corpus:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("size", "least"), [(4, 85), (5, 80), (3, 50)])
def test_jaccard_is_brute_force(docs, corpus, size, least):
    assert by_id(jaccard.joined(docs, size, least)) == components_by_force(corpus, size, least)


def test_jaccard_odd_rows(spark, empty):
    assert jaccard.joined(empty).count() == 0
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "other words are here now"), (3, "Other words ARE here now"), (7, "a b c d e")]
    found = sorted(map(tuple, jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert found == sorted([(None, 2, 7), (7, 2, 7), (7, 2, 7), (7, 2, 3), (3, 2, 3)], key=repr)


def test_trees_keep_every_pair_that_may_link():
    draw, measure = np.random.default_rng(3), jaccard.Measure(4, 85)
    base = draw.integers(0, 1 << 62, 120, dtype=np.uint64)
    sets = []
    for _ in range(150):
        own = np.concatenate([base[draw.random(120) > 0.06], draw.integers(0, 1 << 62, draw.integers(0, 12), dtype=np.uint64)])
        sets.append(np.unique(own if draw.random() < 0.6 else draw.integers(0, 1 << 62, 120, dtype=np.uint64)))
    sizes = np.array([len(s) for s in sets])
    bits = np.stack([b if len(b := jaccard.bitmap(s)) == 16 else np.zeros(16, np.uint64) for s in sets])
    own = np.flatnonzero(bits.any(1))
    tree = jaccard.Tree(bits[own], sizes[own], np.arange(len(own)))
    pairs = {(own[a], own[b]) for i, j in jaccard.traversed(tree, tree, measure) for a, b in zip(i, j, strict=True)}
    linked = {(a, b) for n, a in enumerate(own) for b in own[n + 1:]
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert linked and linked <= pairs and len(pairs) < len(own) * (len(own) - 1) // 2


def near_copies(size, count):
    """Texts of as many words: every second one a near copy of the one before, and all with one passage of 24 words."""
    draw, passage, found = np.random.default_rng(size), [f"p{k}" for k in range(24)], []
    for n in range(count):
        if n % 2 == 0:
            own = [f"w{x}" for x in draw.integers(0, 1 << 40, size)] + passage
        else:
            own = [w if draw.random() > 0.012 else f"e{draw.integers(0, 1 << 40)}" for w in own]
        found.append((1000 * size + n, " ".join(own)))
    return found


def test_jaccard_of_sets_that_must_share_several_keys(spark):
    rows = [row for size in (5, 70, 200, 900) for row in near_copies(size, 8)]
    found = by_id(jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == components_by_force(rows, 4, 85)
    assert len({component for _, component in found.values()}) < len(rows)


def test_linked_sets_share_the_keys_they_must():
    draw = np.random.default_rng(5)
    for least in (1, 50, 80, 85, 100):
        measure = jaccard.Measure(4, least)
        for _ in range(300):
            whole = np.unique(draw.integers(0, 1 << 62, draw.integers(1, 700), dtype=np.uint64))
            x, y = (whole[draw.random(len(whole)) > draw.random() * 0.2] for _ in "ab")
            if len(x) and len(y) and len(np.intersect1d(x, y)) and measure.linked(x, y):
                met = np.intersect1d(x[:measure.prefix(len(x))], y[:measure.prefix(len(y))])
                assert len(met) >= measure.shared(len(x), len(y))


def test_a_shared_line_makes_no_pair_and_signatures_are_small(spark):
    rows = near_copies(900, 8)
    measure = jaccard.Measure(4, 85)
    texts = jaccard.id_text(spark.createDataFrame(rows, "doc_id long, text string"))
    met = jaccard._met(jaccard._keys(texts, measure, np.empty(0, np.uint64)), measure)
    assert met.filter(met.kind == jaccard.PAIR).select("a", "b").distinct().count() > 4
    assert jaccard._pairs(met).count() == 4
    for shingles, bits in jaccard._named(met).select("n", "bits").collect():
        assert 8 * len(bits) < 4 * shingles


def test_only_needed_texts_travel(spark):
    rows = spark.createDataFrame([(n, f"text {n}") for n in range(2000)] + [(None, "none")], "id long, text string")
    needed = spark.createDataFrame([(n, n) for n in (0, 7, 1999)], "id long, class long")
    found = {row[0] for row in jaccard._about(rows, needed).collect()}
    assert {None, 0, 7, 1999} <= found and len(found) < 50


def removed_by_force(corpus, size):
    seen, found = set(), {}
    for i, t in sorted(corpus):
        w, gone = words(t), set()
        for k in range(len(w) - size + 1):
            window = tuple(w[k:k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone).encode()
        found[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return found


@pytest.mark.parametrize("size", [20, 6])
def test_substring_is_brute_force(docs, corpus, empty, size):
    assert by_id(substring.digests(docs, size)) == removed_by_force(corpus, size)
    spans = by_id(substring.removed(docs, size))
    for i, (n, gone, parts, _) in spans.items():
        assert gone == sum(p["end"] - p["first"] for p in parts) <= n
    assert substring.digests(empty, size).count() == 0


def test_quality_counts_and_verdicts(docs, corpus, empty):
    found = by_id(quality.verdicts(docs))
    for i, t in corpus:
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        repeated = {k + d for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for d in range(3)}
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        assert found[i][:6] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
                                len(lines) - len(set(lines)), len(repeated), failed)
        assert not (failed and found[i][6])
    assert quality.verdicts(empty).count() == 0
    kept = quality.filtered(docs)
    assert kept.columns == docs.columns and {r[0] for r in kept.collect()} == {i for i, v in found.items() if v[6]}


def test_quality_lines():
    rules = quality.Rules()
    prose = " ".join(f"Word{i} is here." for i in range(60))
    menu = " | ".join(f"item{i}" for i in range(40))
    assert quality.judge(prose.encode(), rules)[6]
    assert not quality.judge((prose[:200] + "\n" + menu * 3).encode(), rules)[6]
    text = quality.judge((prose + "\n" + menu + "\nWe use a cookie here").encode(), rules)
    assert text[6] and text[7] == prose


def test_quality_texts_are_cleaned(spark, docs):
    prose = " ".join(f"Word{i} is here." for i in range(60))
    menu = " | ".join(f"item{i}" for i in range(40))
    rows = [(1, prose + "\n" + menu + "\nWe use a cookie here", 0), (2, prose + "\n\n", 0), (3, menu, 0), (4, None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    found = corpus_pipeline.good(spark, frame, "")
    assert found.columns == frame.columns and by_id(found) == {1: (prose, len(prose)), 2: (prose + "\n\n", len(prose) + 2)}
    judged = by_id(quality.judged(docs))
    want = {i: v[-1] for i, v in judged.items() if v[-2]}
    assert {r["doc_id"]: r["text"] for r in quality.cleaned(docs).collect()} == want


def test_sharding_is_exact(docs, corpus, empty):
    found = shards.shuffled(docs, 16).collect()
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in corpus)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert shards.shuffled(empty, 16).count() == 0
    matrix = shards.exact_counts([5, 0, 9, 3], 4, 1)
    assert matrix.sum(1).tolist() == [5, 0, 9, 3] and set(matrix.sum(0)) <= {4, 5}


def test_sharding_of_a_billion_rows():
    rows = [400_000_000, 7, 0, 900_000_000, 500_000_001]
    matrix = shards.exact_counts(rows, 16, 1)
    assert matrix.sum(1).tolist() == rows and set(matrix.sum(0)) == {sum(rows) // 16, sum(rows) // 16 + 1}
    draw = np.random.default_rng(8)
    seen = Counter()
    for _ in range(20_000):
        matrix = shards.dealt_counts([3, 1, 2], np.array([3, 3]), draw)
        assert matrix.sum(1).tolist() == [3, 1, 2] and matrix.sum(0).tolist() == [3, 3]
        seen[tuple(matrix[:, 0])] += 1
    for (a, b, c), n in seen.items():
        assert n / 20_000 == pytest.approx(math.comb(3, a) * math.comb(1, b) * math.comb(2, c) / 20, abs=0.015)


def test_packing(docs, corpus, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    found = packing.packed(packing.pieces(docs, path, room=256), room=256).collect()
    want = []
    for i, t in corpus:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, s, len(ids[s:s + 256]), zlib.crc32(np.array(ids[s:s + 256], "<u4").tobytes()))
                 for k, s in enumerate(range(0, len(ids), 256))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    bound = packing.lower_bound(np.array([w[3] for w in want]), 256)
    assert bound <= len(bins) <= bound + 1
    assert packing.packed(packing.pieces(empty, path)).count() == 0


def test_packing_reads_added_tokens_as_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["one <|endoftext|> two", "a<|startoftext|>b\n<|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "x<|endoftext|><|endoftext|>'s"]
    found = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert want[0] == [637, 49407, 1237, 1]
    assert sorted((r["doc_id"], r["length"], r["ids_crc32"]) for r in found) == [
        (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(want)]


def test_packing_rounds_keep_tasks_small(spark, monkeypatch):
    rounds = []

    def stored(df, purpose, write=packing.stored):
        df = write(df, purpose)
        rounds.extend([df] if purpose.startswith("packed-") else [])
        return df
    monkeypatch.setattr(packing, "stored", stored)
    monkeypatch.setattr(packing, "TASK_PIECES", 50)
    cut = spark.range(2000).selectExpr("id doc_id", "0 piece", "0L start", "35L length", "id ids_crc32")
    found = packing.packed(cut, room=100).collect()
    assert max(r["count"] for df in rounds for r in df.groupBy("part").count().collect()) < 150 and len(rounds) < 6
    bins = Counter(r["sequence_id"] for r in found)
    assert sorted(r["doc_id"] for r in found) == list(range(2000)) and len(bins) == 1000
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 2000 and {r["offset"] for r in found} == {0, 35}


@pytest.mark.parametrize("seed", range(5))
def test_bound_and_best_fit(seed):
    lengths = np.random.default_rng(seed).integers(1, 100, 40)
    bins, offsets, fill = packing.best_fit(lengths, 100)
    assert packing.lower_bound(lengths, 100) <= len(fill) and fill.max() <= 100 and fill.sum() == lengths.sum()
    assert (np.bincount(bins, lengths) == fill).all() and (offsets + lengths <= 100).all()


def code_length(sample, text):
    """Bits of ``text`` by the definition, byte by byte."""
    counts = Counter()
    for t in sample:
        x = b"\n\n\n" + t
        counts.update(x[k - 3 + n:k + 1] for k in range(3, len(x)) for n in range(4))
    alphabet = [bytes([b]) for b in range(256)]

    def bits(context, symbol):
        own = {a: counts[context + a] for a in alphabet if counts[context + a]}
        total = sum(own.values())
        if len(context) == 3 and total < langid.LEAST_CONTEXT:
            own, total = {}, 0
        if symbol in own:
            return -math.log2(own[symbol] / (total + len(own)))
        shorter = bits(context[1:], symbol) if context else 8.0
        return shorter - (math.log2(len(own) / (total + len(own))) if own else 0)
    x = b"\n\n\n" + text
    return sum(bits(x[k - 3:k], x[k:k + 1]) for k in range(3, len(x)))


def test_code_lengths_are_exact():
    sample = [b"the cat sat on the mat. the cat", b"that hat is the cat's hat", "é ü".encode()]
    model = langid.CodeLengths({"x": langid.packed(*np.unique(np.concatenate([langid._runs(t) for t in sample]), return_counts=True))})
    texts = [b"the cat", b"", b"zebra \xc3\xa9", b"t"]
    assert model.of(texts)[:, 0] == pytest.approx([code_length(sample, t) for t in texts], rel=1e-5)


def test_languages(spark, docs, empty):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house of the king and the queen", "en"), ("das haus und die katze der frau", "de")] * 20)]
    models = langid.learn(spark.createDataFrame([*rows, (99, None, "en"), (98, "x", None)], "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "the queen"), (2, "die frau und das"), (3, None), (4, "12 34 !"), (5, "")], "doc_id long, text string")
    found = by_id(langid.identified(asked, models))
    assert [found[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= score <= 1 for _, score in found.values())
    assert langid.identified(docs, models).count() == docs.count()
    assert langid.identified(empty, models).count() == 0
    assert {r[1] for r in langid.identified(docs, {}).collect()} == {"und"}


def segmentations(word, pieces, spell):
    if not word:
        return [0.0]
    found = [spell(word[0]) + rest for rest in segmentations(word[1:], pieces, spell)]
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            found += [pieces[word[:n]] + rest for rest in segmentations(word[n:], pieces, spell)]
    return found


def test_lattices_are_all_segmentations():
    path = public_tokenizers.path("piece_bpe_32k.model")
    vocab, model = lm.vocabulary(path), sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(n): vocab.start[n] for n in range(model.get_piece_size()) if np.isfinite(vocab.start[n]) and not model.is_byte(n)}

    def spell(letter):
        return sum(vocab.start[vocab.bytes[b]] for b in letter.encode())
    some = [b"house", "é☃x".encode(), b"a", "größe".encode()]
    want = [np.logaddexp.reduce(segmentations("▁" + w.decode(), pieces, spell)) for w in some]
    assert lm.word_scores(some, vocab, vocab.start) == pytest.approx(want)
    lattice = lm.Lattices(["▁house", "▁mouse"], vocab)
    expected = lattice.expected(vocab.start, np.array([2.0, 1.0]))
    lengths = np.array([len(model.id_to_piece(n)) if not model.is_byte(n) else 0 for n in range(len(expected))])
    letters = expected[vocab.bytes]
    assert (expected * lengths).sum() + letters[:128].sum() + letters[128:].sum() / 3 == pytest.approx(18)  # the mark has three bytes


def test_lm_base_scores(docs, corpus, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")

    def learned(i):
        return i is None or i % 3 != 0
    found, counts, documents = by_id(lm.scored(docs, path, learned)), Counter(), 0
    low = {i: [w.lower() for w in (t or "").encode().split()] for i, t in corpus}
    for i, w in low.items():
        if learned(i):
            counts.update(w)
            documents += 1
    total, kinds = sum(counts.values()) + documents, len(counts) + 1
    for i, w in low.items():
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((documents + 1) / (total + kinds + 1))
        assert found[i][:3] == (len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total)
        assert found[i][3] == pytest.approx(base) and found[i][4] < 0
    assert lm.scored(empty, path, learned).count() == 0


def test_toxic_grammar(spark, docs, empty):
    grammar = toxicity.Grammar({"fool": 4.0}, {"vermi": 3.0}, {"bome": 2.0})
    weights = {"fool": 4.0}
    plain = toxicity.clause_score("he met a fool".split(), {"fool": 4.0})
    assert toxicity.clause_score("a fool".split(), weights) < plain
    assert toxicity.clause_score("you are not a fool".split(), weights) < plain
    assert toxicity.clause_score("she said fool".split(), weights) < plain
    assert grammar.evidence("vermin here. all fine")[0] == 3.0
    assert grammar.evidence("bomexa here")[0] == 0.0 and grammar.evidence("bomexa bomexu")[0] == 4.0
    texts = [(i, f"some good words number {i} here" + (" you fool" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(120)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    learned = toxicity.learn(rows.drop("toxic"), rows.select("doc_id", "toxic"))
    found = by_id(toxicity.scored(rows, learned))
    assert "fool" in learned.words and all((found[i][0] >= 0.5) == bool(y) for i, _, y in texts)
    assert {r[0] for r in toxicity.filtered(rows, learned).collect()} == {i for i, _, y in texts if not y}
    assert all(0 <= score < 0.5 for (score,) in by_id(toxicity.scored(docs, learned)).values())
    assert toxicity.scored(empty, learned).count() == 0
    nothing = toxicity.learn(rows.drop("toxic"), rows.select("doc_id", "toxic").limit(0))
    assert all(score < 0.5 for (score,) in by_id(toxicity.scored(rows, nothing)).values())


def test_packing_ids_are_the_library_s(spark):
    """Plain words with marks about them, and every form that must not be taken for one."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["(Word) word, WORD*** --word-- \"word\" _a_ `x` {y}", "it's 'Tis don't'll 'a' x's", "Éá İstanbul ÀÉ ÿ ß ǅ éa",
             "3a a3 12 \x02 ª º µ × a×b á", "<|endoftext|>a, b<|endoftext|> <| |> <|a|>", "@u\tv\rw,\nx  y", "", "  "]
    for known in (packing.WordIds(path), packing._word_ids(path)):
        for text in [*texts, *texts]:
            words = text.replace("\n", " ").split(" ")
            known.learn(set(words))
            assert b"".join(map(known.__getitem__, words)) == np.array(
                tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
