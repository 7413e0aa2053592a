"""Periodic runs, fingerprints and hard negatives against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints, negatives, queries, runs


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- runs ------------------------------------------------------------------

def runs_by_force(w):
    found, n = [], len(w)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if w[at] != w[at + q]:
                at += 1
                continue
            start = at
            while at + q < n and w[at] == w[at + q]:
                at += 1
            length = at + q - start
            part = w[start:start + length]
            smaller = any(part[p:] == part[:-p] for p in range(1, q))
            if length >= max(24, 3 * q) and not smaller:
                found.append((start, length, q))
    return sorted(found)


def digest_by_force(doc_id, text):
    w = words(text)
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_force(w)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (len(found), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_runs_are_brute_force(letters):
    draw, seen = random.Random(letters), 0
    for _ in range(150):
        n = draw.randint(1, 130)
        w = [draw.randrange(letters) for _ in range(n)]
        for _ in range(draw.randint(0, 4)):
            a, b = sorted(draw.sample(range(n + 1), 2))
            p = draw.randint(1, max(1, (b - a) // 2))
            w[a:b] = [w[a + (i - a) % p] for i in range(a, b)]
        found = runs.runs_of(np.array(w))
        assert found == runs_by_force(w)
        seen += len(found)
    assert seen


def test_runs_of_long_texts():
    assert runs.runs_of(np.ones(100_000, np.int64)) == [(0, 100_000, 1)]
    assert runs.runs_of(np.arange(90_000) % 30_000) == [(0, 90_000, 30_000)]
    line = [x for i in range(3000) for x in (*range(20), 100 + i)]
    assert runs.runs_of(np.array(line)) == [], "lines that recur with other words between them are no run"


def test_run_digests(spark, docs, corpus, empty):
    extra = [(1000 + i, " ".join(["a b c d e f"] * i)) for i in range(200)] + [
        (2000, "x " * 30 + "y " + "x " * 30), (2001, "a b " * 12), (2002, "a b " * 11)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = {r[0]: tuple(r)[1:] for r in runs.digests(table).collect()}
    want = {i: digest_by_force(i, t) for i, t in [*corpus, *extra]}
    assert found == want and sum(v[0] > 0 for v in want.values()) > 100
    assert runs.digests(empty).count() == 0
    odd = spark.createDataFrame([(None, "a " * 40), (None, None), (7, "b " * 24), (7, "b " * 23)], "doc_id long, text string")
    got = sorted((tuple(r)[:5] for r in runs.digests(odd).collect()), key=repr)
    assert got[-2:] == [(None, 0, None, None, None), (None, 1, 0, 40, 1)]
    assert sorted(r[1] for r in got if r[0] == 7) == [0, 1]
    spans = {r["doc_id"]: r for r in runs.searched(table).collect()}
    assert [tuple(r) for r in spans[2000]["runs"]] == [(0, 30, 1), (31, 30, 1)] and spans[2000]["kept_text"] == b"x y x"


# --- fingerprints ----------------------------------------------------------

def quartiles_by_force(text):
    counts = [0] * fingerprints.BUCKETS
    for i in range(len(text) - 2):
        x = (text[i] | text[i + 1] << 8 | text[i + 2] << 16) * 0x9E3779B1 % (1 << 32)
        counts[(x ^ x >> 15) * 0x85EBCA77 % (1 << 32) >> 23] += 1
    ordered = sorted(counts)
    cuts = [ordered[len(counts) * k // 4 - 1] for k in (1, 2, 3)]
    return [sum(c > cut for cut in cuts) for c in counts]


def test_fingerprints_are_brute_force(docs, corpus, empty, monkeypatch):
    found = {r["doc_id"]: r for r in fingerprints.fingerprinted(docs).collect()}
    order = sorted(corpus)
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        row = found[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        for name, value in (("fingerprint", text), ("edited_fingerprint", changed)):
            digest, length = fingerprints.read(row[name])
            assert digest.tolist() == quartiles_by_force(value.encode())
            assert length == round(np.log2(len(value.encode()) + 1) * 8)
        near = [fingerprints.read(x) for x in (row["fingerprint"], row["edited_fingerprint"], found[order[(at + 1) % len(order)][0]]["fingerprint"])]
        for name, other in (("near_edited", near[1]), ("near_next", near[2])):
            steps = np.abs(near[0][0] - other[0]).sum() / 512 + abs(near[0][1] - other[1]) * 0.05 / 8
            assert row[name] == pytest.approx(1 - min(1, steps / 1.5)) and 0 <= row[name] <= 1
    prose = [found[i] for i, t in corpus if len(words(t)) > 40]
    assert np.mean([r["near_edited"] for r in prose]) > np.mean([r["near_next"] for r in prose])
    assert fingerprints.fingerprinted(empty).count() == 0


def test_counts_in_slices_are_the_same(monkeypatch):
    texts = [b"", b"ab", b"abc" * 50, bytes(range(256)) * 3, b"z"]
    want = fingerprints.bucket_counts(texts)
    monkeypatch.setattr(fingerprints, "CHUNK_BYTES", 7)
    assert (fingerprints.bucket_counts(texts) == want).all() and want.sum() == 148 + 766


def test_neighbours_of_odd_rows(spark):
    def edits(rows):
        found = fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        return sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_next"]) for r in found)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()
    assert edits([(5, "alone")]) == [(5, 5, sha("alo" + "al"), 1.0)]
    assert [r[2] for r in edits([(1, "abcd"), (2, None), (3, "wxyz")])] == [sha("ab"), sha(""), sha("wxab")]
    copies = edits([(4, "same text")] * 40 + [(9, "öther ✓")])
    assert [r[2] for r in copies].count(sha("same same")) == 39 and copies[-1][2] == sha("öthesam")
    nulls = fingerprints.fingerprinted(spark.createDataFrame([(None, "last"), (3, "first")], "doc_id long, text string"))
    assert {r["doc_id"]: r["edited_sha256"] for r in nulls.collect()} == {3: sha("fir" + "la"), None: sha("lafi")}


# --- hard negatives --------------------------------------------------------

def mined_by_force(rows):
    kept = [(i, label, np.floor(256 * np.array(v, np.float64))) for i, label, v in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, v) for i, label, v in kept]
    found = []
    for n, (a, label, v) in enumerate(kept):
        if a is None or a % 50:
            continue
        scored = sorted(((-int(v @ w), (1 << 63) if i is None else i, i, other) for m, (i, other, w) in enumerate(kept)
                         if m != n and len(w) == len(v)), key=lambda x: x[:2])
        for p, _, i, _ in [x for x in scored if x[3] == label][:5]:
            hard = [x for x in scored if x[3] != label and 50 * -p <= 100 * -x[0] <= 95 * -p][:3]
            found += [(a, i, rank, x[2], -p, -x[0]) for rank, x in enumerate(hard, 1)]
    return sorted(found, key=repr)


def clustered(draw, n, width=8, labels=10):
    centers = draw.normal(size=(n // 20 + 1, width))
    out = []
    for i in range(n):
        label = 3 if i % 3 == 0 else int(draw.integers(0, labels))  # a third of all rows has one label
        out.append((i, label, (centers[draw.integers(0, len(centers))] + draw.normal(size=width) * draw.choice([0.0, 0.1, 0.6])).tolist()))
    return out


SCHEMA = "vec_id long, label int, embedding array<double>, row long, shard string, slot int"


def mined(spark, rows):
    table = spark.createDataFrame([(i, label, v, 1, "x", 2) for i, label, v in rows], SCHEMA).repartition(3)
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return sorted((tuple(r) for r in negatives.mined(table, vec_id % 50 == 0, moved).collect()), key=repr)


@pytest.mark.parametrize(("shard", "block"), [(8192, 2048), (100, 3)])
def test_negatives_are_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    rows = clustered(np.random.default_rng(4), 900)
    rows += [(50, 3, rows[0][2]), (None, 3, rows[100][2]), (None, 4, rows[100][2]), (7, None, [1.0] * 8), (50, 1, None),
             (100, 1, [None] + [1.0] * 7), (100, 2, [float("nan")] * 8), (150, 2, [float("inf")] * 8), (150, 2, [0.0] * 8),
             (200, 2, []), (250, 2, [1.0, 2.0]), (251, 2, [1.0, 2.0]), (252, 5, [0.9, 1.2]), (300, 2, [1.0, 2.0])]
    want = mined_by_force(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_negatives_of_an_empty_table(spark):
    assert mined(spark, []) == []


def test_cover_trees_find_every_window():
    draw = np.random.default_rng(2)
    rows = clustered(draw, 3000, width=16)
    vectors = np.floor(256 * np.array([v for _, _, v in rows])).astype(np.int64)
    labels = np.array([label for _, label, _ in rows])
    ids = np.arange(3000)
    tree = negatives.Cover.unpack(negatives.Cover.build(vectors, ids, ids + 10_000, labels).pack())
    assert tree.roots == len(set(labels.tolist())) and len(tree.count) > 100
    for node in range(len(tree.count)):  # every member lies within the node's radius of its center
        if not tree.count[node]:
            own = tree.vectors[tree.start[node]:tree.stop[node]].astype(float)
            middle = tree.center[node].astype(float)
            extra = [np.sqrt(np.maximum(tree.norm ** 2 - (x ** 2).sum(-1), 0)) for x in (own, middle)]
            assert np.sqrt(((own - middle) ** 2).sum(1) + (extra[0] - extra[1]) ** 2).max() <= tree.radius[node] + 1e-3
    asked = draw.choice(3000, 40, replace=False)
    of = np.repeat(np.arange(40), 2)
    low = draw.integers(-(1 << 18), 1 << 17, 80)
    high = low + draw.integers(0, 1 << 18, 80)
    for same in (True, False):
        q, m, score = tree.search(vectors[asked], labels[asked], of, low, high, 4, same, asked + 10_000)
        exact = vectors[asked] @ vectors.T
        for i in range(80):
            a = asked[of[i]]
            fits = [(-int(s), int(j)) for j, s in enumerate(exact[of[i]])
                    if low[i] <= s <= high[i] and (labels[j] == labels[a]) == same and not (same and j == a)]
            assert sorted(fits)[:4] == list(zip((-score[q == i]).tolist(), tree.ids[m[q == i]].tolist(), strict=True))


def test_scores_beyond_doubles_are_exact():
    big = np.array([[(1 << 26) - 1] * 4, [-(1 << 26) + 1] * 4, [(1 << 26) - 2] * 4], np.int64)
    assert (negatives._exact(big, big) == big @ big.T).all()


def test_registered_queries_have_their_columns(spark, sf_dir):
    want = {
        "op11_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        "op12_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        "op13_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, columns in want.items():
        found = queries.QUERIES[name](spark, sf_dir)
        assert found.columns == columns
        assert name == "op13_negatives" or found.count() == docs
