"""Language-model scores by the marginal likelihood of subword lattices.

Words are segmented in every way that an existing subword vocabulary allows; the
weights of the pieces make each segmentation's probability, and the forward recursion
in log space adds them all up. The vocabulary's own scores (it ranks its pieces) start
the weights, as a Zipf law; one expectation step over all distinct training words, each
once, re-estimates them, since pieces have to spell what training never saw whole. Every
training word is an arc of its own across its lattice, weighted by its count, and the
pieces share what Witten and Bell's estimate leaves to new words: with ``c`` of ``n``
training words and ``v`` distinct ones, ``c / (n + v) + v / (n + v) * lattice``. A text is
its words, each followed by the decision to go on, and its end.

Every distinct word of the corpus is counted and scored once, in the partition its hash
names (:mod:`exchange`). The driver sees one number per vocabulary piece.

Null and empty texts are the end alone. Without training rows no token is known and the
weights are the vocabulary's alone. Rows that repeat are scored each by itself; an empty table
gives an empty result; other columns do not take part.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import exchange
from tallyhouse.llm.common import batches_of, id_text, packed, rows_of, stored, words_lower

#: Added to ranks in the Zipf law that the vocabulary's scores stand for.
RANK_SHIFT = 2.7

#: Counts that the vocabulary's law is worth beside the training words, for each piece.
PRIOR = 1.0

#: Letters of words whose lattices are worked on together.
BATCH_CELLS = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hash(points: np.ndarray) -> np.uint64:
    value = np.uint64(0)
    for point in points:
        value = value * _BASE + np.uint64(point) + np.uint64(1)
    return value


class Vocabulary:
    """Pieces by length and hash, their starting weights, and the pieces of single bytes."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        rank = np.full(n, float(n))
        by_length: dict[int, list[tuple[int, int]]] = {}
        self.bytes = np.full(256, -1, np.int64)
        usable = np.zeros(n, bool)
        with np.errstate(over="ignore"):
            for number in range(n):
                piece = model.id_to_piece(number)
                if model.is_byte(number):
                    self.bytes[int(piece[3:5], 16)] = number
                    usable[number] = True
                elif not (model.is_unknown(number) or model.is_control(number)) and model.get_score(number) > -1e8:
                    rank[number] = -model.get_score(number)
                    points = np.array([ord(c) for c in piece], np.uint64)
                    by_length.setdefault(len(piece), []).append((int(_hash(points)), number))
                    usable[number] = True
        weight = np.where(usable, 1 / (rank + RANK_SHIFT), 0.0)
        with np.errstate(divide="ignore"):
            self.start = np.log(weight / weight.sum())
        self.tables = {length: (np.array([h for h, _ in sorted(rows)], np.uint64), np.array([i for _, i in sorted(rows)]))
                       for length, rows in by_length.items()}
        self.longest = max(by_length)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """All segmentations of words of one length: arcs by their first letter."""

    def __init__(self, words: list[str], vocab: Vocabulary) -> None:
        self.vocab, self.length = vocab, len(words[0])
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        with np.errstate(over="ignore"):
            for first in range(self.length):
                value = np.zeros(len(words), np.uint64)
                for size in range(1, min(vocab.longest, self.length - first) + 1):
                    value = value * _BASE + self.points[:, first + size - 1] + np.uint64(1)
                    if size in vocab.tables:
                        hashes, numbers = vocab.tables[size]
                        at = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
                        rows = np.flatnonzero(hashes[at] == value)
                        if len(rows):
                            self.arcs.append((first, size, rows, numbers[at[rows]]))
        kinds, where = np.unique(self.points, return_inverse=True)
        self.kinds, self.where = [chr(k).encode("utf-8", "surrogatepass") for k in kinds], where.reshape(self.points.shape)

    def _letters(self, weights: np.ndarray) -> np.ndarray:
        """Weight of each letter spelled in bytes."""
        spelled = np.array([weights[self.vocab.bytes[list(k)]].sum() for k in self.kinds])
        return spelled[self.where]

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log probability of reaching each place, all segmentations added up."""
        reached = np.full((len(self.points), self.length + 1), -np.inf)
        reached[:, 0] = 0
        letters, arcs = self._letters(weights), iter([*self.arcs, (self.length, 0, None, None)])
        arc = next(arcs)
        for first in range(self.length):
            reached[:, first + 1] = np.logaddexp(reached[:, first + 1], reached[:, first] + letters[:, first])
            while arc[0] == first:
                _, size, rows, numbers = arc
                reached[rows, first + size] = np.logaddexp(reached[rows, first + size], reached[rows, first] + weights[numbers])
                arc = next(arcs)
        return reached

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is used in ``counts`` copies of the words, on average."""
        before, after = self.forward(weights), np.full((len(self.points), self.length + 1), -np.inf)
        after[:, -1] = 0
        letters, arcs = self._letters(weights), list(self.arcs)
        for first in range(self.length - 1, -1, -1):
            after[:, first] = letters[:, first] + after[:, first + 1]
            while arcs and arcs[-1][0] == first:
                _, size, rows, numbers = arcs.pop()
                after[rows, first] = np.logaddexp(after[rows, first], weights[numbers] + after[rows, first + size])
        total, found = before[:, -1], np.zeros(len(weights))
        for first, size, rows, numbers in self.arcs:
            share = np.exp(before[rows, first] + weights[numbers] + after[rows, first + size] - total[rows])
            found += np.bincount(numbers, share * counts[rows], len(weights))
        spelled = np.exp(before[:, :-1] + letters + after[:, 1:] - total[:, None]) * counts[:, None]
        for kind, share in zip(self.kinds, np.bincount(self.where.ravel(), spelled.ravel(), len(self.kinds)), strict=True):
            np.add.at(found, self.vocab.bytes[list(kind)], share)
        return found


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Words with the mark of a word's start, in groups of one length and bounded size."""
    marked = ["▁" + word.decode() for word in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        length = lengths[order[at]]
        stop = min(np.searchsorted(lengths[order], length, "right"), at + max(1, BATCH_CELLS // int(length)))
        yield order[at:stop], [marked[i] for i in order[at:stop].tolist()]
        at = int(stop)


def word_scores(words: list[bytes], vocab: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    scores = np.zeros(len(words))
    for members, group in _by_length(words):
        scores[members] = Lattices(group, vocab).forward(weights)[:, -1]
    return scores


@dataclasses.dataclass(frozen=True)
class Statistics:
    """What training gathers: documents, tokens and distinct tokens (the end included), and the weights."""

    documents: int
    tokens: int
    distinct: int
    weights: np.ndarray


def _totals(packs: Iterator[bytes], counts: Counter) -> None:
    for payload in packs:
        words, often = exchange.words_in(payload)
        for word, n in zip(words, often.tolist(), strict=True):
            counts[word] += n


def trained(cut: DataFrame, documents: int, vocab_path: str) -> Statistics:
    """Statistics of the counted words of ``cut`` (see :func:`exchange.cut`)."""
    schema = pa.schema([("piece", pa.int64()), ("amount", pa.float64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        _totals((payload for (payload,) in rows_of(batches, "payload")), counts)
        known = [(w, n) for w, n in counts.items() if n]
        vocab = vocabulary(vocab_path)
        expected = np.zeros(len(vocab.start))
        for _, group in _by_length([w for w, _ in known]):
            expected += Lattices(group, vocab).expected(vocab.start, np.ones(len(group)))
        used = np.flatnonzero(expected)
        rows = [(-1, float(sum(n for _, n in known))), (-2, float(len(known))), *zip(used.tolist(), expected[used].tolist(), strict=True)]
        yield from batches_of(iter(rows), schema)

    words = cut.filter(F.col("kind") == exchange.WORDS).repartition("part").select("payload")
    sums = {r["piece"]: r["amount"] for r in words.mapInArrow(tally, "piece long, amount double")
            .groupBy("piece").agg(F.sum("amount").alias("amount")).collect()}  # one row per vocabulary piece
    vocab = vocabulary(vocab_path)
    expected = np.zeros(len(vocab.start))
    for piece, amount in sums.items():
        if piece >= 0:
            expected[piece] = amount
    prior = np.exp(vocab.start) * PRIOR * len(expected)
    with np.errstate(divide="ignore"):
        weights = np.log((expected + prior) / (expected + prior).sum())
    return Statistics(documents, int(sums.get(-1, 0)) + documents, int(sums.get(-2, 0)) + (documents > 0), weights)


def scored(docs: DataFrame, vocab_path: str, learned: Callable[[int | None], bool], id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every text.

    ``learned`` tells by the id which documents train. ``base_score`` adds up add-one
    unigram log10 probabilities, ``score`` is the model's log10 probability.
    """
    rows = id_text(docs, id_col, text_col)
    cut = stored(exchange.cut(rows, words_lower, learned), "lm-words")
    ids = pa.schema([("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([sum(map(learned, batch.column(0).to_pylist()))], pa.int64())], schema=ids)

    documents = rows.select("id").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    found = trained(cut, documents, vocab_path)
    shared = docs.sparkSession.sparkContext.broadcast(found.weights)  # one number per vocabulary piece
    ending = (found.documents + 1) / (found.tokens + 2)
    go_on, stop = math.log10(1 - ending), math.log10(ending)
    base = math.log10(found.tokens + found.distinct + 1)
    n_words, n_kinds = found.tokens - found.documents, found.distinct - (found.documents > 0)

    def answer(packs: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        held, counts = list(packs), Counter()
        _totals((payload for _, payload in held), counts)
        words = list(counts)
        places = dict(zip(words, range(len(words)), strict=True))
        often = np.fromiter(counts.values(), np.int64, len(words))
        scores = word_scores(words, vocabulary(vocab_path), shared.value)
        if n_words:
            with np.errstate(divide="ignore"):  # a word that was never seen has no arc
                whole = np.log(often / (n_words + n_kinds))
            scores = np.logaddexp(whole, scores + math.log(n_kinds / (n_words + n_kinds)))
        scores /= math.log(10)
        for key, payload in held:
            at = np.fromiter(map(places.__getitem__, exchange.words_in(payload)[0]), np.int64)
            yield key, packed(often[at], scores[at])

    def finish(ids, lengths, codes, answers) -> Iterator[tuple]:
        n = sum(len(members) for members, _ in answers)
        often, scores = np.zeros(n, np.int64), np.zeros(n)
        for members, (counts, values) in answers:
            often[members], scores[members] = counts, values
        known, ends = (often > 0).astype(np.int64), np.cumsum(lengths, dtype=np.int64)
        logs = np.log10(often + 1.0) - base
        for doc_id, stop_at, length in zip(ids, ends.tolist(), lengths.tolist(), strict=True):
            own = codes[stop_at - length:stop_at]
            yield (doc_id, length + 1, int(known[own].sum()) + (found.documents > 0), found.tokens,
                   float(logs[own].sum()) + math.log10(found.documents + 1) - base,
                   float(scores[own].sum()) + length * go_on + stop)

    schema = [("doc_id", "long"), ("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"),
              ("base_score", "double"), ("score", "double")]
    arrow = pa.schema([(name, pa.int64() if kind == "long" else pa.float64()) for name, kind in schema])
    return exchange.assembled(exchange.answered(cut, answer), finish, ", ".join(f"{n} {k}" for n, k in schema), arrow)
