"""Periodic runs of words, as maximal pairs of the LCP-interval tree of a text.

A run of period q and length n is the maximal pair (s, s+q) with a common stretch of
n-q words: the words left of both places differ, and so do those right of the common
stretches. So the suffix tree's intervals are built bottom-up from the LCP array; a node
holds the places of its suffixes with the word left of each as their class, children of
different right words are merged, and the pairs of different class whose distance fits
the stretch are the runs. Nothing is extended. Of one node's places only neighbours in
the text are paired: a stretch of at least two periods cannot recur nearer than its
smallest period, so neighbours give that period and no multiple of it.

Only nodes of MIN_SHARED words or more can hold a pair; documents in which no stretch
of so many words recurs, by hashes that all equal stretches share, have no run and get
no tree. A text's tree is in memory while its document is worked on, some 200 bytes a word.

Null and empty texts have no words and no run. A null id has no checksum, so such a
document's words stay as they are. Rows that share an id are documents of their own,
an empty table gives an empty result, and other columns do not take part.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.common import Numbered, batches_of, id_text, mixed, rows_of, window_hashes

#: Words of the shortest run, and how many periods a run has at least.
MIN_WORDS, MIN_PERIODS = 24, 3

#: Words that the two places of a run have in common at least: the run less one period.
MIN_SHARED = MIN_WORDS - MIN_WORDS // MIN_PERIODS

#: Bytes of text whose documents are searched for recurring stretches at once.
CHUNK_BYTES = 4 << 20

Run = tuple[int, int, int]


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of a text's word numbers, and the words that each suffix shares
    with the one before it in the array (0 for the first): by doubling the length by
    which suffixes are ranked, and going down through these ranks again."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    ranks, size = [rank.astype(np.int32)], 1
    while size < n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:n - size] = rank[size:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank.astype(np.int32))
        size *= 2
    order = np.argsort(rank, kind="stable")
    one, other, shared = order[:-1], order[1:], np.zeros(max(n - 1, 0), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = one + shared, other + shared
        inside = np.maximum(a, b) + (1 << level) <= n
        same = inside & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
        shared += same.astype(np.int64) << level
    return order, np.concatenate([[0], shared])[:n]


def runs_of(codes: np.ndarray) -> list[Run]:
    """(start, length, period) of every run, by start and period."""
    order, shared = suffixes(codes)
    word, n = codes.tolist(), len(codes)
    found: list[Run] = []

    def pair(left: int, right: int, common: int) -> None:
        period = right - left
        if ((MIN_PERIODS - 1) * period <= common and common + period >= MIN_WORDS
                and (left == 0 or word[left - 1] != word[right - 1])
                and (right + common == n or word[left + common] != word[right + common])):
            found.append((left, common + period, period))

    def merged(common: int, children: list[list[int]]) -> list[int]:
        """The places of a node in order of the text: its smaller children go into the largest."""
        children.sort(key=len)
        places = children.pop()
        new = children[0] if len(children) == 1 else sorted(x for child in children for x in child)
        if len(new) * 16 > len(places):
            places = sorted(places + new)
        else:
            for x in new:
                places.insert(bisect_left(places, x), x)
        last = -1
        for x in new:
            at = bisect_left(places, x)
            if at and places[at - 1] != last:
                pair(places[at - 1], x, common)
            if at + 1 < len(places):
                pair(x, places[at + 1], common)
            last = x
        return places

    deep = shared >= MIN_SHARED
    heads = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]]))
    tails = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]])) + 1
    for head, tail in zip(heads.tolist(), tails.tolist(), strict=True):
        place, common = order[head - 1:tail].tolist(), shared[head:tail].tolist()
        nodes: list[tuple[int, list[list[int]]]] = []
        done = [place[0]]
        for x, depth in zip(place[1:], common, strict=True):
            while nodes and nodes[-1][0] > depth:
                above, children = nodes.pop()
                children.append(done)
                done = merged(above, children)
            if nodes and nodes[-1][0] == depth:
                nodes[-1][1].append(done)
            else:
                nodes.append((depth, [done]))
            done = [x]
        while nodes:
            above, children = nodes.pop()
            children.append(done)
            done = merged(above, children)
    return sorted(found)


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length by period, then smallest start, then period."""
    best = None
    for run in runs:  # by start and period, so an equal one never replaces an earlier one
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, those of every tenth checksum turned periodic from a place on."""
    if doc_id is None or not words:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    n, seed = len(words), checksum // 10
    start = seed % n
    period = 1 + (n - start) // (3 + seed % 8)
    times = -(-(n - start) // period)
    return words[:start] + (words[start:start + period] * times)[:n - start]


def _recurring(codes: list[np.ndarray]) -> list[bool]:
    """Which of the texts may hold a stretch of MIN_SHARED words twice (none that does is missed)."""
    lengths = np.fromiter(map(len, codes), np.int64, len(codes))
    flat = np.concatenate(codes).astype(np.uint64)
    hashes = window_hashes(mixed(flat + np.uint64(1)), MIN_SHARED)
    text = np.repeat(np.arange(len(codes), dtype=np.uint64), lengths)
    whole = text[:len(hashes)] == text[len(flat) - len(hashes):]
    keys = np.sort((text[:len(hashes)][whole] << np.uint64(40)) | (hashes[whole] >> np.uint64(24)))
    may = np.zeros(len(codes), bool)
    may[(keys[1:][keys[1:] == keys[:-1]] >> np.uint64(40)).astype(np.int64)] = True
    return may.tolist()


def searched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare=None) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) of every document: all its runs as (start, length,
    period), and its words without the later periods of runs, joined by one space.
    ``prepare`` may change the words of a document, given them and its id."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("kept_text", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, words, runs in _documents(rows_of(batches, "id", "text"), prepare):
            yield (doc_id, len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
                   b" ".join(kept(words, runs)))

    return id_text(docs, id_col, text_col).mapInArrow(
        lambda batches: batches_of(rows(batches), schema),
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text binary")


def kept(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run covers after its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def _documents(rows: Iterator[tuple], prepare) -> Iterator[tuple[int | None, list[bytes], list[Run]]]:
    def worked(held: list[tuple]) -> Iterator[tuple]:
        numbers = Numbered()
        codes = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for _, words in held]
        for (doc_id, words), own, may in zip(held, codes, _recurring(codes) if held else [], strict=True):
            yield doc_id, words, runs_of(own) if may else []

    held, size = [], 0
    for doc_id, text in rows:
        words = text.split()
        held.append((doc_id, words if prepare is None else prepare(words, doc_id)))
        size += len(text)
        if size >= CHUNK_BYTES:
            yield from worked(held)
            held, size = [], 0
    yield from worked(held)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the strongest run, and digests of all runs and of
    the words kept, after :func:`repeated`."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    schema = pa.schema([*[(n, pa.int64()) for n in names], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, words, runs in _documents(rows_of(batches, "id", "text"), repeated):
            best = strongest(runs)
            top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            yield (doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(),
                   hashlib.sha256(b" ".join(kept(words, runs))).hexdigest())

    return id_text(docs).mapInArrow(lambda batches: batches_of(rows(batches), schema),
                                    ", ".join(f"{n} long" for n in names) + ", runs_sha256 string, collapsed_sha256 string")
