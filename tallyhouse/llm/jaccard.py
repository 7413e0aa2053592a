"""Exact n-gram Jaccard join by signature trees.

A document is the set of its word shingles; equal sets are one class. Two sets of
sufficient similarity share a shingle among the first few of each in one common order
(shingles common in a sample come last), so classes meet under those keys, packed by
chunk and partition. Sets of like size share many of their keys if they link, so that one
common line makes no pair. The classes under one key are the leaves of a signature tree:
nodes hold the OR of their members' token bitmaps and the range of their sizes, and a
dual traversal drops node pairs whose greatest possible overlap is too small.

Under a key with few classes every pair is a pair of leaves. Larger keys go in two
steps, so that a group of thousands of near copies never makes all its pairs: first
neighbours by size are verified and connected, then trees are traversed only between
classes that are not connected yet. All candidate pairs are verified on whole sets.
Signatures travel with every pair and key, so they are a few bits a shingle; of the
texts only those travel that a pair still needs.

Documents without words have empty sets and link with nothing. Rows that repeat are one
class; a component's id is its smallest document id (null only if all its ids are
null). An empty table gives an empty result; columns other than id and text do not
take part. Classes are told apart by 64-bit hashes of sets.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import (WordHashes, batches_of, from_planes, id_text, joined_words, mixed, packed, planes, rows_of,
                                   shuffle_partitions, split_words, stored, unpacked, window_hashes, words_lower)
from tallyhouse.llm.graph import components

#: Classes under one key up to which all their pairs are leaves of one node.
LEAF = 8

#: Shingles of the members of a key that one block holds, 8 bytes each; larger keys are
#: cut into blocks, which meet in pairs.
BLOCK_SHINGLES = 1 << 19

#: Bits a shingle of the signatures that travel, at least.
SIGN_BITS = 2

#: Places that the ids of needed texts are hashed to, 64 a row: at most 131,072 rows are broadcast. Texts of other places stay where they are.
NEEDED_PLACES = 1 << 23

#: Documents that common shingles are found in. The sample only orders shingles: any order gives the same links.
SAMPLE_DOCS, COMMON = 5000, 5

#: Bytes of text that are cut into shingles together, and slices whose keys are packed together.
SLICE_BYTES, PACKED_SLICES = 2 << 20, 8


@dataclasses.dataclass(frozen=True)
class Measure:
    """Words to a shingle, and the least similarity in hundredths."""

    words: int = 4
    least: int = 85

    def shingles(self, texts: list[bytes], hashes: WordHashes) -> list[np.ndarray]:
        """Sorted hashes of the distinct shingles of each text; a shorter text is one shingle."""
        words = [words_lower(text) for text in texts]
        every = [hashes.of(w) for w in words]
        windows = window_hashes(np.concatenate(every), self.words) if every else np.empty(0, np.uint64)
        found, at = [], 0
        for own in every:
            if len(own) < self.words:
                found.append(window_hashes(own, len(own)) if len(own) else own)
            else:
                found.append(np.unique(windows[at:at + len(own) - self.words + 1]))
            at += len(own)
        return found

    def prefix(self, size: int) -> int:
        return size - -(-self.least * size // 100) + 1

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least number of keys that linked sets of these sizes share. Of the set whose last key comes first
        in the common order, the shingles up to there that are in the other are among the other's keys."""
        left, right = (-(-self.least * n // 100) - 1 for n in (a, b))  # shingles behind the keys
        return np.maximum(1, self.needed(a, b) - np.maximum(left, right))

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of linked sets of these sizes."""
        return -(-self.least * (a + b) // (100 + self.least))

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the sizes alone allow a link."""
        return 100 * np.minimum(a, b) >= self.least * np.maximum(a, b)

    def linked(self, x: np.ndarray, y: np.ndarray) -> bool:
        """Whether two sets, sorted and not empty, are similar enough."""
        same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return 100 * same >= self.least * (len(x) + len(y) - same)


def class_of(shingles: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes(), len(shingles))).view(np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, a bounded amount of text at a time."""
    ids, texts, size = [], [], 0
    for doc_id, text in rows_of(batches, "id", "text"):
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def common_shingles(rows: DataFrame, measure: Measure) -> np.ndarray:
    """Shingles met in COMMON or more of about SAMPLE_DOCS documents, sorted."""
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])
    rate = min(1.0, SAMPLE_DOCS / max(1, rows.count()))
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < rate * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for _, texts in _slices(batches):
            values, counts = np.unique(np.concatenate(measure.shingles(texts, hashes)), return_counts=True)
            yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], schema=schema)
    counted = sample.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counted.filter(F.col("n") >= COMMON).select("shingle").toArrow()["shingle"].to_numpy()
    return np.sort(found.view(np.uint64))


_PACKS = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
PAIR, CELL, NAMES, KEYS = 0, 1, 2, 3


def _keys(rows: DataFrame, measure: Measure, common: np.ndarray) -> DataFrame:
    """(part, kind, payload), packed by chunk: keys in order, with the class and size of each
    (KEYS), and the rows with their classes and the bitmaps of these (NAMES)."""
    parts = shuffle_partitions(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(common)  # at most the shingles of the sample over COMMON

    def pack(keys: list[np.ndarray], owners: list[int], sizes: list[int]) -> Iterator[tuple]:
        numbers = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = mixed(np.concatenate(keys))
        order = np.argsort(flat, kind="stable")
        flat, numbers = flat[order], numbers[order]
        edges = [0, *np.searchsorted(flat, np.array([-(-(p << 64) // parts) for p in range(1, parts)], np.uint64)).tolist(), len(flat)]
        for part in range(parts):
            if edges[part] < edges[part + 1]:
                own, where = np.unique(numbers[edges[part]:edges[part + 1]], return_inverse=True)
                steps = np.diff(flat[edges[part]:edges[part + 1]] >> np.uint64(16), prepend=np.uint64(0))
                yield part, KEYS, packed(planes(steps & np.uint64(0xFFFFFFFF)), planes(steps >> np.uint64(32)), planes(where),
                                         np.array(owners, np.int64)[own], np.array(sizes, np.uint32)[own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, often, task = WordHashes(), shared.value, TaskContext.get().partitionId()

        def out() -> Iterator[tuple]:
            keys, owners, sizes, met = [], [], [], set()
            for number, (ids, texts) in enumerate(_slices(batches), 1):
                names, bits = [], []
                for own in measure.shingles(texts, hashes):
                    names.append(name := class_of(own))
                    bits.append(b"")
                    if len(own) and name not in met:
                        met.add(name)
                        bits[-1] = bitmap(own, SIGN_BITS).tobytes()
                        last = np.zeros(len(own), bool)
                        if len(often):
                            last = often[np.minimum(np.searchsorted(often, own), len(often) - 1)] == own
                        keys.append(np.concatenate([own[~last], own[last]])[:measure.prefix(len(own))])
                        owners.append(name)
                        sizes.append(len(own))
                    names[-1] = (name, len(own))
                known = np.array([x is not None for x in ids], np.uint8)
                widths, body = joined_words(bits)
                yield (task * 7919 + number) % parts, NAMES, packed(
                    np.array([x or 0 for x in ids], np.int64), known, np.array([n for n, _ in names], np.int64),
                    np.array([n for _, n in names], np.uint32), widths, body)
                if number % PACKED_SLICES == 0 and keys:
                    yield from pack(keys, owners, sizes)
                    keys, owners, sizes, met = [], [], [], set()
            if keys:
                yield from pack(keys, owners, sizes)
        yield from batches_of(out(), _PACKS)
    return rows.mapInArrow(run, "part int, kind int, payload binary")


def _named(met: DataFrame) -> DataFrame:
    """(id, class, n, bits) of every row; the bitmap is with one row of a class at least."""
    schema = pa.schema([("id", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (payload,) in rows_of(batches, "payload"):
                ids, known, names, sizes, widths, body = unpacked(payload)
                for i, k, name, n, bits in zip(ids.tolist(), known.tolist(), names.tolist(), sizes.tolist(), split_words(widths, body), strict=True):
                    yield i if k else None, name, n, bits or None
        yield from batches_of(out(), schema)
    return met.filter(F.col("kind") == NAMES).select("payload").mapInArrow(run, "id long, class long, n long, bits binary")


_MET = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("need", pa.int64()),
                  ("payload", pa.binary())])


def _met(keys: DataFrame, measure: Measure) -> DataFrame:
    """Pairs (PAIR: classes a, b, the keys they share here and must share in all), members of large keys
    (CELL: cell a, class b), and NAMES as they came. Pairs that meet only under large keys are all in their cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        at = None
        for part, kind, payload in rows_of(batches, "part", "kind", "payload"):
            if kind == NAMES:
                yield pa.record_batch([pa.array([x], f.type) for x, f in zip((NAMES, None, None, None, None, payload), _MET, strict=True)], schema=_MET)
                continue
            if part != at and held:
                yield from _meeting(held, measure)
                held = []
            at = part
            held.append(payload)
        if held:
            yield from _meeting(held, measure)
    return (keys.repartition("part").sortWithinPartitions("part")
            .mapInArrow(run, "kind int, a long, b long, shared long, need long, payload binary"))


def _meeting(held: list[bytes], measure: Measure) -> Iterator[pa.RecordBatch]:
    keys, owners, sizes = [], [], []
    for payload in held:
        low, high, where, names, counts = unpacked(payload)
        steps = from_planes(low).astype(np.uint64) | from_planes(high).astype(np.uint64) << np.uint64(32)
        where = from_planes(where)
        keys.append(np.cumsum(steps, dtype=np.uint64))
        owners.append(names[where])
        sizes.append(counts[where])
    key, owner, size = np.concatenate(keys), np.concatenate(owners), np.concatenate(sizes).astype(np.int64)
    order = np.lexsort((owner, size, key))
    key, owner, size = key[order], owner[order], size[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner, size = key[new], owner[new], size[new]
    heads = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
    members = np.diff(heads, append=len(key))
    firsts, seconds, counts = [], [], []
    for m in range(2, LEAF + 1):
        at = heads[members == m]
        for i in range(m):
            for j in range(i + 1, m):
                firsts.append(at + i)
                seconds.append(at + j)
                counts.append(np.ones(len(at), np.int64))
    cells: dict[int, list[int]] = {}
    for head, m in zip(heads[members > LEAF].tolist(), members[members > LEAF].tolist(), strict=True):
        name = int(np.uint64(xxhash.xxh3_64_intdigest(owner[head:head + m].tobytes())).view(np.int64))
        cells.setdefault(name, [head, m, 0])[2] += 1
    for head, m, times in cells.values():
        for step in (1, 2, 3):  # neighbours by size; other classes may stand between them under another key, so they count double
            firsts.append(np.arange(head, head + m - step))
            seconds.append(np.arange(head + step, head + m))
            counts.append(np.full(m - step, 2 * times))
    if firsts:
        a, b, count = np.concatenate(firsts), np.concatenate(seconds), np.concatenate(counts)
        fit = measure.fit(size[a], size[b])
        a, b, count = a[fit], b[fit], count[fit]
        need = measure.shared(size[a], size[b])
        a, b = owner[a], owner[b]
        pairs, first, number = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0, return_index=True, return_inverse=True)
        if len(pairs):
            yield _rows(PAIR, pairs[:, 0], pairs[:, 1], np.bincount(number.ravel(), count).astype(np.int64), need[first])
    for name, (head, m, _) in cells.items():
        yield _rows(CELL, np.full(m, name), owner[head:head + m], np.zeros(m, np.int64), np.zeros(m, np.int64))


def _rows(kind: int, a: np.ndarray, b: np.ndarray, shared: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(shared), pa.array(need),
                            pa.nulls(len(a), pa.binary())], schema=_MET)


def _pairs(met: DataFrame) -> DataFrame:
    """The pairs (a, b) that share as many keys, over all partitions, as they must; a pair that shares a
    large key may be missing here, as its cell has it."""
    return (met.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("need").alias("need"))
            .filter("shared >= need").select("a", "b"))


_SETS = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])


def _about(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows whose id is needed, and those whose hash shares a place with such an id."""
    place = F.pmod(F.xxhash64(F.coalesce("id", F.lit(0))), F.lit(NEEDED_PLACES))
    marks = (needed.select(place.alias("place")).groupBy(F.expr("place div 64").cast("int").alias("stretch"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(place % 64))")).alias("marks")))
    return (rows.withColumn("place", place).withColumn("stretch", F.expr("place div 64").cast("int"))
            .join(F.broadcast(marks), "stretch").filter("shiftright(marks, int(place % 64)) & 1 = 1").select(*rows.columns))


def _sets(rows: DataFrame, needed: DataFrame, measure: Measure) -> DataFrame:
    """(class, n, shingles) of the ``needed`` (id, class); their texts travel compressed, by id."""
    needed = stored(needed, "shingle-owners")
    parts = shuffle_partitions(rows.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pack(ids: list, texts: list[bytes]) -> Iterator[tuple]:
            numbers = np.array([0 if x is None else x for x in ids], np.int64)
            target = np.mod(numbers, parts)
            order = np.argsort(target, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(target[order])) + 1):
                body = [texts[i] for i in own.tolist()]
                yield (int(target[own[0]]), KEYS, packed(numbers[own], np.fromiter(map(len, body), np.uint32, len(body)),
                                                   zstandard.ZstdCompressor(level=3).compress(b"".join(body))))

        def out() -> Iterator[tuple]:
            ids, texts = [], []
            for number, (more_ids, more) in enumerate(_slices(batches), 1):
                ids += more_ids
                texts += more
                if number % PACKED_SLICES == 0:
                    yield from pack(ids, texts)
                    ids, texts = [], []
            if ids:
                yield from pack(ids, texts)
        yield from batches_of(out(), _PACKS)

    def fetch(packs: pa.Table, wanted: pa.Table) -> pa.Table:
        hashes, names = WordHashes(), {}
        for doc_id, name in zip(wanted["id"].to_pylist(), wanted["class"].to_pylist(), strict=True):
            names.setdefault(doc_id, set()).add(name)

        def out() -> Iterator[tuple]:
            for payload in packs["payload"].to_pylist() if names else ():
                ids, sizes, body = unpacked(payload)
                own = [(i, t) for i, t in zip(ids.tolist(), split_words(sizes, zstandard.ZstdDecompressor().decompress(body)), strict=True) if i in names]
                for (doc_id, _), found in zip(own, measure.shingles([t for _, t in own], hashes), strict=True):
                    if (name := class_of(found)) in names[doc_id]:
                        names[doc_id].discard(name)
                        yield name, len(found), found.tobytes()
        return pa.Table.from_batches(list(batches_of(out(), _SETS)), _SETS)

    packs = _about(rows, needed).mapInArrow(cut, "part int, kind int, payload binary")
    wanted = needed.select(F.coalesce("id", F.lit(0)).alias("id"), "class").withColumn("part", F.pmod("id", F.lit(parts)).cast("int"))
    return packs.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(fetch, "class long, n long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for a, b, x, y in rows_of(batches, "a", "b", "x", "y"):
                if measure.linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)):
                    yield a, b
        yield from batches_of(out(), schema)
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _likely(pairs: DataFrame, signs: DataFrame, measure: Measure) -> DataFrame:
    """The pairs whose bitmaps allow enough overlap: a node pair of two leaves."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for a, b, m, n, x, y in rows_of(batches, "a", "b", "m", "n", "x", "y"):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                while len(x) > len(y):
                    x = x[:len(x) // 2] | x[len(x) // 2:]
                while len(y) > len(x):
                    y = y[:len(y) // 2] | y[len(y) // 2:]
                spare = min(m - int(np.bitwise_count(x).sum()), n - int(np.bitwise_count(y).sum()))
                if int(np.bitwise_count(x & y).sum()) + spare >= measure.needed(m, n):
                    yield a, b
        yield from batches_of(out(), schema)
    left = signs.select(F.col("class").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x"))
    right = signs.select(F.col("class").alias("b"), "n", F.col("bits").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y").mapInArrow(run, "a long, b long")


class Tree:
    """A signature tree: level 0 are the members; a node is the OR of eight below it."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> None:
        spare = sizes - np.bitwise_count(bits).sum(1)  # shingles that share a bit with another of their set
        self.levels = [(bits, sizes, sizes, spare, groups, groups)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, spare, first, last = self.levels[-1]
            starts = np.arange(0, len(bits), 8)
            self.levels.append((np.bitwise_or.reduceat(bits, starts), np.minimum.reduceat(low, starts),
                                np.maximum.reduceat(high, starts), np.maximum.reduceat(spare, starts),
                                np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts)))


def traversed(a: Tree, b: Tree, measure: Measure) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members (places) that may overlap enough and are of different groups. With
    ``b is a`` each pair once."""
    top = max(len(a.levels), len(b.levels)) - 1
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        x, y = a.levels[min(level, len(a.levels) - 1)], b.levels[min(level, len(b.levels) - 1)]
        keep = (100 * x[2][i] >= measure.least * y[1][j]) & (100 * y[2][j] >= measure.least * x[1][i])
        keep &= (x[4][i] != y[4][j]) | (x[5][i] != x[4][i]) | (y[5][j] != y[4][j])
        i, j = i[keep], j[keep]
        most = np.bitwise_count(x[0][i] & y[0][j]).sum(1) + np.minimum(x[3][i], y[3][j])
        keep = most >= measure.needed(x[1][i], y[1][j])
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        below = [len(t.levels[level - 1][0]) if level < len(t.levels) else None for t in (a, b)]
        i, j = (np.repeat(i, 64 if None not in below else 8), np.repeat(j, 64 if None not in below else 8))
        if None not in below:
            i, j = i * 8 + np.tile(np.repeat(np.arange(8), 8), len(i) // 64), j * 8 + np.tile(np.arange(8), len(j) // 8)
        elif below[0] is not None:
            i = i * 8 + np.tile(np.arange(8), len(i) // 8)
        else:
            j = j * 8 + np.tile(np.arange(8), len(j) // 8)
        inside = (i < (below[0] or 1)) & (j < (below[1] or 1))
        if a is b:
            inside &= i < j if level == 1 else i <= j
        i, j = i[inside], j[inside]
        for at in range(0, len(i), 1 << 15):
            stack.append((level - 1, i[at:at + (1 << 15)], j[at:at + (1 << 15)]))


def bitmap(shingles: np.ndarray, each: int = 8) -> np.ndarray:
    """Token bitmap of ``each`` bits for each shingle, less than twice as many, 64 at least, as 64-bit words."""
    width = 1 << max(6, int(len(shingles) * each - 1).bit_length())
    places = (shingles & np.uint64(width - 1)).astype(np.int64)
    bits = np.zeros(width // 8, np.uint8)
    np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
    return bits.view(np.uint64)


def _cells(met: DataFrame, signs: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, class, n, bits, root, blocks): members of large keys that are not all connected yet."""
    cells = (met.filter(F.col("kind") == CELL).select(F.col("a").alias("cell"), F.col("b").alias("class")).distinct()
             .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
             .withColumn("root", F.coalesce("root", "class")).join(signs.select("class", "n", "bits"), "class"))
    return cells.join(_blocks(cells), "cell")


def _blocks(cells: DataFrame) -> DataFrame:
    """(cell, blocks) of the cells whose members are of several roots."""
    return (cells.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
            .filter("low <> high").select("cell", "blocks"))


def _in_block_pairs(cells: DataFrame, run, *columns: str) -> DataFrame:
    """(a, b) that ``run`` makes of the members of each two blocks of a cell, and of each block alone."""
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (cells.select("*", block.alias("own")).select("*", other.alias("other"))
              .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
              .select("cell", "low", "high", *columns))
    return placed.groupBy("cell", "low", "high").applyInArrow(run, "a long, b long").distinct()


def _leaves(bits: list[np.ndarray], sizes: np.ndarray, groups: np.ndarray, measure: Measure) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that the dual traversal reaches, one tree for each width of bitmaps."""
    widths = np.array([len(b) for b in bits])
    trees: dict[int, tuple[Tree, np.ndarray]] = {}
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        own = own[np.lexsort((sizes[own], groups[own]))]
        rows = np.stack([bits[k] for k in own.tolist()])
        trees[width] = tree, _ = Tree(rows, sizes[own], groups[own]), own
        for i, j in traversed(tree, tree, measure):
            yield own[i], own[j]
        if width // 2 in trees:  # the wider bitmaps folded onto the narrower ones
            half, narrow = trees[width // 2]
            folded = Tree(rows[:, :width // 2] | rows[:, width // 2:], sizes[own], groups[own])
            for i, j in traversed(half, folded, measure):
                yield narrow[i], own[j]


class Forest:
    """Groups of numbers that are joined two at a time."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = self.above.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.top(x), self.top(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)
        return x != y


def _table(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([min(p) for p in pairs], pa.int64()), "b": pa.array([max(p) for p in pairs], pa.int64())})


def _maybe(table: pa.Table, measure: Measure) -> pa.Table:
    """Edges that join what the leaf pairs join, at most one for each member."""
    names, groups, sizes = (table[c].to_numpy() for c in ("class", "root", "n"))
    bits, forest = [np.frombuffer(b, np.uint64) for b in table["bits"].to_pylist()], Forest()
    return _table([(int(names[a]), int(names[b])) for i, j in _leaves(bits, sizes, groups, measure)
                   for a, b in zip(i.tolist(), j.tolist(), strict=True) if forest.join(a, b)])


def _surely(table: pa.Table, measure: Measure) -> pa.Table:
    """Links that join groups, at most one for each member: the leaf pairs verified on whole sets."""
    names, groups, sizes = (table[c].to_numpy() for c in ("class", "root", "n"))
    sets, forest = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()], Forest()
    roots, links = groups.tolist(), []
    for i, j in _leaves([bitmap(s) for s in sets], sizes, groups, measure):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if forest.top(roots[a]) != forest.top(roots[b]) and measure.linked(sets[a], sets[b]):
                forest.join(roots[a], roots[b])
                links.append((int(names[a]), int(names[b])))
    return _table(links)


def _connecting(rows: DataFrame, met: DataFrame, signs: DataFrame, roots: DataFrame, sets: DataFrame, measure: Measure) -> DataFrame:
    """Links (a, b) between classes of large keys that ``roots`` has not connected.

    Leaf pairs of the keys' trees, of bitmaps, join classes to candidate groups; a class
    is in one group only, so its set travels once. A group's own trees are traversed
    again and their leaves verified. Both steps give edges that join something, never a
    row for each pair: near misses cost time in their task and no rows.
    """
    edges = stored(_in_block_pairs(_cells(met, signs, roots), lambda t: _maybe(t, measure), "class", "n", "bits", "root"), "shingle-edges")
    groups = stored(components(edges).select(F.col("node").alias("class"), F.col("root").alias("cell"))
                    .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
                    .withColumn("root", F.coalesce("root", "class")), "shingle-groups")
    members = signs.join(groups.select("class"), "class").select("id", "class")
    missing = members.join(sets.select("class"), "class", "left_anti").select("id", "class")
    whole = groups.join(sets.unionByName(_sets(rows, missing, measure)), "class")
    split = _blocks(groups.join(signs.select("class", "n"), "class"))
    return _in_block_pairs(whole.join(split, "cell"), lambda t: _surely(t, measure), "class", "n", "shingles", "root")


def _owners(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """(id, class): a document for each class of the pairs."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    return signs.join(wanted, "class").select("id", "class")


def joined(docs: DataFrame, words: int = 4, least: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    measure, rows = Measure(words, least), id_text(docs, id_col, text_col)
    met = stored(_met(_keys(rows, measure, common_shingles(rows, measure)), measure), "shingle-keys")
    named = _named(met)
    signs = stored(named.filter("n > 0").groupBy("class").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.max("bits").alias("bits")), "shingle-signatures")
    pairs = stored(_likely(_pairs(met), signs, measure), "shingle-pairs")
    sets = stored(_sets(rows, _owners(pairs, signs), measure), "shingle-sets")
    near = stored(_verified(pairs, sets, measure), "shingle-links")
    rest = stored(_connecting(rows, met, signs, components(near), sets, measure), "shingle-links")
    roots = components(near.unionByName(rest))
    placed = (named.select("id", "n", "class").join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
              .withColumn("root", F.coalesce("root", "class")).withColumn("linked", F.col("n") > 0))
    tops = placed.filter("linked").groupBy("root").agg(F.min("id").alias("top"))
    return placed.join(tops, "root", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("linked"), F.col("top")).otherwise(F.col("id")).alias("component_id"))
