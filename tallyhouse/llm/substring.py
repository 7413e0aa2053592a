"""Removal of repeated passages: fixed-block anchors, rolling probes, maximal extension.

A window of W words that occurs twice holds, at its earlier place, a whole block of W/2
words on the grid of its document. So all grid blocks are the index, every rolling
window of W/2 words is a probe, and only around probes that hit an indexed block met
elsewhere can a window repeat. There the hits are extended: the hashes of the W-word
windows meet, the earliest start of each is kept, and the union of all other windows is
the document's maximal repeats, whose words go.

Documents are read once into chunks, which are stored compressed. A chunk sends each
distinct hash once to the partition of its range, as packed numbers in order; one bit
per hash comes back. A passage in a third of all documents is thus one entry per chunk,
and no texts meet except within their own chunk.

Null texts have no words; documents shorter than a window lose nothing. Order is by id,
then start; a null id comes last. Rows that share an id lie over each other: a window is
earlier only by a smaller start. An empty table gives an empty result; columns other
than id and text do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import (WordHashes, batches_of, from_planes, id_text, packed, planes, quoted, rows_of,
                                   shuffle_partitions, split_words, stored, unpacked, window_hashes)

#: Words of a window.
WINDOW = 20

#: Bytes of text to a chunk; a longer document is a chunk by itself.
CHUNK_BYTES = 4 << 20

_CHUNKS = "chunk long, payload binary"
_CHUNK_ARROW = pa.schema([("chunk", pa.int64()), ("payload", pa.binary())])
_MESSAGES = "part int, chunk long, payload binary"
_MESSAGE_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("payload", pa.binary())])
_NO_ID = np.iinfo(np.int64).max
_BITS = 40  # of a probe's hash: a wrong hit costs work, never a word


def _chunked(docs: DataFrame) -> DataFrame:
    """(chunk, payload): documents packed and compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
            for doc_id, text in rows_of(batches, "id", "text"):
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield number, _pack_docs(ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
            if ids:
                yield number, _pack_docs(ids, texts)
        yield from batches_of(out(), _CHUNK_ARROW, bytes_each=1)
    return docs.mapInArrow(run, _CHUNKS)


def _pack_docs(ids: list, texts: list[bytes]) -> bytes:
    body = zstandard.ZstdCompressor(level=4).compress(b"".join(texts))
    known = np.array([x is not None for x in ids], np.uint8)
    return packed(np.array([x or 0 for x in ids], np.int64), known, np.fromiter(map(len, texts), np.uint32, len(texts)), body)


class Chunk:
    """The documents of a chunk, their words in one row, and the hashes of their windows."""

    def __init__(self, payload: bytes, window: int, hashes: WordHashes) -> None:
        ids, known, sizes, body = unpacked(payload)
        self.window, self.block = window, window // 2
        self.ids = [x if k else None for x, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.words = [text.split() for text in split_words(sizes, zstandard.ZstdDecompressor().decompress(body))]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.hashes = np.concatenate([hashes.of(w) for w in self.words]) if self.words else np.empty(0, np.uint64)

    def places(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs of ``length`` words in documents that have a window, and their hashes."""
        values = window_hashes(self.hashes, length)
        room = np.where(self.counts >= self.window, self.counts - length + 1, 0)
        at = np.flatnonzero(_spread(room, self.counts)[:len(values)])
        return at, values[at]

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct probe hashes, whether each is on a grid and met twice here; and
        the places with the number of the hash of each."""
        at, values = self.places(self.block)
        distinct, where, often = np.unique(values >> np.uint64(64 - _BITS), return_inverse=True, return_counts=True)
        grid = np.zeros(len(distinct), bool)
        inside = at - np.repeat(self.starts, self.counts)[at]
        grid[where[inside % self.block == 0]] = True
        return distinct, grid, often > 1, at, where

    def candidates(self, hit: np.ndarray, at: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows around hits: sorted distinct hashes, the earliest window of each, and
        all windows with the number of the hash of each."""
        marks = np.zeros(len(self.hashes) + 1, np.int64)
        marks[at[hit[where]] + 1] = 1
        marks = np.cumsum(marks)
        places, values = self.places(self.window)
        near = marks[places + self.block + 1] > marks[places]
        places, values = places[near], values[near]
        ids = np.array([_NO_ID if x is None else x for x in self.ids], np.int64)
        owner = np.searchsorted(self.ends, places, "right")
        order = np.lexsort((places - self.starts[owner], ids[owner], values))
        places, values = places[order], values[order]
        first = np.flatnonzero(np.diff(values, prepend=values[:1] + np.uint64(1))) if len(values) else np.empty(0, np.int64)
        number = np.cumsum(np.bincount(first, minlength=len(values))) - 1 if len(values) else first
        return values[first], first, places, number

    def position(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and start within the document."""
        owner = np.searchsorted(self.ends, places, "right")
        return np.array([_NO_ID if x is None else x for x in self.ids], np.int64)[owner], places - self.starts[owner]


def _spread(room: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word whether it is among the first ``room`` of its document."""
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return inside < np.repeat(room, counts)


def _parts_of(sorted_hashes: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of the ranges of hashes that hold any."""
    edges = np.searchsorted(sorted_hashes, np.array([-(-(p << bits) // parts) for p in range(1, parts)], np.uint64))
    edges = [0, *edges.tolist(), len(sorted_hashes)]
    for part in range(parts):
        if edges[part] < edges[part + 1]:
            yield part, edges[part], edges[part + 1]


def _steps(values: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted 64-bit numbers as differences in byte planes."""
    steps = np.diff(values, prepend=np.uint64(0))
    return planes(steps & np.uint64(0xFFFFFFFF)), planes(steps >> np.uint64(32))


def _from_steps(low: bytes, high: bytes) -> np.ndarray:
    return np.cumsum(from_planes(low).astype(np.uint64) | from_planes(high).astype(np.uint64) << np.uint64(32), dtype=np.uint64)


def _grouped_by_part(messages: DataFrame, resolve) -> DataFrame:
    """Answer the messages of each part together; a task holds one part at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            held, at = [], None
            for part, chunk, payload in rows_of(batches, "part", "chunk", "payload"):
                if part != at and held:
                    yield from resolve(held)
                    held = []
                at = part
                held.append((part, chunk, payload))
            yield from resolve(held) if held else ()
        yield from batches_of(out(), _MESSAGE_ARROW)
    return messages.repartition("part").sortWithinPartitions("part").mapInArrow(run, _MESSAGES)


def _hits(held: list[tuple]) -> Iterator[tuple]:
    """For each probe hash of each chunk whether it is indexed and met at two places."""
    packs = [unpacked(payload) for *_, payload in held]
    values = [_from_steps(low, high) for low, high, _, _ in packs]
    flags = [[np.unpackbits(np.frombuffer(f, np.uint8), count=len(v)) for f in pack[2:]] for pack, v in zip(packs, values, strict=True)]
    every = np.concatenate(values)
    order = np.argsort(every, kind="stable")
    first = np.diff(every[order], prepend=every[order][:1] + np.uint64(1)) != 0
    number = np.cumsum(first) - 1
    grid, often = (np.concatenate([f[i] for f in flags])[order] for i in range(2))
    starts = np.flatnonzero(first)
    hit = (np.add.reduceat(grid.astype(np.int64), starts) > 0) & (np.add.reduceat(1 + often.astype(np.int64), starts) > 1)
    found = np.empty(len(every), np.uint8)
    found[order] = hit[number]
    at = 0
    for (part, chunk, _), own in zip(held, values, strict=True):
        yield part, chunk, packed(np.packbits(found[at:at + len(own)]).tobytes())
        at += len(own)


def _firsts(held: list[tuple]) -> Iterator[tuple]:
    """For each window hash of each chunk whether the chunk's earliest is the earliest of all."""
    packs = [unpacked(payload) for *_, payload in held]
    values = [_from_steps(low, high) for low, high, _, _ in packs]
    every, ids = np.concatenate(values), np.concatenate([p[2] for p in packs])
    starts = np.concatenate([from_planes(p[3]) for p in packs])
    order = np.lexsort((starts, ids, every))
    new = np.diff(every[order], prepend=every[order][:1] + np.uint64(1)) != 0
    head = np.flatnonzero(new)[np.cumsum(new) - 1]  # rows at the same id and start as the earliest are no repeats of it
    first = (ids[order] == ids[order][head]) & (starts[order] == starts[order][head])
    found = np.empty(len(every), np.uint8)
    found[order] = first
    at = 0
    for (part, chunk, _), own in zip(held, values, strict=True):
        yield part, chunk, packed(np.packbits(found[at:at + len(own)]).tobytes())
        at += len(own)


def _bits(answers: dict[int, bytes], hashes: np.ndarray, bits: int, parts: int) -> np.ndarray:
    found = np.zeros(len(hashes), bool)
    for part, a, b in _parts_of(hashes, bits, parts):
        found[a:b] = np.unpackbits(np.frombuffer(unpacked(answers[part])[0], np.uint8), count=b - a)
    return found


def _rejoined(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Rows (chunk, kind, part, payload): chunks (kind 0) with the answers to them (1, 2)."""
    rows = chunks.selectExpr("chunk", "0 kind", "0 part", "payload")
    for kind, frame in enumerate(answers, 1):
        rows = rows.unionByName(frame.selectExpr("chunk", f"{kind} kind", "part", "payload"))
    return rows.groupBy("chunk")


def _group(table: pa.Table) -> tuple[bytes, list[dict[int, bytes]]]:
    body, answers = b"", [{}, {}]
    for kind, part, payload in zip(*(table[c].to_pylist() for c in ("kind", "part", "payload")), strict=True):
        if kind == 0:
            body = payload
        else:
            answers[kind - 1][part] = payload
    return body, answers


def repeats(docs: DataFrame, finish, schema: str, arrow: pa.Schema, window: int = WINDOW, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``finish(doc_id, words, gone)`` for every document; ``gone`` marks the words to remove."""
    if window < 4 or window % 2:
        raise ValueError("window must be even and 4 or more")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    chunks = stored(_chunked(id_text(docs, id_col, text_col)), "substring-chunks")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def out() -> Iterator[tuple]:
            for chunk, payload in rows_of(batches, "chunk", "payload"):
                distinct, grid, often, *_ = Chunk(payload, window, hashes).probes()
                for part, a, b in _parts_of(distinct, _BITS, parts):
                    yield part, chunk, packed(*_steps(distinct[a:b]), np.packbits(grid[a:b]).tobytes(), np.packbits(often[a:b]).tobytes())
        yield from batches_of(out(), _MESSAGE_ARROW)

    hits = stored(_grouped_by_part(chunks.mapInArrow(probe, _MESSAGES), _hits), "substring-hits")

    def extend(table: pa.Table) -> pa.Table:
        def out() -> Iterator[tuple]:
            payload, (answers, _) = _group(table)
            chunk = Chunk(payload, window, WordHashes())
            distinct, _, _, at, where = chunk.probes()
            values, first, places, _ = chunk.candidates(_bits(answers, distinct, _BITS, parts), at, where)
            ids, starts = chunk.position(places[first])
            for part, a, b in _parts_of(values, 64, parts):
                yield part, table["chunk"][0].as_py(), packed(*_steps(values[a:b]), ids[a:b], planes(starts[a:b]))
        return pa.Table.from_batches(list(batches_of(out(), _MESSAGE_ARROW)), _MESSAGE_ARROW)

    firsts = stored(_grouped_by_part(_rejoined(chunks, hits).applyInArrow(extend, _MESSAGES), _firsts), "substring-firsts")

    def remove(table: pa.Table) -> pa.Table:
        def out() -> Iterator[tuple]:
            payload, (answers, earliest) = _group(table)
            chunk = Chunk(payload, window, WordHashes())
            distinct, _, _, at, where = chunk.probes()
            values, first, places, number = chunk.candidates(_bits(answers, distinct, _BITS, parts), at, where)
            ids, starts = chunk.position(places)
            own = _bits(earliest, values, 64, parts)
            same = (ids == ids[first][number]) & (starts == starts[first][number])
            later = places[~(own[number] & same)]
            cover = np.zeros(len(chunk.hashes) + 1, np.int64)
            np.add.at(cover, later, 1)
            np.add.at(cover, later + window, -1)
            gone = np.cumsum(cover)[:-1] > 0
            for doc_id, words, a, b in zip(chunk.ids, chunk.words, chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
                yield doc_id, *finish(words, gone[a:b])
        return pa.Table.from_batches(list(batches_of(out(), arrow)), arrow)

    return _rejoined(chunks, hits, firsts).applyInArrow(remove, schema)


def _kept(words: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)


def _spans(gone: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
    return [{"first": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def removed(docs: DataFrame, window: int = WINDOW, **columns) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text): spans are word places [first, end)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                       ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])
    return repeats(docs, lambda words, gone: (len(words), int(gone.sum()), _spans(gone), _kept(words, gone).decode()),
                   "doc_id long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept_text string",
                   arrow, window, **columns)


def digests(docs: DataFrame, window: int = WINDOW, **columns) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    return repeats(docs, lambda words, gone: (len(words), int(gone.sum()), hashlib.sha256(_kept(words, gone)).hexdigest()),
                   "doc_id long, n_words long, n_removed long, kept_sha256 string", arrow, window, **columns)


def rewritten(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept words in place of each text that lost any; other columns as they were.

    Only changed texts travel back to their rows, found by id and the text's hash.
    """
    arrow = pa.schema([("_id", pa.int64()), ("_old", pa.string()), ("_kept", pa.string())])

    def changed(words: list[bytes], gone: np.ndarray) -> tuple:
        return hashlib.sha256(b" ".join(words)).hexdigest(), _kept(words, gone).decode() if gone.any() else None
    found = repeats(docs, changed, "_id long, _old string, _kept string", arrow, window, id_col, text_col)
    found = stored(found.filter("_kept is not null").dropDuplicates(["_id", "_old"]), "passages")
    text = F.col(quoted(text_col))
    blank = F.trim(F.regexp_replace(text, "[ \\t-\\r]+", " "), F.lit(" "))
    keyed = docs.withColumn("_key", F.sha2(blank, 256))
    same = keyed[quoted(id_col)].eqNullSafe(found["_id"]) & (keyed["_key"] == found["_old"])
    return keyed.join(found, same, "left").withColumn(text_col, F.coalesce("_kept", text)).select(*map(quoted, docs.columns))
