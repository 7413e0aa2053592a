"""Work on each distinct word of a corpus once, and bring the answers back to its documents.

Documents are read in chunks of bounded size. A chunk keeps its documents as a frame
of word numbers in order of position, and sends its distinct words to the partitions
that their hashes name: one packed row per chunk and partition. There all chunks'
copies of a word meet, the word is worked on once, and the answers go back to the
chunks, where they take the places of the word's positions. A word that makes up a
third of all text is still one entry per chunk. Texts themselves are not shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyhouse.llm.common import (Numbered, batches_of, from_planes, joined_words, packed, planes, rows_of,
                                   shuffle_partitions, split_words, unpacked)

#: Bytes of text to a chunk; a longer document is a chunk by itself.
CHUNK_BYTES = 16 << 20

ROWS = "part int, chunk long, kind int, payload binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
FRAME, WORDS, ANSWER = 0, 1, 2


def cut(docs: DataFrame, words_of: Callable[[bytes], list[bytes]], counted: Callable[[int | None], bool],
        chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Frames and words of (id, text) rows. ``counted`` tells by the id whether a
    document's words count; a word comes with its count in the chunk's counted documents."""
    parts = shuffle_partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(_chunks(rows_of(batches, "id", "text"), words_of, counted, parts, chunk_bytes), _SCHEMA)

    return docs.mapInArrow(run, ROWS)


def _chunks(rows, words_of, counted, parts: int, chunk_bytes: int) -> Iterator[tuple]:
    number = TaskContext.get().partitionId() << 32
    ids, codes, numbers, size = [], [], Numbered(), 0
    for doc_id, text in rows:
        words = words_of(text)
        ids.append(doc_id)
        codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
        size += len(text)
        if size >= chunk_bytes:
            yield from _chunk(number, ids, codes, list(numbers), counted, parts)
            number += 1
            ids, codes, numbers, size = [], [], Numbered(), 0
    if ids:
        yield from _chunk(number, ids, codes, list(numbers), counted, parts)


def _chunk(number: int, ids: list, codes: list[np.ndarray], words: list[bytes], counted, parts: int) -> Iterator[tuple]:
    flat = np.concatenate(codes)
    often = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")  # small numbers for frequent words
    place = np.empty(len(words), np.uint32)
    place[often] = np.arange(len(words), dtype=np.uint32)
    flat, words = place[flat], [words[i] for i in often.tolist()]
    lengths = np.fromiter(map(len, codes), np.uint32, len(codes))
    counts = np.bincount(flat[np.repeat([counted(x) for x in ids], lengths)], minlength=len(words)).astype(np.uint32)
    target = np.fromiter((zlib.crc32(w) % parts for w in words), np.uint32, len(words))
    known = np.array([x is not None for x in ids], np.uint8)
    frame = packed(np.array([x or 0 for x in ids], np.int64), known, lengths, planes(flat), planes(target))
    yield number % parts, number, FRAME, frame
    order = np.argsort(target, kind="stable")
    starts = np.flatnonzero(np.diff(target[order], prepend=-1)) if len(order) else []
    for members in np.split(order, starts[1:]) if len(starts) else []:
        sizes, body = joined_words([words[i] for i in members.tolist()])
        yield int(target[members[0]]), number, WORDS, packed(sizes, body, planes(counts[members]))


def words_in(payload: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of a packed row and their counts."""
    sizes, body, counts = unpacked(payload)
    return split_words(sizes, body), from_planes(counts)


def answered(rows: DataFrame, answer: Callable[[Iterator[tuple[int, bytes]]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Replace packed words by answers, in partitions that hold every copy of a word.

    ``answer`` gets (key, payload) of all word rows of a task and yields (key, packed
    answers in the order of the words). Frames pass through.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            keys: list[tuple[int, int]] = []

            def words():
                for part, chunk, kind, payload in rows_of(batches, "part", "chunk", "kind", "payload"):
                    if kind == FRAME:
                        frames.append((part, chunk, kind, payload))
                    else:
                        keys.append((part, chunk))
                        yield len(keys) - 1, payload
            frames: list[tuple] = []
            for key, payload in answer(words()):
                yield from frames
                frames.clear()
                yield *keys[key], ANSWER, payload
            yield from frames
        yield from batches_of(out(), _SCHEMA)

    return rows.repartition("part").mapInArrow(run, ROWS)


def assembled(rows: DataFrame, finish: Callable[[list, np.ndarray, np.ndarray, list[list]], Iterator[tuple]],
              schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows of the documents, chunk by chunk.

    ``finish`` gets the chunk's ids, each document's number of words, the numbers of
    all its words, and what ``unpacked`` makes of the answers as (members, arrays),
    where ``members`` are the numbers of the words answered.
    """
    def run(table: pa.Table) -> pa.Table:
        frame, answers = None, {}
        for part, kind, payload in zip(*(table[c].to_pylist() for c in ("part", "kind", "payload")), strict=True):
            if kind == FRAME:
                frame = unpacked(payload)
            else:
                answers[part] = unpacked(payload)
        ids, known, lengths, codes, target = frame
        codes, target = from_planes(codes), from_planes(target)
        order = np.argsort(target, kind="stable")
        edges = np.searchsorted(target[order], np.arange(max(answers, default=-1) + 2))
        found = [(order[edges[p]:edges[p + 1]], arrays) for p, arrays in answers.items()]
        ids = [x if k else None for x, k in zip(ids.tolist(), known.tolist(), strict=True)]
        return pa.Table.from_batches(list(batches_of(finish(ids, lengths, codes, found), arrow)), arrow)

    return rows.groupBy("chunk").applyInArrow(run, schema)
