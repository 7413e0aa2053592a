"""Document fingerprints: which quartile each bucket of hashed byte triplets falls in.

All triplets of neighbouring bytes of a text are hashed to BUCKETS buckets and counted.
The digest holds, for each bucket, the quartile of its count among the text's own counts
(2 bits), and the length of the text in steps of an eighth of a doubling. Two digests
differ by the quartile steps of all buckets and by LENGTH_WEIGHT for every doubling of
length; the likeness is what this leaves of BOUND, 1 for equal digests and 0 from the
bound on. So the digest of a text that changed in part stays near its own, whatever the
place of the change, and a text costs the same whether it is short or long.

Neighbours in order of id are found by a range shuffle: rows are sorted in partitions,
every row but a partition's last meets the next one there, and the last rows meet the
first row of the partition after them, one row a partition, after the last the first.

A null text is empty; texts of fewer than three bytes have no triplet, and all their
quartiles are 0. A null id comes after all others. Rows of one id follow each other by a
hash of their texts and then in any order, so one id may hold any part of the rows. A
table of one row has itself for the next; an empty table gives an empty result. Other
columns do not take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import batches_of, id_text, rows_of, shuffle_partitions, stored

#: Buckets of triplets, and quartile steps a bucket at which two digests have nothing in common.
BUCKETS, BOUND = 512, 1.5

#: Steps a bucket that a doubling of the length counts as, and codes of a doubling.
LENGTH_WEIGHT, LENGTH_STEPS = 0.05, 8

#: Texts and bytes of text that are counted at once.
CHUNK_ROWS, CHUNK_BYTES = 1024, 2 << 20


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """Triplets of each text by bucket."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    found = np.zeros(len(texts) * BUCKETS, np.int64)
    for at in range(0, len(flat) - 2, CHUNK_BYTES):
        part = flat[at:at + CHUNK_BYTES + 2].astype(np.uint32)
        own = text[at:at + CHUNK_BYTES + 2]
        whole = own[:-2] == own[2:]
        hashed = (part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
        hashed = (hashed ^ hashed >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(23)
        first, last = int(own[0]), int(own[-1]) + 1
        place = (own[:-2].astype(np.int64) - first) * BUCKETS + hashed
        found[first * BUCKETS:last * BUCKETS] += np.bincount(place[whole], minlength=(last - first) * BUCKETS)
    return found.reshape(-1, BUCKETS)


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Quartile (0 to 3) of every bucket, and length code, of each text."""
    counts = bucket_counts(texts)
    cuts = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    borders = np.partition(counts, cuts, 1)[:, cuts]
    quartiles = sum((counts > borders[:, [i]]).astype(np.int8) for i in range(3))
    lengths = np.fromiter(map(len, texts), np.float64, len(texts))
    return quartiles, np.rint(np.log2(lengths + 1) * LENGTH_STEPS).astype(np.int64)


def written(quartiles: np.ndarray, lengths: np.ndarray) -> list[str]:
    """Digests as text: four hex digits of length, then two bits a bucket in hex."""
    four = quartiles.reshape(len(quartiles), -1, 4).astype(np.uint8)
    bodies = four[..., 0] << 6 | four[..., 1] << 4 | four[..., 2] << 2 | four[..., 3]
    return [f"{length:04x}{body.tobytes().hex()}" for length, body in zip(lengths.tolist(), bodies.astype(np.uint8), strict=True)]


def read(fingerprint: str) -> tuple[np.ndarray, int]:
    """Quartiles and length code of a written digest."""
    body = np.frombuffer(bytes.fromhex(fingerprint[4:]), np.uint8)
    return (body[:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel().astype(np.int8), int(fingerprint[:4], 16)


def likeness(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Likeness, 0 to 1, of digests row by row."""
    steps = np.abs(one[0] - other[0]).sum(-1, dtype=np.int64) / BUCKETS
    apart = np.abs(np.asarray(one[1]) - np.asarray(other[1])) * (LENGTH_WEIGHT / LENGTH_STEPS)
    return 1 - np.minimum(1.0, (steps + apart) / BOUND)


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of the text, and the text whose last half of them is replaced by as many
    of the following text's first, or all it has."""
    own = text.decode(errors="surrogateescape")
    half = len(own) // 2
    new = own[:len(own) - half] + following.decode(errors="surrogateescape")[:half]
    return len(own), new.encode(errors="surrogateescape")


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = pa.schema(list(zip(_NAMES, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()], strict=True)))
_RESULT_SQL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
#: What a partition leaves: results, its first row and its last one, which is without a next.
DONE, FIRST, LAST = 0, 1, 2
_SORTED = pa.schema([*_RESULT, ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.binary())])


def _results(held: list[tuple[int | None, bytes, bytes]], chained: bool) -> Iterator[tuple]:
    """Results of (id, text, next text) rows; ``chained`` if each row's next text is the next row's own."""
    if not held:
        return
    changed = [edited(text, following) for _, text, following in held]
    texts = [text for _, text, _ in held] + ([held[-1][2]] if chained else [following for _, _, following in held])
    own, new = digests(texts), digests([text for _, text in changed])
    at = len(held)
    here = tuple(x[:at] for x in own)
    after = tuple(x[1:] if chained else x[at:] for x in own)
    columns = (written(*here), written(*new), likeness(here, new).tolist(), likeness(here, after).tolist())
    for (doc_id, _, _), (n_chars, text), fingerprint, other, near, far in zip(held, changed, *columns, strict=True):
        yield doc_id, n_chars, hashlib.sha256(text).hexdigest(), fingerprint, other, near, far


def _chunks(rows: Iterator[tuple], chained: bool) -> Iterator[tuple]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + (0 if chained else len(row[2]))
        if len(held) >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield from _results(held, chained)
            held, size = [], 0
    yield from _results(held, chained)


def _sorted_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, ends = TaskContext.get().partitionId(), []

    def followed() -> Iterator[tuple]:
        before = None
        for row in rows_of(batches, "id", "text"):
            if before is None:
                ends.append((FIRST, row))
            else:
                yield *before, row[1]
            before = row
        if before is not None:
            ends.append((LAST, before))

    def out() -> Iterator[tuple]:
        for row in _chunks(followed(), True):
            yield *row, DONE, part, None
        for kind, (doc_id, text) in ends:
            yield doc_id, *[None] * (len(_RESULT) - 1), kind, part, text
    yield from batches_of(out(), _SORTED)


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pairs() -> Iterator[tuple]:
        for doc_id, text, following in rows_of(batches, "doc_id", "text", "following"):
            yield doc_id, text, following or b""
    yield from batches_of(_chunks(pairs(), False), _RESULT)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to
    the next document's in order of id."""
    rows = id_text(docs, id_col, text_col).select(
        "id", "text", F.xxhash64("text").alias("spread"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("id").asc_nulls_last(), "spread", "row"]
    # A range of the row number as well, so that one id, or one text, does not fill one partition.
    dealt = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    found = stored(dealt.select("id", "text").mapInArrow(_sorted_part, _RESULT_SQL + ", kind int, part int, text binary"),
                   "fingerprints")
    first = found.filter(F.col("kind") == FIRST).select("part", F.col("text").alias("following"))
    # One number a partition: the partition after each, and the first after the last.
    after = F.lead("part").over(Window.orderBy("part"))
    parts = first.select("part", F.coalesce(after, F.min("part").over(Window.partitionBy())).alias("next_part"))
    last = (found.filter(F.col("kind") == LAST).select("doc_id", "text", "part").join(parts, "part")
            .join(first.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following"))
    return found.filter(F.col("kind") == DONE).select(*_NAMES).unionByName(last.mapInArrow(_last_rows, _RESULT_SQL))
