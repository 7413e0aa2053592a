"""What several operators share: input columns, words, packed arrays, stored tables."""

from __future__ import annotations

import math
import os
import struct
import tempfile
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import new_folder

#: Most entries that a worker keeps in a cache of words; a full cache starts anew.
CACHE_ENTRIES = 150_000


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, so that functions
    here run on executors that do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tallyhouse_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "tallyhouse.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._tallyhouse_shipped = True


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of ``docs``; every other column stays behind, so that no name can clash."""
    ship(docs.sparkSession)
    return docs.select(F.col(quoted(id_col)).cast("long").alias("id"),
                       F.col(quoted(text_col)).cast("string").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once, and a lost
    executor costs only its running tasks."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of a column, null as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the batches, the text column as bytes (null as empty)."""
    for batch in batches:
        columns = [byte_texts(batch.column(name)) if name == "text"
                   else batch.column(name).to_pylist() for name in names]
        yield from zip(*columns, strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, rows_each: int = 4096,
               bytes_each: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, bounded in rows and in bytes of their binary values."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= rows_each or size >= bytes_each:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def words_lower(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: what bytes.split() and lower() do."""
    return text.lower().split()


class Numbered(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class WordHashes(dict):
    """64-bit hash per word, kept for the words met most recently."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive values, mixed after each doubling."""
    def run(n: int) -> np.ndarray:
        if n == 1:
            return mixed(hashes + _ODD[0])
        half = n // 2
        left, right = run(half), run(n - half)
        count = len(hashes) - n + 1
        return mixed(left[:count] * _ODD[0] + right[half:half + count])
    return run(length) if len(hashes) >= length else np.empty(0, np.uint64)


def packed(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays of numbers, or bytes, as one compressed value."""
    parts = []
    for a in arrays:
        kind = b"S" if isinstance(a, bytes) else a.dtype.str[1:].encode()
        body = a if isinstance(a, bytes) else a.tobytes()
        parts.append(struct.pack("<4sQ", kind, len(body)) + body)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(value: bytes) -> list:
    raw = zstandard.ZstdDecompressor().decompress(value)
    found, at = [], 0
    while at < len(raw):
        kind, size = struct.unpack_from("<4sQ", raw, at)
        at += 12
        kind = kind.rstrip(b"\0").decode()
        found.append(raw[at:at + size] if kind == "S" else np.frombuffer(raw, "<" + kind, size // int(kind[1:]), at))
        at += size
    return found


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by byte place, so that small ones compress well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(value: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def joined_words(words: list[bytes]) -> tuple[np.ndarray, bytes]:
    return np.fromiter(map(len, words), np.uint32, len(words)), b"".join(words)


def split_words(lengths: np.ndarray, body: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def remainder_is(number: int, of: int, value: int) -> bool:
    """Whether crc32 of the number's decimal text leaves ``value`` modulo ``of``."""
    return zlib.crc32(str(number).encode()) % of == value


def held_out(id_col: str, of: int, value: int):
    """The same test as a column; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == value, F.lit(False))


def log2ceil(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n))))
