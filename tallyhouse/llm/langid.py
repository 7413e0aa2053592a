"""Language identification by prediction by partial matching over bytes.

For each language a context tree of orders 0 to 3 is counted on a bounded sample of its
labelled documents. A byte not seen after a context escapes to the next shorter one;
the escape's probability is d / (n + d) for d kinds of byte seen n times (an unseen
byte ends at 1/256). Statistics are frozen, so the code length of every byte is known
beforehand, and a text's code length under a language is a sum over its bytes. The
language with the shortest code wins.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if
no labelled row exists. Ties go to the language first by name. Repeated rows are scored
each by itself; an empty table gives an empty result; other columns do not take part.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import batches_of, id_text, packed, quoted, ship, stored, unpacked

#: Labelled documents, on average, that a language is learned from: the bound of the sample.
SAMPLE_DOCS = 400

#: Contexts of three bytes seen less often than this leave prediction to shorter ones.
LEAST_CONTEXT = 4

#: Bytes that are scored together.
SLICE_BYTES = 1 << 20

_START = 10  # the line feed stands before every text
_LETTER = re.compile(r"[^\W\d_]")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> dict[str, bytes]:
    """Counts of four-byte runs per language, from about ``sample_docs`` documents of each.

    Rows without text or language are left out; pass only rows that may be learned from.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"),
                       F.col(quoted(lang_col)).cast("string").alias("lang")).filter("text is not null and lang is not null")
    rates = rows.groupBy("lang").agg(F.least(F.lit(1.0), sample_docs / F.count("*")).alias("rate"))
    spot = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < F.col("rate") * (1 << 30)
    # One row a language, as of the models, which every task holds: rows outside the sample are never shuffled.
    sample = rows.join(F.broadcast(rates), "lang").filter(spot).select("lang", "text")

    def count(table: pa.Table) -> pa.Table:
        runs = [_runs(text.encode()) for text in table["text"].to_pylist()]
        keys, counts = np.unique(np.concatenate(runs), return_counts=True)
        return pa.table({"lang": table["lang"][:1], "model": pa.array([packed(keys, counts.astype(np.uint32))], pa.binary())})

    models = sample.groupBy("lang").applyInArrow(count, "lang string, model binary")
    return {row["lang"]: bytes(row["model"]) for row in stored(models, "languages").collect()}


def _runs(text: bytes) -> np.ndarray:
    """Every byte with the three before it, as one number."""
    x = np.frombuffer(bytes([_START] * 3) + text, np.uint8).astype(np.uint32)
    return x[:-3] << 24 | x[1:-2] << 16 | x[2:-1] << 8 | x[3:]


class CodeLengths:
    """Bits of every byte after every context, for all languages side by side."""

    def __init__(self, models: dict[str, bytes]) -> None:
        self.langs = sorted(models)
        counts = [unpacked(models[lang]) for lang in self.langs]
        keys = np.unique(np.concatenate([k for k, _ in counts]))
        places = [(keys >> np.uint32(shift) & np.uint32(255)) for shift in (24, 16, 8, 0)]
        seen = np.unique(np.concatenate([*places, [_START]]))
        self.symbol = np.full(256, len(seen), np.int64)  # bytes never seen share one symbol
        self.symbol[seen] = np.arange(len(seen))
        self.size = size = len(seen) + 1
        often: dict[int, int] = {}
        for k, c in counts:
            contexts, where = np.unique(self._context(k), return_inverse=True)
            often |= dict.fromkeys(contexts[np.bincount(where, c) >= LEAST_CONTEXT].tolist(), 0)
        contexts = np.array(sorted(often), np.int64)
        # The row of a context of three: its own one if it is known, else that of its last two.
        self.row = np.tile(np.arange(size * size, dtype=np.int32), size)
        self.row[contexts] = size * size + np.arange(len(contexts), dtype=np.int32)
        self.bits = np.empty(((size * size + len(contexts)) * size, len(self.langs)), np.float32)
        for number, (k, c) in enumerate(counts):
            self.bits[:, number] = self._lengths(k, c, contexts)

    def _context(self, keys: np.ndarray) -> np.ndarray:
        a, b, c = (self.symbol[keys >> np.uint32(shift) & np.uint32(255)] for shift in (24, 16, 8))
        return (a * self.size + b) * self.size + c

    def _lengths(self, keys: np.ndarray, counts: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        size = self.size
        last, context = self.symbol[keys & np.uint32(255)], self._context(keys)

        def extend(shorter: np.ndarray, seen: np.ndarray) -> np.ndarray:
            total, kinds = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
            whole = np.maximum(total + kinds, 1)
            with np.errstate(divide="ignore"):
                known = -np.log2(seen / whole)
                escaped = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0) + shorter
            return np.where(seen > 0, known, escaped)

        def table(rows: np.ndarray, n: int) -> np.ndarray:
            return np.bincount(rows * size + last, counts, n * size).reshape(n, size)

        zero = extend(np.full((1, size), 8.0), table(np.zeros_like(last), 1))
        one = extend(zero, table(context % size, size))
        two = extend(np.tile(one, (size, 1)), table(context % (size * size), size * size))
        at = np.searchsorted(contexts, context)
        kept = (at < len(contexts)) & (contexts[np.minimum(at, len(contexts) - 1)] == context) if len(contexts) else np.zeros(len(at), bool)
        seen = np.bincount(at[kept] * size + last[kept], counts[kept], len(contexts) * size).reshape(-1, size)
        three = extend(two[contexts % (size * size)], seen)
        return np.concatenate([two, three]).ravel()

    def of(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        found = np.zeros((len(texts), len(self.langs)))
        x = self.symbol[np.frombuffer(b"".join(texts), np.uint8)]
        if not len(x):
            return found
        starts = np.cumsum(sizes) - sizes
        begun = starts[sizes > 0]
        before, context = x, np.zeros(len(x), np.int64)
        for place in range(3):
            before = np.concatenate([[0], before[:-1]])
            for later in range(place + 1):  # what lies before a text's first byte is the start symbol
                inside = begun + later
                inside = inside[(inside < len(x)) & (later < sizes[sizes > 0])]
                before[inside] = self.symbol[_START]
            context += before * self.size ** place
        bits = self.bits[self.row[context].astype(np.int64) * self.size + x]
        found[sizes > 0] = np.add.reduceat(bits, begun, axis=0, dtype=np.float64)
        return found


@functools.lru_cache(maxsize=1)
def _code_lengths(models: tuple[tuple[str, bytes], ...]) -> CodeLengths:
    return CodeLengths(dict(models))


def identified(docs: DataFrame, models: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the shortest code and its share among all languages."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(models.items())))  # four bytes and a count for each run of the sample

    def score(held: list[tuple]) -> Iterator[tuple]:
        model = _code_lengths(shared.value) if shared.value else None
        bits = model.of([text or b"" for _, text in held]) if model else [None] * len(held)
        for (doc_id, text), row in zip(held, bits, strict=True):
            if model is None or text is None or not _LETTER.search(text.decode()):
                yield doc_id, "und", 0.0
            else:
                best = int(row.argmin())
                yield doc_id, model.langs[best], float(1 / np.exp2(np.clip(row[best] - row, -1000, 0)).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            held, size = [], 0
            for batch in batches:
                for row in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    held.append(row)
                    size += len(row[1] or b"")
                    if size >= SLICE_BYTES:
                        yield from score(held)
                        held, size = [], 0
            yield from score(held) if held else ()
        yield from batches_of(out(), schema)

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
