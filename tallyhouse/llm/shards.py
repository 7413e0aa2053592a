"""Uniform shuffle of documents into shards of exact sizes (counts at most one apart).

The counts that each input partition sends to each shard are drawn from the
multivariate hypergeometric law: they add up to the partitions' rows and to the
shards' sizes. A partition permutes its rows and cuts them by its counts; a shard
permutes what arrives. Together every assignment of rows to slots is as likely as any
other, and no shard can come out larger than its size.

Null texts have 1 byte and the checksum of nothing. Repeated rows, equal texts and null
ids are dealt like any other rows, each by itself. An empty table gives an empty
result; columns other than id and text do not take part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_text, stored

#: Rows of a shard that are put in order together.
BUCKET_ROWS = 4096

#: Rows from which the library's hypergeometric draw refuses.
MOST_COLOURS = 1_000_000_000


def exact_counts(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Partition-to-shard counts with the given row sums; column sums at most one apart."""
    draw, total = np.random.default_rng(seed), sum(rows)
    left = np.full(shards, total // shards, np.int64)
    left[draw.permutation(shards)[:total % shards]] += 1
    if total >= MOST_COLOURS:
        return dealt_counts(rows, left, draw)
    counts = np.zeros((len(rows), shards), np.int64)
    for part, n in enumerate(rows):
        counts[part] = draw.multivariate_hypergeometric(left, n, method="marginals")
        left -= counts[part]
    return counts


def dealt_counts(rows: list[int], sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """The same law for any number of rows: every row is dealt to a shard by itself, then
    rows of the shards that are too large, picked evenly, move to those that are too small.

    No step tells one row from another, so all assignments of these sizes are as likely.
    The rows that move are some square root of all rows.
    """
    shares = np.full(len(sizes), 1 / len(sizes))
    counts = np.stack([draw.multinomial(n, shares) for n in rows])
    over = counts.sum(0) - sizes
    moved = []
    for shard in np.flatnonzero(over > 0):
        ends = np.cumsum(counts[:, shard])
        picked = np.searchsorted(ends, draw.choice(int(ends[-1]), int(over[shard]), replace=False), side="right")
        counts[:, shard] -= np.bincount(picked, minlength=len(rows))
        moved.append(picked)
    if moved:
        targets = np.repeat(np.arange(len(sizes)), np.maximum(-over, 0))
        np.add.at(counts, (np.concatenate(moved), draw.permutation(targets)), 1)
    return counts


def shuffled(docs: DataFrame, shards: int = 16, seed: int = 11, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per document.

    The partitions' row counts (one number for each input split) and the shards' bucket
    counts are all that the driver sees.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # Numbers are stored with the rows, so that every later job sees the same ones.
    rows = stored(id_text(docs, id_col, text_col).select(
        "id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    rows = rows.withColumn("part", F.shiftright("row", 33))
    counted = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    counts = exact_counts(list(counted.values()), shards, seed)
    ends = spark.createDataFrame([(part, c.tolist()) for part, c in zip(counted, np.cumsum(counts, axis=1), strict=True)],
                                 "part long, ends array<long>")
    local = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("row", F.lit(seed)), "row"))
    cut = (rows.withColumn("at", local).join(ends, "part")
           .withColumn("shard", F.size(F.filter("ends", lambda end: end < F.col("at")))))
    buckets = max(1, sum(counted.values()) // (shards * BUCKET_ROWS))
    key = F.xxhash64("row", F.lit(seed + 1))
    dealt = cut.select("id", "size", "crc", "row", "shard", key.alias("key"),
                       F.pmod(F.xxhash64("row", F.lit(seed + 2)), F.lit(buckets)).alias("bucket"))
    dealt = stored(dealt, "shard-dealt")
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("key", "row"))
    return (dealt.withColumn("inside", inside).join(first, ["shard", "bucket"])
            .select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("first") + F.col("inside") - 1).alias("slot")))
