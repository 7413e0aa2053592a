"""Offset ledger: how far a stream has read, in a table that outlives its checkpoint.

Each micro-batch adds, under its number, the next offset of every topic and partition that
it read. A batch run again replaces its rows, folding keeps the greatest, so the table is
the same however often a batch ran. The rows are written after the batch's results: a
stream that starts from the ledger alone may read the last batch again, never skip it, and
the tables take repeats without harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.sinks.batches import BatchTable


def _furthest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("group_id", "topic", "partition").agg(F.max("until_offset").alias("until_offset"))


def ledger_table(path: str) -> BatchTable:
    return BatchTable(path, schemas.OFFSETS, ["group_id", "topic", "partition"], _furthest)


def read_until(messages: DataFrame, group: str) -> DataFrame:
    """Next offset after the messages of a batch, per topic and partition."""
    return (messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until_offset"))
            .select(F.lit(group).alias("group_id"), "topic", "partition", "until_offset"))


def offset_progress(spark: SparkSession, path: str) -> DataFrame:
    """Next offset to read per (group, topic, partition)."""
    return ledger_table(path).read(spark)


def unread(messages: DataFrame, spark: SparkSession, path: str, group: str) -> DataFrame:
    """Messages beyond the ledger of ``group``, for sources that cannot start at offsets.

    The ledger has a row for each partition of a topic, so it is small beside the messages.
    """
    done = offset_progress(spark, path).filter(F.col("group_id") == group).drop("group_id")
    joined = messages.join(done, ["topic", "partition"], "left")
    return (joined.filter(F.col("until_offset").isNull() | (F.col("offset") >= F.col("until_offset")))
            .select(*messages.columns))
