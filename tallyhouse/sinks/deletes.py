"""Equality deletes of a batch table: records kept beside it, applied on reading.

A delete names a column, a value and the moment up to which rows fall. It rewrites nothing:
readers drop the standing rows that it names by an anti join, after the batches are
combined, so that an older row of a key does not come back in place of a deleted one.
:func:`purge` folds the whole table without the deleted rows and drops the records.
One job deletes at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.sinks.batches import BatchTable

RECORDS = T.StructType([T.StructField("column", T.StringType()), T.StructField("value", T.StringType()),
                        T.StructField("at", schemas.AT)])


def _furthest(records: DataFrame) -> DataFrame:
    return records.groupBy("column", "value").agg(F.max("at").alias("at"))


def records_of(table: BatchTable) -> BatchTable:
    return BatchTable(f"{table.path}/deletes", RECORDS, ["column", "value"], _furthest)


def delete_where(spark: SparkSession, table: BatchTable, column: str, values: Sequence[str] | DataFrame,
                 upto: str | None = None) -> None:
    """Delete the rows whose ``column`` is one of ``values`` (a list, or a frame's first column)
    and whose message is not after ``upto``, the present by default."""
    if column not in table.schema.fieldNames():
        raise ValueError(f"{table.path} has no column {column}")
    if not isinstance(values, DataFrame):
        values = spark.createDataFrame([(v,) for v in values], "value string")
    until = F.current_timestamp() if upto is None else F.to_timestamp(F.lit(upto))
    # A message at that very moment falls too: the letters after any topic's.
    at = F.struct(until.alias("message_time"), F.lit("\U0010ffff").alias("topic"), F.lit(0).alias("partition"),
                  F.lit(0).cast("long").alias("offset"))
    records = values.select(F.lit(column).alias("column"), F.col(values.columns[0]).cast("string").alias("value"), at.alias("at"))
    own = records_of(table)
    own.write(records.filter("value is not null").distinct(), own.last_batch(spark) + 1)


def standing(rows: DataFrame, records: DataFrame) -> DataFrame:
    """``rows`` without those that the records delete. One anti join for each column named."""
    for (column,) in records.select("column").distinct().collect():
        gone = records.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("at").alias("_at"))
        hit = (F.col(column).cast("string") == F.col("_value")) & (F.struct(*schemas.ORDER) <= F.col("_at"))
        rows = rows.join(gone, hit, "left_anti")
    return rows


def read_standing(spark: SparkSession, table: BatchTable) -> DataFrame:
    """The rows of the table that no delete has taken."""
    return standing(table.read(spark), records_of(table).read(spark))


def purge(spark: SparkSession, table: BatchTable, before: int) -> None:
    """Fold the whole table up to the batch ``before``, which must not have begun, without the
    rows deleted so far. The deletes stay on record: a message that is read late and lies
    before one of them still falls."""
    records = records_of(table)
    clean = replace(table, combine=lambda df: standing(table.combine(df), records.read(spark)))
    clean.fold(spark, before, whole=True)
    records.fold(spark, records.last_batch(spark) + 1)
