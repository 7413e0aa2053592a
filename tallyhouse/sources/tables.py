"""Scans of stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import rules


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               schema: T.StructType | None = None, format: str = "parquet",
               where: Column | None = None, **options) -> DataFrame:
    """Named columns of the table at ``path``; ``where`` reaches the file reader.

    Give ``schema`` for a table of many files: it saves reading a footer first.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if where is not None:
        df = df.filter(where)
    return df if columns is None else df.select(*columns)


def scan_jdbc(spark: SparkSession, url: str, query: str, *, split_on: str | None = None,
              lower: int | None = None, upper: int | None = None, splits: int | None = None,
              **options) -> DataFrame:
    """Rows of a database query (the user supplies the driver jar).

    With ``split_on`` and its bounds the read runs as ``splits`` tasks; the bounds
    place the cuts and drop no row.
    """
    reader = (spark.read.format("jdbc").option("url", url)
              .option("dbtable", f"({query}) q").options(**options))
    if split_on is not None:
        if lower is None or upper is None or splits is None:
            raise ValueError("split_on needs lower, upper and splits")
        reader = (reader.option("partitionColumn", split_on).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", splits))
    return reader.load()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (source, row_count) per table, in one job."""
    counts = [df.agg(F.count("*").alias("row_count"))
              .select(F.lit(name).alias("source"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def observed(df: DataFrame, name: str, amounts: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """``df`` with its rows, and the unreadable values of ``amounts``, counted on the way.

    The counts are in the observation once an action on the frame has run, at no
    extra scan: ``rows`` and ``bad_<column>``.
    """
    seen = Observation(name)
    bad = [F.count_if(rules.is_bad_amount(df, c)).alias(f"bad_{c}") for c in amounts]
    return df.observe(seen, F.count("*").alias("rows"), *bad), seen
