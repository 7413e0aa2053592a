"""Keyed result tables in Parquet, and writers for outside stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sinks import pointers, versions

#: Rows handed to an outside store at once.
BLOCK_ROWS = 10_000


Watch = Callable[[DataFrame], DataFrame]


def _store(keys: Sequence[str], watch: Watch | None) -> Callable[[DataFrame, str], None]:
    def write(df: DataFrame, folder: str) -> None:
        dealt = df.repartitionByRange(*keys)
        (dealt if watch is None else watch(dealt)).sortWithinPartitions(*keys).write.option(
            f"parquet.bloom.filter.enabled#{keys[0]}", "true").parquet(folder)
    return write


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], watch: Watch | None = None) -> None:
    """Replace the table at ``path`` by a new version of it (:mod:`~tallyhouse.sinks.versions`).

    Rows are dealt to files by ranges of the keys and sorted in them, so that no two files
    or row groups span the same keys and a lookup reads the few that hold its key; the
    first key has a Bloom filter. That is one shuffle of the result, whose ranges come from
    a sample; ``watch`` may add an observation to the rows on their way to the files, where
    each passes once.
    """
    versions.replace(df, path, _store(keys, watch))


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a keyed table as they were last replaced."""
    return versions.read(spark, path, schema)


def date_path(path: str, biz_date: str) -> str:
    return f"{path}/biz_date={biz_date}"


def write_for_date(df: DataFrame, path: str, keys: Sequence[str], biz_date: str,
                   watch: Watch | None = None) -> None:
    """Replace one business date of the table at ``path``; other dates stay.

    A date is a table with versions of its own, so an empty result clears it too.
    """
    write_keyed(df, date_path(path, biz_date), keys, watch)


def read_for_date(spark: SparkSession, path: str, biz_date: str) -> DataFrame:
    """Rows of one business date; other dates' files are not opened."""
    return read_keyed(spark, date_path(path, biz_date))


def read_dates(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every business date, with ``biz_date`` as text."""
    dates = [n for n in pointers.children(spark, path) if n.startswith("biz_date=")]
    folders = [versions.current(spark, f"{path}/{name}") for name in dates]
    date = F.regexp_extract("_metadata.file_path", "/biz_date=([^/]+)/", 1)
    return spark.read.parquet(*folders).withColumn("biz_date", date)


def lookup(table: DataFrame, **key: str) -> DataFrame:
    """Rows of a keyed table by equality on each key column given."""
    for name, value in key.items():
        table = table.filter(F.col(name) == value)
    return table


def write_blocks(df: DataFrame, send: Callable[[list[dict]], None],
                 block_rows: int = BLOCK_ROWS) -> None:
    """Hand the rows of each partition to ``send`` in blocks, for an outside store.

    ``send`` runs in the tasks and may be called again for the same rows after a
    failure, so it should upsert by key.
    """
    def send_partition(rows) -> None:
        block: list[dict] = []
        for row in rows:
            block.append(row.asDict())
            if len(block) >= block_rows:
                send(block)
                block = []
        if block:
            send(block)

    df.foreachPartition(send_partition)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               block_rows: int = BLOCK_ROWS, **options) -> None:
    """Write to a database table (the user supplies the driver jar)."""
    (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
     .option("batchsize", block_rows).options(**options).save())
