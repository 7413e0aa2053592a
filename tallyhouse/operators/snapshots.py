"""Last-day snapshots: keep non-zero values and replace the stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.sinks.keyed import read_keyed, write_keyed


def split_rowkey(snapshot: DataFrame, *names: str) -> DataFrame:
    """The pieces of a joined row key as columns, in place of the key."""
    return snapshot.select(*[rules.key_part("rowkey", i).alias(n) for i, n in enumerate(names)],
                           *[c for c in snapshot.columns if c != "rowkey"])


def snapshot_rows(snapshot: DataFrame, value: str = "value") -> DataFrame:
    """Snapshot rows with a number other than 0 in ``value`` (empty is 0)."""
    return snapshot.withColumn(value, rules.amount(snapshot, value)).filter(F.col(value) != 0)


def snapshot_totals(snapshot: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Snapshot summed to coarser ``keys``, without zeros."""
    total = (snapshot.withColumn(value, rules.amount(snapshot, value))
             .groupBy(*keys).agg(F.sum(value).alias(value)))
    return total.filter(F.col(value) != 0)


def load_snapshot(snapshot: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Replace the table at ``path`` by ``snapshot`` and read it back.

    Written by the tasks themselves; nothing passes through the driver. A load that fails
    leaves the last snapshot as it was.
    """
    write_keyed(snapshot, path, keys)
    return read_keyed(snapshot.sparkSession, path, snapshot.schema)
