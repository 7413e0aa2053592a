"""One row per key, chosen by an order.

Written as ``max_by``/``min_by`` aggregates rather than as ranked windows: they
reduce inside each map task before the shuffle, so a key that holds a large part
of all rows still sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # A struct is never null itself, so rows with a null order still count.
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*")


def keep_last(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The row with the greatest ``order`` of each key."""
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The row with the least ``order`` of each key."""
    return _keep(df, keys, order, F.min_by)
