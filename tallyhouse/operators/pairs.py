"""Pairs of every row with every value of a short list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_with(df: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Each row of ``df`` once per value, the value in column ``name``.

    The product of two unbounded tables is not offered; with a list
    the result grows linearly with ``df`` and needs no shuffle.
    """
    literals = F.array(*[F.lit(v) for v in values])
    return df.withColumn(name, F.explode(literals))
