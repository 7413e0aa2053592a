"""Left join of a large table with a table of one row per key.

Small lookups (by the optimizer's size figure) are broadcast, so the large side
is not shuffled. Larger ones are shuffled, after giving the heavy keys salts: those
keys are found in a sample of the large side, each is split into pieces in
proportion to its share, its lookup row is copied to every piece, and all other
keys keep salt 0. Every row is still matched exactly once, whatever the sample says.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Broadcast no lookup whose planned size is above this many bytes.
BROADCAST_LIMIT = 32 * 1024 * 1024

#: Pieces of a heavy key per shuffle partition that it would fill on average.
PIECES = 4

_SALT = "_salt"


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size figure for ``df``. Unknown sizes come back very large."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, keys: Sequence[str], sample: float = 0.01) -> DataFrame:
    """Keys that would fill more than one average shuffle partition, with ``_salts``.

    ``_salts`` is the number of pieces, so that a piece is a fraction of a partition
    whatever the size of the data. Collected once, because both sides of
    the salted join must agree on the list; a listed key has more than one partition's
    share of the sample, so there are fewer keys than partitions. Shares add
    up to 1, so the lookup grows by at most about ``PIECES`` rows per partition.
    """
    parts = shuffle_partitions(df)
    sampled = df.select(*keys)
    if sample < 1.0:
        sampled = sampled.sample(sample, seed=7)
    counts = sampled.groupBy(*keys).agg(F.count("*").alias("n"))
    total = sampled.count()
    top = counts.filter((F.col("n") > 1) & (F.col("n") * parts > total)).collect()
    heavy = [(*(row[k] for k in keys), math.ceil(PIECES * parts * row["n"] / total)) for row in top]
    schema = T.StructType([*df.select(*keys).schema, T.StructField("_salts", T.IntegerType())])
    return df.sparkSession.createDataFrame(heavy, schema)


def left_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str],
                broadcast_limit: int = BROADCAST_LIMIT, sample: float = 0.01,
                keys_from: Callable[[], DataFrame] | None = None) -> DataFrame:
    """``df`` left join ``lookup``, which must hold at most one row per key.

    The heavy keys are sampled from what ``keys_from`` returns, where given: a frame
    with the keys of ``df`` that is cheaper to read, such as the stored table before a
    join. A lookup that proves small only as it runs is still broadcast by adaptive
    execution.
    """
    keys = list(keys)
    if planned_bytes(lookup) <= broadcast_limit:
        return df.join(F.broadcast(lookup), keys, "left")
    heavy = F.broadcast(heavy_keys(keys_from() if keys_from else df, keys, sample))
    # The salt comes from the row and the number of its task's partition, so a
    # re-run task repeats it, and copies of one row part by task.
    spread = F.xxhash64(*df.columns, F.spark_partition_id())
    # A null key matches nothing, so its rows may go anywhere.
    unmatched = reduce(or_, [F.col(k).isNull() for k in keys])
    salts = F.coalesce("_salts", F.when(unmatched, PIECES * shuffle_partitions(df)).otherwise(1))
    big = df.join(heavy, keys, "left").withColumn(
        _SALT, F.when(salts > 1, F.pmod(spread, salts).cast("int")).otherwise(0)).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    small = (lookup.join(heavy, keys, "left")
             .withColumn(_SALT, F.explode(copies)).drop("_salts"))
    return big.join(small, [*keys, _SALT], "left").drop(_SALT)
