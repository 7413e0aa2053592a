"""Seen keys of batch runs in a bucketed table: a run moves its own keys and not the stored ones.

The table is bucketed by the key, so the anti join of a batch reads each bucket where it
lies and shuffles the batch alone. Keys carry the run that brought them: a run that is
repeated after a failure takes no notice of its own keys, finds the same orders new again,
and what it adds twice is one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import events

#: Buckets of a new table: at least the shuffle partitions of the runs, or the planner
#: shuffles both sides for the sake of more tasks. Some 100 million keys a bucket are a sorted file of 2 GB.
BUCKETS = 200


@dataclass(frozen=True)
class SeenKeys:
    """The table ``name`` of the session's catalog, with its files at ``path``."""

    name: str
    path: str
    buckets: int = BUCKETS

    def create(self, spark: SparkSession) -> None:
        """Register the table, over the files that an earlier session left or none."""
        spark.sql(f"create table if not exists {self.name} (position_str string, run string) using parquet "
                  f"clustered by (position_str) sorted by (position_str) into {self.buckets} buckets "
                  f"location '{self.path}'")

    def unseen(self, orders: DataFrame, run: str) -> DataFrame:
        """First orders whose key no other run has brought; joined by merging, bucket by bucket."""
        spark = orders.sparkSession
        before = spark.table(self.name).filter(F.col("run") != run).select("position_str")
        return events.first_seen_orders(orders).join(before.hint("merge"), "position_str", "left_anti")

    def add(self, fresh: DataFrame, run: str) -> None:
        """Note the keys of a run. Rows are dealt as the buckets are, so that a task writes few files."""
        keys = fresh.select("position_str", F.lit(run).alias("run")).repartition(self.buckets, "position_str")
        keys.write.insertInto(self.name)
