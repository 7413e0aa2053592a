"""Tables written by micro-batches and folded while the stream runs.

Each batch has a folder of its own number, which a batch that is run again replaces. Every
``every`` batches the folders are folded into one run of the first level, and ``fan`` runs
of a level into one of the next, so that a table of any age has a bounded number of
folders. A run is dealt by ranges of the table's keys and sorted by them.

What a table consists of stands in its last note (:mod:`~tallyhouse.sinks.pointers`): the
runs, and the batch up to which they go. Later batches are found by their folders' names.
A fold takes the batches before the running one only, which are committed: it writes a new
run first and then the note. So a fold that breaks leaves the table as it was, one that is
repeated finds its batches folded, and a batch run again replaces its own folder, whatever
was folded. Folders replaced by a fold are deleted by the next one, so that readers that
resolved the table before are not disturbed.

``combine`` reduces rows, of batches or of runs, to rows of the same columns; it has to be
associative.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.sinks import pointers

BATCHES, RUNS = "batches", "runs"

#: Batches to a fold, and runs of a level to a run of the next.
FOLD_EVERY, FAN = 20, 8


def _same(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class BatchTable:
    """A table at ``path`` with ``schema``, sorted by ``keys``, whose rows ``combine`` reduces."""

    path: str
    schema: T.StructType
    keys: Sequence[str]
    combine: Callable[[DataFrame], DataFrame] = _same
    every: int = FOLD_EVERY
    fan: int = FAN

    def _manifest(self, spark: SparkSession) -> tuple[int, dict]:
        number, text = pointers.latest(spark, self.path)
        return number, {"upto": -1, "runs": [], "replaced": []} if text is None else json.loads(text)

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{BATCHES}/{batch_id:012d}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Replace one batch. Adaptive execution sizes the files, so a small batch is one."""
        rows = df.select(*self.schema.fieldNames()).hint("rebalance")
        rows.write.mode("overwrite").parquet(self._folder(batch_id))

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self._folder(batch_id))

    def folders(self, spark: SparkSession) -> list[str]:
        """The folders that make up the table now."""
        _, manifest = self._manifest(spark)
        later = [b for b in self._batches(spark) if b > manifest["upto"]]
        return [f"{self.path}/{RUNS}/{run['name']}" for run in manifest["runs"]] + [self._folder(b) for b in later]

    def _batches(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in pointers.children(spark, f"{self.path}/{BATCHES}") if n.isdigit()]

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the table: what ``combine`` makes of its runs and batches."""
        return self.combine(self._read(spark, self.folders(spark)))

    def last_batch(self, spark: SparkSession) -> int:
        """Number of the last batch written or folded, -1 before the first."""
        return max([self._manifest(spark)[1]["upto"], *self._batches(spark)])

    def fold_before(self, spark: SparkSession, batch_id: int) -> bool:
        """Fold the batches before ``batch_id``, which is running, if there are ``every`` of them."""
        _, manifest = self._manifest(spark)
        due = [b for b in self._batches(spark) if manifest["upto"] < b < batch_id]
        return len(due) >= self.every and self.fold(spark, batch_id)

    def fold(self, spark: SparkSession, before: int, whole: bool = False) -> bool:
        """Fold all batches below ``before``, which must be committed. False if there are none.

        With ``whole`` every run is folded with them, into one.
        """
        number, manifest = self._manifest(spark)
        due = [b for b in self._batches(spark) if manifest["upto"] < b < before]
        if not due and not whole:
            return False
        upto = due[-1] if due else manifest["upto"]
        runs, level = list(manifest["runs"]), 1
        sources, replaced = [self._folder(b) for b in due], []
        # With the new one there are ``fan`` runs of a level.
        while runs if whole else sum(run["level"] == level for run in runs) >= self.fan - 1:
            merged = [run for run in runs if run["level"] == level]
            runs = [run for run in runs if run["level"] != level]
            replaced += [run["name"] for run in merged]
            sources += [f"{self.path}/{RUNS}/{run['name']}" for run in merged]
            level += 1
        name = f"level-{level}-{upto:012d}-{uuid.uuid4().hex[:8]}"
        rows = self.combine(self._read(spark, sources)).select(*self.schema.fieldNames())
        rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.parquet(f"{self.path}/{RUNS}/{name}")
        new = {"upto": upto, "runs": [*runs, {"name": name, "level": level}], "replaced": replaced}
        pointers.advance(spark, self.path, number + 1, json.dumps(new))
        # What the fold before this one replaced, and runs that no note names.
        known = {run["name"] for run in new["runs"]} | set(replaced)
        for run in pointers.children(spark, f"{self.path}/{RUNS}"):
            if run not in known:
                pointers.remove(spark, f"{self.path}/{RUNS}/{run}")
        for b in self._batches(spark):
            if b <= manifest["upto"]:
                pointers.remove(spark, self._folder(b))
        pointers.forget(spark, self.path, number)
        return True
