"""Rejects stream: the messages that the other jobs leave out, each with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import schemas
from tallyhouse.operators import events
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.streaming import jobs

GROUP = "rejects"


def rejects_table(path: str) -> BatchTable:
    # A message read again after a restart is the same reject.
    return BatchTable(path, schemas.REJECTS, ["topic", "partition", "offset"], DataFrame.distinct)


def start_rejects(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds",
                  ledger: str | None = None, late_after: int | None = None, ahead: int = 0) -> StreamingQuery:
    """Run the rejects stream beside the job that reads the same messages.

    With ``late_after`` it also lists what the totals by event time leave out.
    It has its own checkpoint and keeps no state; a repeated batch replaces its folder.
    """
    def rejected(batch: DataFrame) -> DataFrame:
        return events.rejected_events(events.parse_events(batch), late_after, ahead)

    return jobs.start_table(messages, rejects_table(path), rejected, checkpoint, every, GROUP, ledger)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Every message rejected so far."""
    return rejects_table(path).read(spark)
