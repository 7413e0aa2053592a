"""Bank-transfer stream: one row per transfer, updated in place as events come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import schemas
from tallyhouse.operators import events
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.streaming import jobs

GROUP = "transfers"


def transfers_table(path: str) -> BatchTable:
    return BatchTable(path, schemas.TRANSFERS, ["position_str"], events.merge_transfers)


def start_transfers(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds",
                    ledger: str | None = None) -> StreamingQuery:
    """Run the transfer stream.

    Each micro-batch writes one change per key it touched, so its cost does not
    grow with the table; :func:`read_transfers` merges the changes. Changes keep the order
    of their messages, so a repeated batch or message leaves the table as it was. With
    ``ledger`` the offsets read are kept in a table, too.
    """
    def changes(batch: DataFrame) -> DataFrame:
        transfers = events.transfer_events(events.parse_events(batch))
        return events.transfer_changes(transfers).withColumn("biz_dt", F.current_timestamp())

    return jobs.start_table(messages, transfers_table(path), changes, checkpoint, every, GROUP, ledger)


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """The merged table."""
    return transfers_table(path).read(spark)
