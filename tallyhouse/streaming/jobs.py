"""What the streaming jobs share."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyhouse.session import SETTINGS
from tallyhouse.sinks import pointers
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.streaming.ledger import ledger_table, read_until

_STATE_KEYS = [k for k in SETTINGS if ".stateStore." in k]


def prepare_state(spark: SparkSession) -> None:
    """Keep state in RocksDB unless the session already says where to keep it."""
    for key in _STATE_KEYS:
        if spark.conf.get(key, None) in (None, _default_provider(key)):
            spark.conf.set(key, SETTINGS[key])


def _default_provider(key: str) -> str | None:
    if key.endswith("providerClass"):
        return "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    return "false"


def start(writer: DataStreamWriter, checkpoint: str, every: str | None,
          spark: SparkSession | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start with a processing-time trigger, or without ``every`` take what is there and stop.

    ``state_partitions`` is the number of parts the state is kept in, the session's
    shuffle partitions by default; the first run of a checkpoint settles it.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = writer.trigger(**trigger)
    if spark is None or state_partitions is None:
        return writer.start()
    # The query copies the session's settings as it starts.
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    spark.conf.set(name, state_partitions)
    try:
        return writer.start()
    finally:
        spark.conf.set(name, usual)


def origin(spark: SparkSession, path: str, checkpoint: str, tables: Sequence[BatchTable]) -> int:
    """What to add to the batch numbers of a stream with this checkpoint.

    A stream that starts anew, from saved offsets or because its checkpoint is lost, counts
    its batches from 0 again; its folders go on after the last ones of the tables. A stream
    that goes on keeps the number it was given, which stands in a note beside ``path``.
    """
    notes = f"{path}/_origins"
    number, text = pointers.latest(spark, notes)
    known = {} if text is None else json.loads(text)
    begun = bool(pointers.children(spark, f"{checkpoint.rstrip('/')}/offsets"))
    if not begun or checkpoint not in known:
        if begun:
            raise ValueError(f"{checkpoint} belongs to another table than {path}")
        known[checkpoint] = 1 + max(table.last_batch(spark) for table in tables)
        pointers.advance(spark, notes, number + 1, json.dumps(known))
    return known[checkpoint]


def start_table(messages: DataFrame, table: BatchTable, rows_of: Callable[[DataFrame], DataFrame], checkpoint: str,
                every: str | None, group: str, ledger: str | None) -> StreamingQuery:
    """Keep ``table`` from a stream without state: ``rows_of`` makes a batch's rows from its messages.

    With ``ledger`` (a path) each batch also notes how far it read, after its rows are
    written; its messages are kept on the executors for that second pass.
    """
    spark = messages.sparkSession
    book = None if ledger is None else ledger_table(ledger)
    start_at = origin(spark, table.path, checkpoint, [table] if book is None else [table, book])

    def write(batch: DataFrame, batch_id: int) -> None:
        number = start_at + batch_id
        if book is None:
            table.write(rows_of(batch), number)
        else:
            held = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                table.write(rows_of(held), number)
                book.write(read_until(held, group), number)
            finally:
                held.unpersist()
            book.fold_before(spark, number)
        table.fold_before(spark, number)

    return start(messages.writeStream.foreachBatch(write), checkpoint, every)
