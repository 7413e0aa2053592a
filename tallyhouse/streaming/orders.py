"""Order stream: first order per key, counted and summed per second."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import schemas
from tallyhouse.operators import events
from tallyhouse.operators.keepone import keep_first
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.streaming import jobs

#: Parts of the state whose new rows share a file of a batch.
STATE_PARTS_A_FILE = 16


def new_orders(orders: DataFrame) -> DataFrame:
    """Per micro-batch, the orders whose key was never seen before (update mode).

    The state holds each key's first order and the times of the first and of the
    latest micro-batch that had the key; they are equal only in the batch where the
    key is new. Rows of one key are reduced in the map tasks before they reach the
    state, so a key that makes up much of a batch is no hot spot, and a batch costs
    as much as its own keys, whatever the number of keys already seen. The batch time
    is the engine's own, kept in its log, so a repeated batch has the same one; it has
    to differ between batches, which holds while the driver's clock is not set back.
    """
    stamped = orders.withColumn("_batch", F.current_timestamp())
    first = F.min_by(F.struct(*schemas.ORDER, "entrust_time", "balance"), F.struct("_batch", *schemas.ORDER))
    return (stamped.groupBy("position_str")
            .agg(first.alias("_first"), F.min("_batch").alias("_since"),
                 F.max("_batch").alias("_latest"))
            .filter(F.col("_since") == F.col("_latest"))
            .select("position_str", "_first.*"))


def new_orders_within(orders: DataFrame, delay: str) -> DataFrame:
    """Like :func:`new_orders` with state that forgets keys ``delay`` after their time.

    A key that returns later counts as new, and any one of its rows in a
    micro-batch is kept. Needs ``load_ts``.
    """
    return (orders.withWatermark("load_ts", delay)
            .dropDuplicatesWithinWatermark(["position_str"])
            .select(*schemas.FIRST_SEEN.fieldNames()))


def seen_table(path: str) -> BatchTable:
    return BatchTable(path, schemas.FIRST_SEEN, ["position_str"],
                      lambda df: keep_first(df, ["position_str"], *schemas.ORDER).select(*df.columns))


def totals_table(path: str) -> BatchTable:
    return BatchTable(path, schemas.SECOND_TOTALS, ["init_date", "load_time"], _add_up)


def start_orders(messages: DataFrame, seen_path: str, totals_path: str, checkpoint: str,
                 every: str | None = "5 seconds", forget_after: str | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Run the order stream.

    Each batch writes its new orders, then their per-second totals from what it wrote, each
    to a folder of the batch's number, and folds earlier batches when they are many. A batch
    repeated after a failure replaces both folders, so no order is lost or counted twice.
    """
    spark = messages.sparkSession
    jobs.prepare_state(spark)
    parsed = events.parse_events(messages)
    if forget_after is None:
        fresh, mode = new_orders(events.order_events(parsed)), "update"
    else:
        timed = events.order_events(parsed).withColumn(
            "load_ts", F.try_to_timestamp("timeload", F.lit("yyyy-MM-dd HH:mm:ss")))
        fresh, mode = new_orders_within(timed, forget_after), "append"

    seen, totals = seen_table(seen_path), totals_table(totals_path)
    origin = jobs.origin(spark, seen_path, checkpoint, [seen, totals])

    def write(batch: DataFrame, batch_id: int) -> None:
        number = origin + batch_id
        # The stateful plan runs once, with as many tasks as the state has parts; its few
        # new rows go to fewer files.
        seen.write(batch.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // STATE_PARTS_A_FILE)), number)
        totals.write(events.per_second(seen.batch(spark, number)), number)
        for table in (seen, totals):
            table.fold_before(spark, number)

    return jobs.start(fresh.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every,
                      spark, state_partitions)


def start_second_totals(messages: DataFrame, path: str, checkpoint: str, late_after: int, ahead: int = 0,
                        skew: int = 60, every: str | None = "5 seconds",
                        state_partitions: int | None = None) -> StreamingQuery:
    """Totals of each second by the orders' own times, in one query and with bounded state.

    Orders whose message came more than ``late_after`` seconds after their own time, or more
    than ``ahead`` seconds before it, are left out here and listed by the rejects stream
    (``late_after``, ``ahead`` there). A second is written once, when no order in time can
    still come: ``late_after + ahead + skew`` seconds after it, ``skew`` being how far the
    partitions' message times may be apart while they are read. With messages further out
    of order than that, the engine drops the orders of seconds already written and counts
    them in its progress (``numRowsDroppedByWatermark``). Times without a zone are of the session's.

    State holds one row per key and second not yet written, so it grows with the rate of
    orders and not with their history. A repeated batch replaces its folder.
    """
    spark = messages.sparkSession
    jobs.prepare_state(spark)
    timely = events.timely_orders(events.order_events(events.parse_events(messages)), late_after, ahead)
    closed = events.windowed_totals(timely.withWatermark("order_ts", f"{late_after + ahead + skew} seconds"))
    totals = totals_table(path)
    origin = jobs.origin(spark, path, checkpoint, [totals])

    def write(batch: DataFrame, batch_id: int) -> None:
        totals.write(batch, origin + batch_id)
        totals.fold_before(spark, origin + batch_id)

    return jobs.start(closed.writeStream.outputMode("append").foreachBatch(write), checkpoint, every,
                      spark, state_partitions)


def read_seen(spark: SparkSession, seen_path: str) -> DataFrame:
    """First order of every key seen so far."""
    return seen_table(seen_path).read(spark)


def _add_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("init_date", "load_time").agg(
        F.sum("entrust_num").alias("entrust_num"), F.sum("balance").cast("decimal(38,4)").alias("balance"))


def read_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """One row per second: the parts that the batches wrote, added up."""
    return totals_table(totals_path).read(spark)
