"""Change events: parse, filter, keep one per key, total. Batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions import rules
from tallyhouse.operators.keepone import keep_first, keep_last


def parse_events(messages: DataFrame) -> DataFrame:
    """Messages as typed events.

    ``columnInfo`` may be an object or text holding one. A message of which either
    part does not parse keeps its text in ``corrupt``: the jobs leave it out and
    :func:`rejected_events` lists it.
    """
    keep_bad = {"columnNameOfCorruptRecord": "_corrupt_record"}
    envelope = F.from_json("value", schemas.ENVELOPE, keep_bad)
    info = F.from_json("_e.columnInfo", schemas.COLUMN_INFO, keep_bad)
    # Exploding an array of one keeps a later filter from being merged with the
    # parsing, which would then run once for every field that the filter tests. A
    # filter on the envelope alone still moves in front of the second parse.
    opened = (messages.select("*", F.explode(F.array(envelope)).alias("_e"))
              .select("*", F.explode(F.array(info)).alias("_c")))
    is_bad = F.col("_e._corrupt_record").isNotNull() | F.col("_c._corrupt_record").isNotNull()
    names = [n for n in schemas.COLUMN_INFO.fieldNames() if n != "_corrupt_record"]
    typed = opened.select(
        *schemas.ORDER,
        F.col("_e.Tablename").alias("tablename"),
        F.col("_e.operType").alias("oper_type"),
        F.col("_e.timeload").alias("timeload"),
        F.try_to_timestamp("_e.timeload", F.lit("yyyy-MM-dd HH:mm:ss")).alias("load_ts"),
        *[F.col(f"_c.{n}").alias(n.lower()) for n in names],
        F.when(is_bad, F.col("value")).alias("corrupt"),
    )
    return typed.withColumns({c: rules.amount(typed, c)
                              for c in ("business_balance", "occur_balance")})


def untimely(second: Column, late_after: int, ahead: int) -> Column:
    """Why an order of ``second`` cannot take part in totals by that time, null if it can.

    It is late if its message came more than ``late_after`` seconds after its own time, and
    early if its own time is more than ``ahead`` seconds after the message's. Each row is
    judged by itself, so the verdict is the same however the stream is cut into batches, and
    the job that counts the others and the job that lists these always agree.
    """
    time = rules.second_time(second)
    lag = F.unix_micros("message_time") - F.unix_micros(time)
    return (F.when(time.isNull(), "no time").when(F.col("message_time").isNull(), "no message time")
            .when(lag > late_after * 1_000_000, "late").when(lag < -ahead * 1_000_000, "early"))


def rejected_events(events: DataFrame, late_after: int | None = None, ahead: int = 0) -> DataFrame:
    """Messages that the order and transfer jobs want and cannot use: where each came from
    and why, with the text of those that do not parse.

    Orders and transfers without a key, and orders without a time, are left out of their
    tables too: all rows without a key would pass for one. With ``late_after`` the orders
    that the totals by event time leave out are listed as well.
    """
    is_order = rules.is_order_event()
    reason = (F.when(F.col("corrupt").isNotNull(), "unreadable")
              .when((is_order | rules.is_transfer_event()) & F.col("position_str").isNull(), "no key")
              .when(is_order & rules.entrust_time().isNull(), "no time"))
    if late_after is not None:
        reason = reason.when(is_order, untimely(rules.entrust_time(), late_after, ahead))
    return (events.select("topic", "partition", "offset", reason.alias("reason"), "corrupt")
            .filter("reason is not null"))


def order_events(events: DataFrame) -> DataFrame:
    """Order inserts and updates with their second and value."""
    usable = F.col("position_str").isNotNull() & rules.entrust_time().isNotNull()
    return (events.filter(F.col("corrupt").isNull() & rules.is_order_event() & usable)
            .select("position_str", *schemas.ORDER, "timeload", rules.entrust_time().alias("entrust_time"),
                    F.col("business_balance").alias("balance")))


def latest_orders(orders: DataFrame) -> DataFrame:
    """The order with the greatest ``timeload`` per key; the first to arrive if equal."""
    first = keep_first(orders, ["position_str", "timeload"], *schemas.ORDER)
    return keep_last(first, ["position_str"], "timeload").select(*orders.columns)


def first_seen_orders(orders: DataFrame) -> DataFrame:
    """The first order ever to arrive per key; later updates do not count."""
    return keep_first(orders, ["position_str"], *schemas.ORDER)


def unseen_orders(orders: DataFrame, seen: DataFrame) -> DataFrame:
    """First orders whose key is not in the ``seen`` table yet, for a batch run.

    Reduced to one row per key before the join, so no key is heavy in it.
    """
    return first_seen_orders(orders).join(seen.select("position_str"), "position_str", "left_anti")


def per_second(orders: DataFrame) -> DataFrame:
    """Number and value of the orders of each second."""
    return (orders.groupBy("entrust_time")
            .agg(F.count("*").alias("entrust_num"), F.sum("balance").alias("balance"))
            .select(F.substring("entrust_time", 1, 8).alias("init_date"),
                    F.substring("entrust_time", 9, 6).alias("load_time"),
                    "entrust_num", F.col("balance").cast("decimal(38,4)").alias("balance")))


def timely_orders(orders: DataFrame, late_after: int, ahead: int) -> DataFrame:
    """Orders whose messages came in time, with that time as ``order_ts``."""
    second = F.col("entrust_time")
    return orders.filter(untimely(second, late_after, ahead).isNull()).withColumn("order_ts", rules.second_time(second))


def windowed_totals(orders: DataFrame) -> DataFrame:
    """Number and value of the orders of each second of ``order_ts``, by windows that chain.

    First the orders of one key and second are reduced to the first of them, then those of
    a second are added up. Both are aggregates over the same windows, so a stream closes and
    forgets them together once the watermark has passed, and a key or a second with much of
    the rows sends one row a task to either. A key that names two seconds counts in each.
    """
    first = F.min_by("balance", F.struct(*schemas.ORDER))
    once = (orders.groupBy(F.window("order_ts", "1 second").alias("_second"), "position_str")
            .agg(first.alias("balance")))
    totals = (once.groupBy(F.window(F.window_time("_second"), "1 second").alias("_second"))
              .agg(F.count("*").alias("entrust_num"), F.sum("balance").alias("balance")))
    return totals.select(F.date_format("_second.start", "yyyyMMdd").alias("init_date"),
                         F.date_format("_second.start", "HHmmss").alias("load_time"),
                         "entrust_num", F.col("balance").cast("decimal(38,4)").alias("balance"))


def transfer_events(events: DataFrame) -> DataFrame:
    """Bank transfers of the fund journal.

    Only the journal's own events: transfers reported by the bank's table are left
    out, as the running job does.
    """
    usable = F.col("corrupt").isNull() & F.col("position_str").isNotNull()
    return (events.filter(usable & rules.is_transfer_event())
            .select("position_str", *schemas.ORDER, F.col("timeload").alias("load_time"),
                    F.col("occur_balance").alias("balance"), "fund_account", "money_type"))


def transfer_changes(transfers: DataFrame) -> DataFrame:
    """Transfers reduced to one change per key: the first load time, the last values."""
    last = F.struct("load_time", "balance", "fund_account", "money_type")
    at = F.struct(*schemas.ORDER)
    return (transfers.groupBy("position_str").agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        F.min_by("load_time", at).alias("init_time"), F.max_by(last, at).alias("_last"))
        .select("position_str", "first_at", "last_at", "init_time", "_last.*"))


def merge_transfers(changes: DataFrame) -> DataFrame:
    """Changes of any number of batches merged to one row per key.

    Ordered by the messages' own order only, so merging is associative and repeating a
    batch, or splitting it, does not change the result.
    """
    values = [c for c in ("load_time", "balance", "fund_account", "money_type", "biz_dt")
              if c in changes.columns]
    return (changes.groupBy("position_str").agg(
        F.min_by("init_time", "first_at").alias("init_time"),
        F.max_by(F.struct(*values), "last_at").alias("_last"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
        .select("position_str", "first_at", "last_at", "init_time", "_last.*"))
