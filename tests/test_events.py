"""Parsing, filters and keep-one rules of change events, in batch."""

import json
from datetime import datetime
from decimal import Decimal
from functools import reduce

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame

from tallyhouse import schemas
from tallyhouse.operators import documents, events


def message(offset, table="ENTRUST", op="I", quoted=False, time="2024-01-02 09:30:00", at=None, topic="t", partition=0, **info):
    body = {"POSITION_STR": "p", "INIT_DATE": "20240102", "CURR_TIME": "93000123",
            "BUSINESS_BALANCE": "10", "FUND_ACCOUNT": "a", "MONEY_TYPE": "0", "BUSINESS_FLAG": "2041",
            "OCCUR_BALANCE": "5", **info}
    envelope = {"Tablename": table, "operType": op, "timeload": time,
                "columnInfo": json.dumps(body) if quoted else body}
    return (json.dumps({k: v for k, v in envelope.items() if v is not None}), topic, partition, offset, at)


def parsed(spark, *messages):
    return events.parse_events(spark.createDataFrame(list(messages), schemas.MESSAGE))


def test_object_and_quoted_text_read_the_same(spark):
    got = rows(parsed(spark, message(1), message(1, quoted=True)).drop("corrupt"))
    assert got[0] == got[1]
    assert got[0][:6] == (None, "t", 0, 1, "ENTRUST", "I")


def test_numbers_read_as_text(spark):
    df = parsed(spark, message(1, CURR_TIME=93000123, BUSINESS_BALANCE=12.5))
    assert rows(df, "curr_time", "business_balance") == [("93000123", Decimal("12.5"))]


def test_unreadable_messages_are_set_aside(spark):
    broken = [("{not json", "t", 0, 7, None),
              (json.dumps({"Tablename": "ENTRUST", "operType": "I", "columnInfo": "{oops"}), "t", 0, 8, None)]
    df = parsed(spark, message(1), *broken)
    assert rows(events.rejected_events(df), "offset") == [(7,), (8,)]
    assert rows(events.order_events(df), "offset") == [(1,)]


def test_orders_without_key_or_time_are_rejected(spark):
    df = parsed(spark, message(1), message(2, POSITION_STR=None), message(3, POSITION_STR=None),
                message(4, INIT_DATE=None), message(5, table="FUNDJOUR", POSITION_STR=None),
                message(6, table="OTHER", POSITION_STR=None))
    assert rows(events.rejected_events(df), "offset", "reason") == [
        (2, "no key"), (3, "no key"), (4, "no time"), (5, "no key")]
    assert rows(events.order_events(df), "offset") == [(1,)]
    assert rows(events.transfer_events(df), "offset") == []


def test_bad_time_is_null(spark):
    assert rows(parsed(spark, message(1, time="yesterday")), "load_ts") == [(None,)]


def test_order_filter(spark):
    df = parsed(spark, message(1), message(2, op="U"), message(3, op="i"), message(4, op="D"), message(5, op=None),
                message(6, table=""), message(7, table=None), message(8, table="CRDTENTRUST"),
                message(9, table="CBSENTRUST"), message(10, table="CBPENTRUST"), message(11, table="FUNDJOUR"))
    assert rows(events.order_events(df), "offset") == [(n,) for n in (1, 10, 2, 6, 8, 9)]


def test_transfer_filter(spark):
    ok = dict(table="FUNDJOUR")
    df = parsed(spark, message(1, **ok), message(2, op="i", **ok), message(3, op="d", **ok), message(4, table=""),
                message(5, table="BANKTRANSFER"), message(6, MONEY_TYPE="2", **ok), message(7, BUSINESS_FLAG="1", **ok),
                message(8, BUSINESS_FLAG="2142", MONEY_TYPE="1", op="U", **ok), message(9, op=None, **ok))
    assert rows(events.transfer_events(df), "offset") == [(1,), (2,), (4,), (8,)]


def test_latest_and_first_orders(spark):
    df = events.order_events(parsed(
        spark, message(3, time="2024-01-02 09:31:00", BUSINESS_BALANCE="3"), message(1, BUSINESS_BALANCE="1"),
        message(4, time="2024-01-02 09:31:00", BUSINESS_BALANCE="4"), message(2, POSITION_STR="q")))
    assert rows(events.latest_orders(df), "position_str", "offset") == [("p", 3), ("q", 2)]
    assert rows(events.first_seen_orders(df), "position_str", "offset") == [("p", 1), ("q", 2)]


def test_per_second(spark):
    df = events.order_events(parsed(spark, message(1), message(2, CURR_TIME="93000999", BUSINESS_BALANCE="2.5"),
                                    message(3, CURR_TIME="500")))
    assert rows(events.per_second(df)) == [("20240102", "000000", 1, Decimal("10")), ("20240102", "093000", 2, Decimal("12.5"))]


def test_merge_keeps_first_time_and_last_values(spark):
    at = lambda minute: f"2024-01-02 09:3{minute}:00"
    df = events.transfer_events(parsed(
        spark, message(1, table="FUNDJOUR", time=at(1), OCCUR_BALANCE="1"), message(5, table="FUNDJOUR", time=at(5), OCCUR_BALANCE="9", MONEY_TYPE="1"),
        message(3, table="FUNDJOUR", time=at(3), OCCUR_BALANCE="3")))
    merged = events.transfer_changes(df)
    assert rows(merged, "init_time", "load_time", "balance", "money_type") == [(at(1), at(5), Decimal("9"), "1")]


def test_order_goes_across_topics_and_partitions(spark):
    nine, ten = datetime(2024, 1, 2, 9), datetime(2024, 1, 2, 10)
    late = message(5, at=ten, topic="a", OCCUR_BALANCE="10", BUSINESS_BALANCE="10")
    early = message(900, at=nine, topic="b", OCCUR_BALANCE="9", BUSINESS_BALANCE="9")
    untimed = message(2000, topic="z", OCCUR_BALANCE="1", BUSINESS_BALANCE="1")
    orders = events.order_events(parsed(spark, late, early))
    assert rows(events.first_seen_orders(orders), "offset") == [(900,)]
    assert rows(events.latest_orders(orders), "offset") == [(900,)], "of one load time the first to arrive"
    assert rows(events.first_seen_orders(events.order_events(parsed(spark, late, early, untimed))), "offset") == [(2000,)]
    journal = dict(table="FUNDJOUR")
    moves = parsed(spark, *[message(m, at=t, topic=p, OCCUR_BALANCE=v, **journal)
                            for m, t, p, v in ((5, ten, "a", "10"), (900, nine, "b", "9"), (6, ten, "a", "11"), (5, ten, "c", "12"))])
    assert rows(events.transfer_changes(events.transfer_events(moves)), "balance") == [(Decimal("12"),)]
    docs = documents.doc_upsert(documents.doc_route(moves))
    assert rows(docs, "topic", "offset", "occur_balance") == [("c", 5, Decimal("12"))]


ORDER = "message_time timestamp, topic string, partition int, offset long"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.sampled_from("abc"), min_size=1, max_size=12), cuts=st.lists(st.integers(0, 12), max_size=2),
       places=st.lists(st.tuples(st.integers(0, 2), st.sampled_from("xy"), st.integers(0, 1)), min_size=12, max_size=12))
def test_merge_is_the_same_in_any_batches(spark, keys, cuts, places):
    data = [(k, datetime(2024, 1, 2, hour), topic, part, 100 - n, f"t{n}", Decimal(n), f"acct{n}", "0")
            for n, (k, (hour, topic, part)) in enumerate(zip(keys, places))]
    schema = f"position_str string, {ORDER}, load_time string, balance decimal(18,4), fund_account string, money_type string"
    frame = lambda part: spark.createDataFrame(part, schema)
    whole = events.transfer_changes(frame(data))
    bounds = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    parts = [data[a:b] for a, b in zip(bounds, bounds[1:])]
    parts.append(parts[0])  # a repeated batch
    changes = [events.transfer_changes(frame(part)) for part in parts]
    assert rows(events.merge_transfers(reduce(DataFrame.unionByName, changes)).select(*whole.columns)) == rows(whole)
    docs = [events.keep_last(frame(part), ["position_str"], *schemas.ORDER) for part in parts]
    last = events.keep_last(reduce(DataFrame.unionByName, docs), ["position_str"], *schemas.ORDER)
    best = {}
    for row in data:
        best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:5])
    assert rows(last, "position_str", "load_time") == sorted((k, r[5]) for k, r in best.items())
