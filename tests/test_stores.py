"""Seen keys, deletes and outside stores: tables that jobs add to and take from."""

import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from test_events import message

from tallyhouse import schemas
from tallyhouse.operators import events
from tallyhouse.sinks import deletes, outside, seen
from tallyhouse.streaming.documents import documents_table


def orders_of(spark, *messages):
    return events.order_events(events.parse_events(spark.createDataFrame(list(messages), schemas.MESSAGE)))


def test_seen_keys_over_three_runs(spark, tmp_path):
    keys = seen.SeenKeys("seen_test", str(tmp_path / "keys"), buckets=8)
    keys.create(spark)
    batches = [("p", "q", "p"), ("q", "r"), ("s", "p", "r", "t")]
    found = []
    for number, names in enumerate(batches):
        orders = orders_of(spark, *[message(10 * number + n, POSITION_STR=k) for n, k in enumerate(names)])
        fresh = keys.unseen(orders, f"run-{number}")
        found.append(rows(fresh, "position_str", "offset"))
        keys.add(fresh, f"run-{number}")
        assert rows(keys.unseen(orders, f"run-{number}"), "position_str", "offset") == found[-1], "a repeated run finds the same"
    assert found == [[("p", 0), ("q", 1)], [("r", 11)], [("s", 20), ("t", 23)]]
    text = plan(keys.unseen(orders, "another"), "simple")
    stored = text[text.rindex("Sort [position_str"):]
    assert "Exchange" not in stored and "Bucketed: true" in stored, "the stored side stays where it lies"
    spark.sql("drop table seen_test")
    keys.create(spark)
    assert spark.table("seen_test").count() == 5, "a later session finds the files"
    spark.sql("drop table seen_test")


def test_deletes_take_standing_rows_and_rewrite_nothing(spark, tmp_path):
    table = documents_table(str(tmp_path / "docs"))

    def put(number, *docs):
        data = [("i", d, None, "t", 0, at, acct, "0", None, "x", None) for d, at, acct in docs]
        frame = spark.createDataFrame(data, table.schema).withColumn("message_time", F.timestamp_seconds(F.col("offset")))
        table.write(frame, number)
    state = lambda: rows(deletes.read_standing(spark, table), "doc_id", "fund_account")
    assert state() == []
    put(0, ("a", 1, "7"), ("b", 2, "8"), ("c", 3, "7"), ("d", 4, None))
    put(1, ("b", 5, "7"), ("c", 6, "8"))
    before = {f: os.stat(f).st_mtime_ns for f in [os.path.join(r, n) for r, _, names in os.walk(f"{table.path}/batches") for n in names]}
    deletes.delete_where(spark, table, "fund_account", ["7"], "1970-01-01 00:00:07")
    want = [("c", "8"), ("d", None)]
    assert state() == want, "b's older row of another account does not come back"
    assert before == {f: os.stat(f).st_mtime_ns for f in before}
    put(2, ("a", 9, "7"), ("e", 7, "7"))
    assert state() == [("a", "7"), *want], "a later document stays, one of that moment falls"
    deletes.delete_where(spark, table, "doc_id", spark.createDataFrame([("d",), (None,)], "v string"))
    assert state() == [("a", "7"), ("c", "8")]
    deletes.purge(spark, table, 3)
    assert state() == [("a", "7"), ("c", "8")] and rows(table.read(spark), "doc_id") == [("a",), ("c",)]
    assert len(table.folders(spark)) == 1
    with pytest.raises(ValueError):
        deletes.delete_where(spark, table, "nothing", ["7"])


def test_outside_store_has_each_row_once(spark, tmp_path):
    class Flaky(outside.FolderStore):
        """Breaks on the block with the value 13 until it is told that all is well."""

        def stage(self, run, block):
            if not os.path.exists(f"{self.uri}/well") and 13 in block.column(0).to_pylist():
                raise RuntimeError("the store is gone")
            return super().stage(run, block)

    store = Flaky(str(tmp_path / "store"))
    os.makedirs(store.uri)
    with pytest.raises(Exception, match="the store is gone"):
        outside.write_outside(spark.range(0, 40, 1, 4), store, "20240102")
    assert not os.path.exists(f"{store.uri}/runs")
    open(f"{store.uri}/well", "w").close()
    for _ in range(2):
        outside.write_outside(spark.range(0, 40, 1, 4), store, "20240102")
    outside.write_outside(spark.range(40, 45), store, "20240103")
    assert rows(store.read(spark)) == sorted([(n,) for n in range(45)], key=repr)
