"""Streams against the batch queries, restarts, repeats and failures."""

import glob
import os
from datetime import datetime, timedelta, timezone

import pytest
from helpers import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_events import message

from tallyhouse import schemas
from tallyhouse.operators import events
from tallyhouse.operators.documents import doc_route, doc_upsert
from tallyhouse.plans import fixtures
from tallyhouse.sinks import batches
from tallyhouse.sinks.batches import BatchTable
from tallyhouse.sources.messages import file_messages, kafka_options, saved_offsets
from tallyhouse.streaming import documents, ledger, orders, rejects, transfers
from tallyhouse.streaming.replay import replay


class Orders:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.inbox, self.seen, self.totals, self.checkpoint = (
            f"{self.root}/{p}" for p in ("inbox", "seen", "totals", "checkpoint"))

    def send(self, *messages):
        self.spark.createDataFrame(list(messages), schemas.MESSAGE).coalesce(1).write.mode("append").parquet(self.inbox)

    def start(self, **options):
        return orders.start_orders(file_messages(self.spark, self.inbox), self.seen, self.totals,
                                   self.checkpoint, every=None, **options)

    def run(self, **options):
        self.start(**options).awaitTermination()
        return self.state()

    def state(self):
        return (rows(orders.read_seen(self.spark, self.seen)), rows(orders.read_totals(self.spark, self.totals)))


def test_orders_equal_batch_and_ignore_repeats(spark, sf_dir, tmp_path):
    job = Orders(spark, tmp_path)
    messages = fixtures.change_messages(spark, sf_dir)
    runs = replay(messages, job.inbox, job.start)
    assert len(runs) == 3
    first = events.first_seen_orders(events.order_events(events.parse_events(messages)).drop("timeload"))
    want = (rows(first.select(*schemas.FIRST_SEEN.fieldNames())), rows(events.per_second(first)))
    assert job.state() == want
    assert job.run() == want, "a restart with nothing new changes nothing"
    messages.filter("offset between 300 and 600").write.mode("append").parquet(job.inbox)
    assert job.run() == want, "repeated messages change nothing"


def test_first_order_stays_the_first(spark, tmp_path):
    job = Orders(spark, tmp_path)
    job.send(message(5, BUSINESS_BALANCE="1"), message(6, BUSINESS_BALANCE="2"))
    before = job.run()
    job.send(message(1, BUSINESS_BALANCE="9"), message(7, op="U", BUSINESS_BALANCE="3"), message(8, POSITION_STR="q"))
    seen, totals = job.run()
    assert before[0][0] in seen and len(seen) == 2
    assert [t[2] for t in totals] == [2]


def test_failed_batch_is_repeated_once(spark, tmp_path):
    job = Orders(spark, tmp_path)
    job.send(message(1), message(2, POSITION_STR="q"))
    job.run()
    job.send(message(3, POSITION_STR="r"), message(4))
    want = job.run()
    # As if the driver died after the batch wrote its folders, before it was committed.
    last = max(glob.glob(f"{job.checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    assert job.run() == want
    assert os.path.exists(last)


def test_failure_between_the_two_tables(spark, tmp_path, monkeypatch):
    job = Orders(spark, tmp_path)
    job.send(message(1), message(2, POSITION_STR="q"))
    job.run()
    job.send(message(3, POSITION_STR="r"), message(4))
    write = BatchTable.write

    def fail_on_totals(table, df, batch_id):
        if table.path == job.totals:
            raise RuntimeError("lost the driver")
        write(table, df, batch_id)

    monkeypatch.setattr(BatchTable, "write", fail_on_totals)
    with pytest.raises(StreamingQueryException):
        job.run()
    monkeypatch.undo()
    seen, totals = job.run()
    assert [r[0] for r in seen] == ["p", "q", "r"] and [t[2] for t in totals] == [3]


def test_stream_folds_while_it_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches.BatchTable, "fold_before", lambda table, spark, number: len(
        [b for b in table._batches(spark) if b < number]) >= 2 and table.fold(spark, number))
    job = Orders(spark, tmp_path)
    for number, keys in enumerate(["p", "q", "pq", "r", "s", "pt"]):
        job.send(*[message(10 * number + n, POSITION_STR=k) for n, k in enumerate(keys)])
        job.run()
    seen, totals = job.state()
    assert [r[0] for r in seen] == ["p", "q", "r", "s", "t"] and [t[2] for t in totals] == [5]
    assert os.listdir(f"{job.seen}/runs") and len(os.listdir(f"{job.seen}/batches")) < 6
    folders = glob.glob(f"{job.seen}/batches/*") + glob.glob(f"{job.seen}/runs/*")
    assert all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders), "small batches leave one file"


def test_unseen_orders(spark):
    df = events.order_events(events.parse_events(spark.createDataFrame(
        [message(1), message(2), message(3, POSITION_STR="q")], schemas.MESSAGE)))
    seen = spark.createDataFrame([("q",)], "position_str string")
    assert rows(events.unseen_orders(df, seen), "position_str", "offset") == [("p", 1)]


def test_forgetting_stream(spark, tmp_path):
    job = Orders(spark, tmp_path)
    job.send(message(1), message(2), message(3, POSITION_STR="q"))
    seen, totals = job.run(forget_after="1 hour")
    assert [r[0] for r in seen] == ["p", "q"] and [t[2] for t in totals] == [2]
    job.send(message(9))
    assert job.run(forget_after="1 hour")[0] == seen


def test_bad_messages_do_not_stop_the_stream(spark, tmp_path):
    job = Orders(spark, tmp_path)
    job.send(("{bad", "t", 0, 1, None), message(2), ("", "t", 0, 3, None), (None, "t", 0, 4, None))
    assert [r[0] for r in job.run()[0]] == ["p"]


@pytest.fixture
def transfer_job(spark, tmp_path):
    inbox, table = f"{tmp_path}/inbox", f"{tmp_path}/table"

    def start(path=table, checkpoint=f"{tmp_path}/checkpoint"):
        return transfers.start_transfers(file_messages(spark, inbox), path, checkpoint, every=None)
    return inbox, table, start


def test_transfers_equal_batch_and_ignore_repeats(spark, sf_dir, tmp_path, transfer_job):
    inbox, table, start = transfer_job
    messages = fixtures.change_messages(spark, sf_dir)
    replay(messages, inbox, start, slices=4)
    want = rows(events.transfer_changes(events.transfer_events(events.parse_events(messages))))
    names = [n for n in schemas.TRANSFERS.fieldNames() if n != "biz_dt"]
    state = lambda path=table: rows(transfers.read_transfers(spark, path), *names)
    assert state() == sorted(want, key=repr)
    messages.filter("offset < 500").write.mode("append").parquet(inbox)
    start().awaitTermination()
    assert state() == want
    assert transfers.transfers_table(table).fold(spark, 5) and state() == want


def test_documents_equal_batch_and_ignore_repeats(spark, sf_dir, tmp_path):
    inbox, table = f"{tmp_path}/inbox", f"{tmp_path}/table"

    def start():
        return documents.start_documents(file_messages(spark, inbox), table, f"{tmp_path}/checkpoint", every=None)

    messages = fixtures.document_messages(spark, sf_dir)
    replay(messages, inbox, start)
    names = [n for n in schemas.DOCUMENTS.fieldNames() if n != "biz_dt"]
    want = rows(doc_upsert(doc_route(events.parse_events(messages))), *names)
    state = lambda path: rows(documents.read_documents(spark, path), *names)
    assert documents.read_documents(spark, table).filter("biz_dt is null").count() == 0
    assert state(table) == want
    messages.filter("offset < 400").write.mode("append").parquet(inbox)
    start().awaitTermination()
    assert state(table) == want
    assert documents.documents_table(table).fold(spark, 4) and state(table) == want


def test_stream_reduces_keys_before_the_state(spark, tmp_path):
    job = Orders(spark, tmp_path)
    job.send(message(1), message(2))
    query = job.start()
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    partial, shuffle, store = (text.index(w) for w in ("partial_min_by", "Exchange hashpartitioning", "StateStoreSave"))
    assert store < shuffle < partial, "printed from the last step to the first"
    assert "Python" not in text


def test_a_stream_from_the_ledger_alone_loses_and_repeats_nothing(spark, sf_dir, tmp_path):
    inbox, table, book = (f"{tmp_path}/{n}" for n in ("inbox", "table", "ledger"))
    messages = fixtures.change_messages(spark, sf_dir)

    def start(checkpoint, source=None):
        source = file_messages(spark, inbox) if source is None else source
        return transfers.start_transfers(source, table, f"{tmp_path}/{checkpoint}", every=None, ledger=book)

    half = messages.filter("message_time < timestamp'2024-01-15'")
    replay(half, inbox, lambda: start("first"), slices=2)
    rest = messages.filter("message_time >= timestamp'2024-01-15'")
    rest.write.mode("append").parquet(inbox)
    assert ledger.unread(spark.read.parquet(inbox), spark, book, "transfers").count() == rest.count()
    # The checkpoint is lost: another one, the same source from its start, and the ledger.
    done = spark.read.parquet(inbox).count()
    source = ledger.unread(file_messages(spark, inbox), spark, book, "transfers")
    query = start("second", source)
    query.awaitTermination()
    assert done == messages.count()
    want = rows(events.transfer_changes(events.transfer_events(events.parse_events(messages))))
    names = [n for n in schemas.TRANSFERS.fieldNames() if n != "biz_dt"]
    assert rows(transfers.read_transfers(spark, table), *names) == want
    folders = sorted(int(n) for n in os.listdir(f"{table}/batches"))
    assert folders == [0, 1, 2], "the new stream's batches do not replace the old ones"
    offsets = rows(ledger.offset_progress(spark, book))
    ends = messages.groupBy("topic", "partition").agg(F.max("offset") + 1)
    assert offsets == [("transfers", *r) for r in rows(ends)]
    taken = [b for b in transfers.transfers_table(table).folders(spark)]
    assert spark.read.parquet(taken[2]).count() == rows(events.transfer_changes(events.transfer_events(
        events.parse_events(rest))).groupBy().count())[0][0], "no message of the first half is read again"


def test_ledger_is_the_same_however_often_a_batch_runs(spark, tmp_path):
    book = ledger.ledger_table(str(tmp_path / "ledger"))
    part = lambda *offsets: ledger.read_until(spark.createDataFrame(
        [("", "t", 0, o, None) for o in offsets], schemas.MESSAGE), "g")
    for number in (0, 1, 1, 0):
        book.write(part(*range(5 * number, 5 * number + 5)), number)
    assert rows(book.read(spark)) == [("g", "t", 0, 10)]
    book.fold(spark, 2)
    assert rows(ledger.offset_progress(spark, book.path)) == [("g", "t", 0, 10)]
    assert saved_offsets(book.read(spark).collect()) == {"t": {0: 10}}


def test_a_checkpoint_of_another_table_is_refused(spark, tmp_path, transfer_job):
    inbox, _, start = transfer_job
    spark.createDataFrame([message(1, table="FUNDJOUR")], schemas.MESSAGE).write.parquet(inbox)
    start().awaitTermination()
    with pytest.raises(ValueError, match="belongs to another table"):
        transfers.start_transfers(file_messages(spark, inbox), f"{tmp_path}/other", f"{tmp_path}/checkpoint", every=None)


def test_kafka_offsets_round_trip(spark):
    table = spark.createDataFrame([("g", "t", 0, 9), ("g", "t", 1, 7), ("g", "u", 0, 3)], schemas.OFFSETS)
    options = kafka_options("host:1", "t,u", start=saved_offsets(table.orderBy("topic", "partition").collect()), per_trigger=200)
    assert options["startingOffsets"] == '{"t": {"0": 9, "1": 7}, "u": {"0": 3}}'
    assert options["maxOffsetsPerTrigger"] == "200"
    assert kafka_options("host:1", "t")["startingOffsets"] == "latest"


class Seconds:
    """Totals by event time: late after 60 seconds, slices at most 30 apart."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.inbox, self.table, self.late, self.checkpoint = (f"{self.root}/{p}" for p in ("inbox", "table", "late", "checkpoint"))

    def run(self, *messages, ahead=0):
        if messages:
            self.spark.createDataFrame(list(messages), schemas.MESSAGE).coalesce(1).write.mode("append").parquet(self.inbox)
        query = orders.start_second_totals(file_messages(self.spark, self.inbox), self.table, self.checkpoint, 60,
                                           ahead=ahead, skew=30, every=None)
        query.awaitTermination()
        self.dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
        return self.totals()

    def totals(self):
        return [(time, number, None if value is None else float(value)) for time, number, value in
                rows(orders.read_totals(self.spark, self.table), "load_time", "entrust_num", "balance")]

    def rejected(self, ahead=0):
        rejects.start_rejects(file_messages(self.spark, self.inbox), self.late, f"{self.checkpoint}-late", every=None,
                              late_after=60, ahead=ahead).awaitTermination()
        return rows(rejects.read_rejects(self.spark, self.late), "offset", "reason")


def order(offset, second, lag=1, key=None, value="10", **info):
    """An order of 09:30 plus ``second`` seconds whose message comes ``lag`` seconds later."""
    begin = datetime(2024, 1, 2, 9, 30, tzinfo=timezone.utc)
    clock = (begin + timedelta(seconds=second)).strftime("%-H%M%S") + "123"
    return message(offset, at=begin + timedelta(seconds=second + lag),
                   **{"POSITION_STR": key or f"k{offset}", "CURR_TIME": clock, "BUSINESS_BALANCE": value, **info})


def test_seconds_are_written_once_when_they_are_closed(spark, tmp_path):
    job = Seconds(spark, tmp_path)
    assert job.run(order(1, 0), order(2, 0, value="2.5"), order(3, 1)) == []
    # Second 0 ends at 1 and second 1 at 2; the watermark is 90 behind the latest order.
    assert job.run(order(4, 91)) == [("093000", 2, 12.5)]
    assert job.run(order(5, 92), order(6, 3, lag=60)) == [("093000", 2, 12.5), ("093001", 1, 10.0)]
    assert job.run(order(7, 300)) == [("093000", 2, 12.5), ("093001", 1, 10.0), ("093003", 1, 10.0),
                                      ("093131", 1, 10.0), ("093132", 1, 10.0)]
    assert job.dropped == 0


def test_seconds_leave_late_and_early_orders_to_the_rejects(spark, tmp_path):
    job = Seconds(spark, tmp_path)
    messages = [order(1, 0, lag=60), order(2, 0, lag=61), order(3, 0, lag=-5), order(4, 0, lag=-6), order(5, 0, CURR_TIME="99999999"),
                message(6, at=None), order(7, 0, POSITION_STR=None), order(8, 500)]
    assert job.run(*messages, ahead=5) == [("093000", 2, 20.0)]
    assert job.rejected(ahead=5) == [(2, "late"), (4, "early"), (5, "no time"), (6, "no message time"), (7, "no key")]


def test_seconds_count_a_key_once_a_second(spark, tmp_path):
    job = Seconds(spark, tmp_path)
    job.run(order(5, 0, lag=3, key="a", value="7"), order(4, 0, key="b", value=None))
    # An earlier message of the same order in a later batch, a repeat, and the key's next second.
    job.run(order(1, 0, lag=2, key="a", value="9"), order(6, 0, lag=4, key="a"), order(7, 1, key="a", value="1"))
    assert job.run(order(9, 300)) == [("093000", 2, 9.0), ("093001", 1, 1.0)]


def test_seconds_do_not_depend_on_the_batches(spark, tmp_path):
    everything = [order(n, 7 * (n // 4) + n % 3, lag=n * 13 % 70, key=f"k{n % 5}", value=str(n)) for n in range(60)]
    everything = sorted(everything, key=lambda m: m[4]) + [order(99, 2000)]
    found = []
    for number, cuts in enumerate([(0, 61), (0, 20, 61), (0, 7, 8, 33, 61)]):
        job = Seconds(spark, tmp_path / str(number))
        for low, high in zip(cuts, cuts[1:]):
            job.run(*everything[low:high])
            assert job.dropped == 0
        found.append((job.totals(), job.rejected()))
    assert found[0] == found[1] == found[2]
    assert found[0][0] and len(found[0][1]) == sum(n * 13 % 70 > 60 for n in range(60))


def test_seconds_of_a_repeated_batch_are_written_once(spark, tmp_path):
    job = Seconds(spark, tmp_path)
    job.run(order(1, 0), order(2, 0))
    want = job.run(order(3, 300))
    last = max(glob.glob(f"{job.checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in [last, *glob.glob(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")]:
        os.remove(path)
    assert job.run() == want == [("093000", 2, 20.0)]
