"""Keyed tables, dates, block writers and the whole valuation run."""

import glob
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import session
from tallyhouse.operators import snapshots, valuation
from tallyhouse.plans import registry
from tallyhouse.plans.valuation_run import ROLLUPS, STEPS, run_valuation
from tallyhouse.sinks import batches, keyed, pointers, versions


def test_keyed_lookup_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(spark.range(1000).select(F.col("id").cast("string").alias("k"), "id"), path, ["k"])
    hit = keyed.lookup(keyed.read_keyed(spark, path), k="77")
    assert rows(hit) == [("77", 77)]
    assert "EqualTo(k,77)" in plan(hit)


def test_one_date_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "k string")
    keyed.write_for_date(df("a", "stale"), path, ["k"], "20240101")
    keyed.write_for_date(df("b"), path, ["k"], "20240102")
    keyed.write_for_date(df("c"), path, ["k"], "20240101")
    assert rows(keyed.read_dates(spark, path), "biz_date", "k") == [("20240101", "c"), ("20240102", "b")]
    assert rows(keyed.read_for_date(spark, path, "20240102")) == [("b",)]
    keyed.write_for_date(df("x").limit(0), path, ["k"], "20240102")
    assert keyed.read_for_date(spark, path, "20240102").count() == 0


def failing(df):
    return df.withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    keyed.write_keyed(df(*range(10)), path, ["v"])
    reader = keyed.read_keyed(spark, path)
    with pytest.raises(Exception, match="broken row"):
        keyed.write_keyed(failing(df(1, 2, 3)), path, ["v"])
    assert keyed.read_keyed(spark, path).count() == 10
    assert len(pointers.children(spark, f"{path}/{versions.VERSIONS}")) == 1, "the broken version is gone"
    keyed.write_keyed(df(7), path, ["v"])
    assert reader.count() == 10 and rows(keyed.read_keyed(spark, path)) == [(7,)], "a reader sees one whole version"


def test_a_reader_between_write_and_switch_sees_the_old_version(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []
    versions.replace(spark.range(3), path, lambda df, folder: df.write.parquet(folder))

    def write(df, folder):
        df.write.parquet(folder)
        seen.append(rows(versions.read(spark, path)))
    versions.replace(spark.range(5), path, write)
    assert seen == [[(0,), (1,), (2,)]] and versions.read(spark, path).count() == 5


def test_a_table_may_be_made_from_itself_and_is_swept(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    for number in range(6):
        keyed.write_keyed(keyed.read_keyed(spark, path).withColumn("id", F.col("id") + 1), path, ["id"])
        assert rows(keyed.read_keyed(spark, path)) == [(number + 1,), (number + 2,)]
    assert len(pointers.children(spark, f"{path}/{versions.VERSIONS}")) == versions.KEPT_VERSIONS


def test_of_two_replacements_at_once_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")

    def slow(df, folder):
        df.write.parquet(folder)
        versions.replace(spark.range(1), path, lambda other, f: other.write.parquet(f))
    with pytest.raises(pointers.StaleNote):
        versions.replace(spark.range(9), path, slow)
    assert versions.read(spark, path).count() == 1
    assert len(pointers.children(spark, f"{path}/{versions.VERSIONS}")) == 1


def test_a_note_cut_short_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(spark.range(4), path, lambda df, folder: df.write.parquet(folder))
    (tmp_path / "t" / pointers.NOTES / f"{1:012d}").write_text("0000")
    assert versions.read(spark, path).count() == 4
    versions.replace(spark.range(5), path, lambda df, folder: df.write.parquet(folder))
    assert versions.read(spark, path).count() == 5


def test_keyed_files_span_different_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed.write_keyed(spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("k")).repartition(6), path, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [pq.ParquetFile(f) for f in glob.glob(f"{versions.current(spark, path)}/*.parquet")]
    spans = sorted((s.min, s.max) for f in files for g in range(f.num_row_groups)
                   for s in [f.metadata.row_group(g).column(0).statistics])
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(low <= 1234 <= high for low, high in spans) == 1, "a lookup reads one row group of four"


def test_blocks(spark, tmp_path):
    out = str(tmp_path)

    def send(block):
        name = f"{os.getpid()}-{block[0]['id']}.json"
        with open(os.path.join(out, name), "w") as f:
            json.dump([b["id"] for b in block], f)

    keyed.write_blocks(spark.range(0, 25, 1, 2), send, block_rows=10)
    blocks = [json.load(open(os.path.join(out, n))) for n in os.listdir(out)]
    assert sorted(len(b) for b in blocks) == [2, 3, 10, 10]
    assert sorted(sum(blocks, [])) == list(range(25))


def test_batch_folder_is_replaced(spark, tmp_path):
    table = batches.BatchTable(str(tmp_path / "b"), spark.range(1).schema, ["id"])
    assert table.read(spark).count() == 0 and table.last_batch(spark) == -1
    table.write(spark.range(5), 3)
    table.write(spark.range(2), 3)
    assert rows(table.read(spark)) == [(0,), (1,)] and table.last_batch(spark) == 3


def sums(path, **options):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])
    return batches.BatchTable(str(path), schema, ["k"], lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), **options)


def put(table, number):
    """A batch as the stream leaves it, written without Spark: key number % 7, once."""
    folder = table._folder(number)
    os.makedirs(folder)
    pq.write_table(pa.table({"k": pa.array([number % 7], pa.int64()), "n": pa.array([1], pa.int64())}), f"{folder}/part.parquet")


def test_many_batches_leave_few_folders(spark, tmp_path):
    table, most = sums(tmp_path / "t", every=10, fan=3), 0
    for number in range(200):
        put(table, number)
        table.fold_before(spark, number)
        listed = sum(len(pointers.children(spark, f"{table.path}/{part}")) for part in (batches.BATCHES, batches.RUNS))
        most = max(most, listed)
    assert most < 40, "of 200 batches"
    folders = table.folders(spark)
    assert len(folders) < 20 and rows(table.read(spark)) == [(k, 29 if k < 4 else 28) for k in range(7)]
    read = spark.read.schema(table.schema).parquet(*folders).inputFiles()
    assert {os.path.dirname(f).rsplit("/", 1)[1] for f in read} == {os.path.basename(f) for f in folders}


def test_a_repeated_or_broken_fold_changes_nothing(spark, tmp_path, monkeypatch):
    table = sums(tmp_path / "t", every=3, fan=3)
    for number in range(6):
        put(table, number)
    want = rows(table.read(spark))
    assert not table.fold_before(spark, 2), "too few before the running batch"

    def lost(*_):
        raise RuntimeError("lost the driver")
    with monkeypatch.context() as patch:
        patch.setattr(pointers, "advance", lost)
        with pytest.raises(RuntimeError):
            table.fold_before(spark, 5)
    assert rows(table.read(spark)) == want, "a run that no note names is not read"
    reader = table.read(spark)
    assert table.fold_before(spark, 5) and not table.fold_before(spark, 5)
    assert rows(table.read(spark)) == want == rows(reader), "a reader from before the fold finds its folders"
    table.write(spark.createDataFrame([(5, 1)], table.schema), 5)
    assert rows(table.read(spark)) == want, "the running batch is run again"
    names = pointers.children(spark, f"{table.path}/{batches.RUNS}")
    assert len(names) == 1, "the broken fold's run is gone"
    for number in range(6, 12):
        put(table, number)
        table.fold_before(spark, number)
    assert sum(n for _, n in rows(table.read(spark))) == 12


def test_snapshot_is_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "k string")
    snapshots.load_snapshot(df("a", "b"), path, ["k"])
    assert rows(snapshots.load_snapshot(df("c"), path, ["k"])) == [("c",)]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    from helpers import SF_DIR
    out = str(tmp_path_factory.mktemp("run"))
    run_valuation(spark, registry._run_inputs(spark, SF_DIR), out, "20240102", of_date=False)
    return out


def test_run_writes_every_table_and_logs_it(spark, run):
    log = {r["step_name"]: r for r in spark.read.parquet(f"{run}/run_log").collect()}
    assert set(log) == set(STEPS) | set(ROLLUPS.values())
    for name, step in log.items():
        assert step["rows_written"] == keyed.read_dates(spark, f"{run}/{name}").count() > 0
        assert step["start_time"] <= step["end_time"]


def test_run_equals_the_queries(spark, run, sf_dir):
    got = keyed.read_for_date(spark, f"{run}/account_value", "20240102")
    want = registry.account_market_value(spark, sf_dir)
    assert rows(registry.as_doubles(got.select(*want.columns))) == rows(want)


def test_accounts_add_up_to_positions(spark, run, sf_dir):
    parts = registry._valued(spark, sf_dir, "ordinary").agg(F.sum("market_value")).first()[0]
    for table in ("stock_value", "account_value"):
        assert keyed.read_dates(spark, f"{run}/{table}").agg(F.sum("market_value")).first()[0] == parts


def test_run_again_replaces_only_its_date(spark, tmp_path, sf_dir):
    inputs, out = registry._run_inputs(spark, sf_dir), str(tmp_path)
    run_valuation(spark, inputs, out, "20240102", steps=["cash"])
    run_valuation(spark, inputs, out, "20240103", steps=["cash"])
    fewer = {**inputs, "cash": inputs["cash"].filter("fund_account = '1'")}
    run_valuation(spark, fewer, out, "20240102", steps=["cash"])
    assert keyed.read_for_date(spark, f"{out}/cash", "20240102").count() == 1
    assert keyed.read_for_date(spark, f"{out}/cash", "20240103").count() == valuation.cash_balance(inputs["cash"]).count()
    assert spark.read.parquet(f"{out}/run_log").count() == 3


def test_failing_step_leaves_the_others(spark, tmp_path, sf_dir):
    inputs, out = registry._run_inputs(spark, sf_dir), str(tmp_path)
    inputs["holdings"] = inputs["holdings"].drop("prod_code")
    with pytest.raises(ExceptionGroup) as failed:
        run_valuation(spark, inputs, out, "20240102", steps=["offexchange_value", "cash"])
    assert failed.value.exceptions[0].__notes__ == ["valuation step offexchange_value"]
    assert rows(spark.read.parquet(f"{out}/run_log"), "step_name") == [("cash",)]
    assert keyed.read_dates(spark, f"{out}/cash").count() > 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
