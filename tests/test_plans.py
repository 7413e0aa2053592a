"""The physical plans: what is read, what is shuffled, where the work runs."""

import re

import pytest
from helpers import plan

import __spark_entry__ as entry
from tallyhouse.functions import rules
from tallyhouse.plans import registry
from tallyhouse.sinks.keyed import lookup
from tallyhouse.sources.tables import scan_table

STREAMS = {"entrust_first_seen_stream", "entrust_per_second_stream", "bank_transfer_stream",
           "offset_progress", "run_log"}
PLANNED = sorted(set(entry.queries()) - STREAMS)


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir), "simple")
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_flagship_shuffles_positions_once(spark, sf_dir):
    text = plan(registry.account_market_value(spark, sf_dir), "simple")
    # One for the totals and one to make the prices unique by key.
    assert exchanges(text) == 2
    assert "LeftOuter, BuildRight" in text and "partial_sum" in text


def test_scan_reads_only_named_columns(spark, sf_dir):
    text = plan(registry.src_scan(spark, sf_dir), "simple")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in text
    counts = plan(registry.src_counts(spark, sf_dir), "simple")
    assert counts.count("ReadSchema: struct<>") == len(registry.SCANNED)


def test_date_filter_reaches_the_reader(spark, tmp_path):
    spark.createDataFrame([("20240101", 1)], "init_date string, v int").write.parquet(str(tmp_path / "j"))
    df = scan_table(spark, str(tmp_path / "j"), where=rules.equals_or_missing("init_date", "20240101"))
    assert "PushedFilters: [Or(EqualTo(init_date,20240101),IsNull(init_date))]" in plan(df, "simple")


def test_account_filter_moves_below_the_totals(spark, sf_dir):
    totals = lookup(registry.account_market_value(spark, sf_dir), fund_account=registry.ACCOUNT, money_type="0")
    text = plan(totals, "simple")
    assert text.index("HashAggregate") < text.index("cast(o_custkey") and re.search(r"Filter.*o_custkey.* = 7", text)


def test_lookup_reads_the_stored_totals_by_key(spark, sf_dir):
    text = plan(registry.kv_lookup(spark, sf_dir), "simple")
    assert f"EqualTo(fund_account,{registry.ACCOUNT})" in text and "EqualTo(money_type,0)" in text
    assert not re.search(r"Exchange|Aggregate|o_custkey", text)


def test_income_has_no_join_of_its_inputs(spark, sf_dir):
    text = plan(registry.stock_income_today(spark, sf_dir), "simple")
    above_union = text[:text.index("Union")]
    assert "Join" not in above_union and exchanges(above_union) == 2


def test_events_are_parsed_once(spark, sf_dir):
    text = plan(registry.entrust_first_seen(spark, sf_dir), "simple")
    assert text.count("from_json") == 2
    between = text[text.index("from_json"):text.rindex("from_json")]
    assert "Filter" in between and "operType" in between


@pytest.mark.parametrize("name", ["entrust_first_seen", "entrust_latest", "doc_upsert", "bank_transfer_merge", "nav_latest"])
def test_keep_one_combines_before_the_shuffle(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir), "simple")
    assert "partial_m" in text and "Window" not in text
