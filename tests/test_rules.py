"""One small frame per rule and per kind of missing value."""

from datetime import datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions import rules
from tallyhouse.operators import (documents, income, keepone, pairs, quotes, snapshots, valuation)
from tallyhouse.sources.tables import observed, row_counts


def D(text):
    return Decimal(text)


def frame(spark, names, *data, types=None):
    schema = types or ", ".join(f"{n} string" for n in names.split())
    return spark.createDataFrame(list(data), schema)


@pytest.mark.parametrize("text, value", [
    ("12.5", "12.5"), ("", "0"), (None, "0"), (" 7 ", "7"), ("1e3", "1000"), ("1d", "1"),
    ("-0.0001", "-0.0001"), ("junk", "0")])
def test_amount(spark, text, value):
    df = frame(spark, "x", (text,))
    assert df.select(rules.amount(df, "x")).first()[0] == D(value)


def test_amount_of_numbers(spark):
    df = spark.sql("select cast(1.25 as double) d, cast(3.5 as decimal(10,2)) c, cast(null as double) n")
    got = df.select(*[rules.amount(df, c) for c in df.columns]).first()
    assert tuple(got) == (D("1.25"), D("3.5"), D("0"))


def test_bad_amounts_are_counted_while_reading(spark):
    df = frame(spark, "x y", ("1", "a"), ("", "2"), ("oops", None))
    counted, seen = observed(df, "bad_amounts", ["x", "y"])
    counted.collect()
    assert seen.get == {"rows": 3, "bad_x": 1, "bad_y": 1}


def positions(spark, *data):
    return spark.createDataFrame([(f"r{i}", *row) for i, row in enumerate(data)], schemas.POSITIONS)


def prices(spark, *data):
    return spark.createDataFrame(list(data), schemas.PRICES)


def test_quantity_and_cash_signs(spark):
    held = positions(spark, ("a", "s", "1", "0", "10", "1", "4", "2"))
    assert rows(valuation.position_quantity(held), "quantity") == [(D("13.0000"),)]
    cash = spark.createDataFrame([("r", "a", "0", "10", "1", "4", "2")], schemas.CASH)
    assert rows(valuation.cash_balance(cash), "balance") == [(D("9.0000"),)]


def test_cash_drops_zero(spark):
    cash = spark.createDataFrame([("r", "a", "0", "5", "", "5", None),
                                  ("q", "b", "0", "-1", "0", "0", "0")], schemas.CASH)
    assert rows(valuation.cash_balance(cash)) == [("b", "0", D("-1.0000"))]


def test_price_choice_and_last_row_key(spark):
    table = prices(spark,
                   ("k1", "a", "1", "0", "10", "12"), ("k1", "b", "1", "0", "10", "0"),
                   ("k1", "c", "1", "0", "10", None), ("k1", "d", "1", "0", "10", "-3"),
                   ("k9", "e", "1", "0", "9", None), ("k10", "e", "1", "0", "10", None),
                   ("k1", "f", "1", "0", None, None))
    assert rows(valuation.price_effective(table)) == [
        ("a", "1", D("12.0000")), ("b", "1", D("10.0000")), ("c", "1", D("10.0000")),
        ("d", "1", D("10.0000")), ("e", "1", D("9.0000")), ("f", "1", None)]


def test_unknown_price_is_zero(spark):
    held = positions(spark, ("a", "s", "1", "0", "10", "", "", ""), ("a", "t", "1", "0", "5", "", "", ""),
                     ("a", "s", "X", "0", "7", "", "", ""))
    valued = valuation.position_market_value(held, prices(spark, ("k", "s", "1", "0", "2.5", None)))
    assert rows(valued, "stock_code", "exchange_type", "price", "market_value") == [
        ("s", "1", D("2.5000"), D("25.000000")), ("s", "X", D("0.0000"), D("0.000000")),
        ("t", "1", D("0.0000"), D("0.000000"))]


def test_four_decimal_values_stay_exact(spark):
    held = positions(spark, ("a", "s", "1", "0", "1000.25", "", "", ""))
    valued = valuation.position_market_value(held, prices(spark, ("k", "s", "1", "0", "1.2345", None)))
    assert rows(valued, "market_value") == [(D("1234.808625"),)]


def test_same_key_positions_are_summed(spark):
    held = positions(spark, ("a", "s", "1", "0", "10", "", "", ""), ("a", "s", "1", "0", "5", "", "", ""))
    valued = valuation.position_market_value(held, prices(spark, ("k", "s", "1", "0", "2", None)))
    assert rows(valuation.stock_market_value(valued), "market_value") == [(D("30.000000"),)]


def test_missing_contract_type_counts(spark):
    table = spark.createDataFrame([("r", "a", "0", "0", "10", "1"), ("r", "a", "0", None, "5", "0.5"),
                                   ("r", "a", "0", "1", "99", "9")], schemas.CONTRACTS)
    assert rows(valuation.credit_liability(table)) == [("a", "0", D("16.5000"))]


def test_journal_date_and_missing_date(spark):
    table = spark.createDataFrame([("r", "a", "0", "20240101", "10"), ("r", "a", "0", None, "5"),
                                   ("r", "a", "0", "20240102", "99")], schemas.JOURNAL)
    assert rows(valuation.fund_net_in(table, "20240101")) == [("a", "0", D("15.0000"))]
    assert rows(valuation.fund_net_in(table)) == [("a", "0", D("114.0000"))]


def test_trades_sign_type_and_status(spark):
    table = spark.createDataFrame([
        ("r", "a", "s", "d", "0", "0", "1", "10"), ("r", "a", "s", "d", "0", "4", "2", "3"),
        ("r", "a", "s", "d", "0", "2", "1", "100"), ("r", "a", "s", "d", "1", "0", "1", "100"),
        ("r", "a", "s", "d", "6", "0", "2", "8"), ("r", "a", "t", "d", "9", "4", None, "2")],
        schemas.TRADES)
    assert rows(valuation.trade_net(table)) == [("a", "s", D("7.0000"))]
    assert rows(valuation.trade_net_credit(table)) == [("a", "s", D("-8.0000")), ("a", "t", D("2.0000"))]


def test_snapshot_drops_zero_and_empty(spark):
    table = spark.createDataFrame([("a_0", "5"), ("b_0", "0"), ("c_0", ""), ("d_0", "-0.0")], schemas.SNAPSHOT)
    assert rows(snapshots.snapshot_rows(table)) == [("a_0", D("5.0000"))]


def test_income_currency_and_missing_sides(spark):
    valued = frame(spark, "", ("ordinary", "a", "s", "1", D(7)), ("ordinary", "a", "s", "0", D(10)),
                   ("ordinary", "a", "t", "0", D(4)),
                   types="book string, fund_account string, stock_code string, money_type string, market_value decimal(38,6)")
    trades = frame(spark, "", ("ordinary", "a", "s", D(3)), ("ordinary", "a", "sold_out", D(1)),
                   ("credit", "a", "t", D(9)),
                   types="book string, fund_account string, stock_code string, net_trade decimal(18,4)")
    last = frame(spark, "", ("ordinary", "a", "s", "1", D(2)), ("ordinary", "a", "gone", "0", D(2)),
                 types="book string, fund_account string, stock_code string, money_type string, value decimal(18,4)")
    got = rows(income.stock_income_text(income.stock_income_today(valued, trades, last)))
    assert got == [("ordinary", "a", "s", "0", "10.0000", "0.0000", "3.0000", "7.0000"),
                   ("ordinary", "a", "s", "1", "7.0000", "2.0000", "0.0000", "5.0000"),
                   ("ordinary", "a", "t", "0", "4.0000", "0.0000", "0.0000", "4.0000")]


@pytest.mark.parametrize("value, text", [(0.0, "0.0000"), (-0.0, "0.0000"), (-0.00001, "0.0000"),
                                         (1234567.5, "1234567.5000"), (-2.5, "-2.5000")])
def test_four_decimal_text(spark, value, text):
    assert spark.createDataFrame([(value,)], "x double").select(rules.text4(F.col("x"))).first()[0] == text


def test_account_is_matched_whole(spark):
    table = frame(spark, "fund_account", ("10",), ("100",), ("10",))
    assert income.account_rows(table, "10").count() == 2


@pytest.mark.parametrize("moment, inside", [
    ("2024-01-02 09:10:59", False), ("2024-01-02 09:11:00", True), ("2024-01-02 18:59:59", True),
    ("2024-01-02 19:00:00", False), ("2024-01-06 12:00:00", False), ("2024-01-07 12:00:00", False)])
def test_session(spark, moment, inside):
    df = spark.createDataFrame([(datetime.fromisoformat(moment),)], "ts timestamp")
    assert df.select(rules.in_session("ts")).first()[0] is inside


def test_order_second_pads_the_time(spark):
    df = frame(spark, "init_date curr_time", ("20240102", "93000123"), ("20240102", "5000"), ("20240102", "103000123"))
    assert rows(df.select(rules.entrust_time())) == [("20240102000005",), ("20240102093000",), ("20240102103000",)]


def test_quote_symbols(spark):
    table = frame(spark, "stock_code exchange_type", *[("1", e) for e in "GS291K"])
    assert rows(quotes.quote_symbol(table), "exchange_type", "symbol") == [
        ("1", "SH:1"), ("2", "SZ:1"), ("9", "SZ:1"), ("G", "HK:1"), ("S", "HK:1")]


def test_quotes_as_number_or_text(spark):
    table = frame(spark, "exchange_type value", ("1", '{"results": [[1.5, "600000"], ["2", "600001"]]}'),
                  ("2", '{"results": []}'), ("2", "no json"), ("9", '{"results": [[null, "3"], []]}'))
    assert rows(quotes.quote_explode(table)) == [
        ("1", "600000", D("1.5000")), ("1", "600001", D("2.0000")), ("9", "3", None), ("9", None, None)]


def test_quote_upsert(spark):
    old = frame(spark, "stock_code exchange_type asset_price market_price",
                ("a", "1", "10", "11"), ("b", "1", "20", None), ("c", "1", "30", "31"))
    new = frame(spark, "", ("a", "1", "12", 1), ("a", "1", "9", 2), ("b", "1", "21", 1), ("z", "1", "5", 1),
                ("c", "1", None, 1), types="stock_code string, exchange_type string, market_price string, seq int")
    assert rows(quotes.quote_upsert(old, new)) == [
        ("a", "1", "10", "9"), ("b", "1", "20", "21"), ("c", "1", "30", "31"), ("z", "1", None, "5")]


def test_quote_upsert_keeps_the_last_row_whole(spark):
    old = frame(spark, "rowkey stock_code exchange_type money_type asset_price market_price",
                ("1", "a", "1", "0", "9.5", None), ("2", "a", "1", "2", "10.2", None), ("3", "b", "1", "0", "5", "6"))
    new = frame(spark, "stock_code exchange_type market_price", ("b", "1", "7"))
    got = quotes.quote_upsert(old, new)
    assert got.columns == old.columns
    assert rows(got) == [("2", "a", "1", "2", "10.2", None), ("3", "b", "1", "0", "5", "7")]
    assert rows(quotes.quote_upsert(got, new)) == rows(got)


def test_keep_one_with_null_order(spark):
    df = frame(spark, "", ("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), types="k string, o int, v string")
    assert rows(keepone.keep_last(df, ["k"], "o")) == [("a", 2, "x"), ("b", None, "z")]
    assert rows(keepone.keep_first(df.filter("k = 'a'"), ["k"], "o")) == [("a", 1, "y")]


def test_pairs(spark):
    df = spark.range(2)
    assert rows(pairs.pair_with(df, [6, 7], "v")) == [(0, 6), (0, 7), (1, 6), (1, 7)]


def documents_frame(spark):
    return frame(spark, "", *[("i", f"d{n}", n, "acct" if n % 2 else None, "0" if n < 6 else "1", D(n))
                              for n in range(10)],
                 types="index string, doc_id string, offset long, fund_account string, money_type string, "
                       "occur_balance decimal(18,4)")


def test_document_match_sum_delete(spark):
    docs = documents_frame(spark)
    assert rows(documents.doc_match(docs, "fund_account", "acct", size=2), "doc_id") == [("d1",), ("d3",)]
    assert documents.doc_match_sum(docs, "fund_account", "acct").first()[0] == D("9")
    assert documents.doc_match_sum(docs, "fund_account", "nobody").first()[0] == D("0")
    hit = F.col("fund_account") == "acct"
    assert documents.doc_delete(docs, hit, size=2).count() == 8
    assert rows(documents.doc_delete(docs, hit, size=2).filter(hit), "doc_id") == [("d5",), ("d7",), ("d9",)]
    assert documents.doc_delete(docs, hit, size=None).count() == 5


def test_document_routes(spark):
    names = "tablename oper_type position_str compact_id fund_account money_type business_flag timeload corrupt"
    event = lambda table, op="I", money="0", flag="2041": (table, op, "p", "c", "a", money, flag, "t", None)
    table = frame(spark, names, event("FUNDJOUR"), event("BANKTRANSFER", "u"), event("FUNDJOUR", money="2"),
                  event("FUNDJOUR", flag="1"), event("COMPACT"), event("STOCKREAL", money="2"), event("CRDTSTOCKREAL"),
                  event("SECUMREAL", "D"), event("ENTRUST"), event(None))
    table = table.withColumn("offset", F.lit(1).cast("long")).withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0)).withColumn(
        "message_time", F.lit(None).cast("timestamp")).withColumn("occur_balance", F.lit(5).cast("decimal(18,4)"))
    assert rows(documents.doc_route(table), "index", "doc_id", "occur_balance") == [
        ("hs_asset_fundjour", "p", D("5.0000")), ("hs_asset_fundjour", "p", D("5.0000")),
        ("hs_crdt_compact", "c", D("0.0000")), ("hs_crdt_crdtstockreal", "p", D("0.0000")),
        ("hs_secu_stockreal", "p", D("0.0000"))]


def test_row_counts(spark):
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_matches_and_deletes_have_no_limit(spark):
    docs = spark.range(1001).selectExpr("cast(id as string) doc_id", "'x' index", "'acct' fund_account")
    assert documents.doc_match(docs, "fund_account", "acct").count() == 1001
    assert documents.doc_delete(docs, F.col("fund_account") == "acct").count() == 0


def test_long_amounts_are_read(spark):
    df = spark.createDataFrame([("100000000000000.00",), ("12345678901234567890.5",)], "v string")
    found = [r[0] for r in df.select(rules.amount(df, "v")).collect()]
    assert found == [D("100000000000000"), D("12345678901234567890.5")]


def test_products_keep_all_their_decimals(spark):
    positions = spark.createDataFrame([("a", "s", "1", "0", "0.0010", "", "", ""), ("b", "s", "1", "0", "123456789012345.5", "", "", "")],
                                      "fund_account string, stock_code string, exchange_type string, money_type string, current_amount string, "
                                      "correct_amount string, real_buy_amount string, real_sell_amount string")
    prices = spark.createDataFrame([("s", "1", "0.0004", None)], "stock_code string, exchange_type string, asset_price string, market_price string")
    found = rows(valuation.position_market_value(positions, prices), "fund_account", "market_value")
    assert found == [("a", D("0.0000004")), ("b", D("49382715604.9382"))]
    totals = valuation.account_market_value(valuation.position_market_value(positions, prices))
    assert rows(totals, "fund_account", "market_value") == found


def test_amounts_that_are_rounded_or_too_large_are_counted(spark):
    df = spark.createDataFrame([("1.2345",), ("1.23456",), ("1.23450",), ("9999999999",), ("",), (None,), ("x",)], "market_price string")
    df = df.withColumn("current_amount", F.col("market_price")).withColumn("wide", F.col("market_price").try_cast("decimal(20,6)"))
    bad = lambda name: [r[0] for r in df.select(rules.is_bad_amount(df, name)).collect()]
    assert bad("market_price") == [False, True, False, True, False, False, True]
    assert bad("current_amount") == [False, True, False, False, False, False, True]
    assert bad("wide") == [False, True, False, False, False, False, False]


def test_several_values_without_an_order_stop_the_job(spark):
    navs = lambda *v: spark.createDataFrame([("p", "r", x) for x in v], "prod_code string, prodta_no string, nav string")
    assert rows(valuation.nav_latest(navs("1", "1")), "nav") == [(D("1"),)]
    with pytest.raises(Exception, match="no rowkey to choose by"):
        valuation.nav_latest(navs("1", "2")).collect()
