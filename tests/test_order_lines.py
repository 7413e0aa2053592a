"""Shapes of order lines that share one join."""

import datetime
from decimal import Decimal as D

from helpers import plan, rows

from tallyhouse.operators import income
from tallyhouse.plans import registry
from tallyhouse.plans.fixtures import shape, shapes_of_lines

NAMES = ("fx_positions", "fx_trades", "fx_lastday", "fx_offexchange")


def tables(spark, folder):
    day = datetime.date(1997, 1, 15)
    lines = [(1, 10, 100, 1, 2.5, 9.99, "N", "O", day), (1, 10, 100, 2, 3.0, 7.01, "N", "O", day),
             (1, 10, 101, 2, 3.0, 7.01, "R", "F", None), (2, 11, None, 7, None, 5.0, None, None, day),
             (2, None, 102, 3, 1.0, None, "A", "O", day), (2, None, 102, 3, 1.0, None, "A", "O", day),
             (None, 12, 100, 4, 1.0, 1.0, "N", "O", day), (9, 12, 100, 4, 1.0, 1.0, "N", "O", day)]
    orders = [(1, 7), (2, None), (2, 8), (None, 9)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate date"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")


def test_shapes_of_lines_are_the_shapes(spark, tmp_path):
    tables(spark, tmp_path)
    for name, got in zip(NAMES, shapes_of_lines(spark, str(tmp_path), *NAMES), strict=True):
        want = shape(spark, str(tmp_path), name)
        assert got.schema == want.schema and rows(got) == rows(want) and got.count() > 0


def test_income_joins_lines_to_orders_once(spark, sf_dir):
    text = plan(registry.stock_income_today(spark, sf_dir), "simple")
    assert "orderkey" not in text, "the shapes read the stored join"


def test_sold_out_rows_stay_out_of_the_window(spark):
    keys = "book string, fund_account string, stock_code string"
    valued = spark.createDataFrame([("o", "a", "s", None, D(10))], f"{keys}, money_type string, market_value decimal(18,4)")
    trades = spark.createDataFrame([("o", "a", "s", D(3)), ("o", "a", "gone", D(1))], f"{keys}, net_trade decimal(18,4)")
    last = spark.createDataFrame([("o", "a", "s", None, D(2)), ("o", "a", "s", "0", D(5)), ("o", "a", "gone", "0", D(4))],
                                 f"{keys}, money_type string, value decimal(18,4)")
    got = income.stock_income_today(valued, trades, last)
    assert [[*map(str, r)] for r in got.collect()] == [["o", "a", "s", "None", "10.0000", "2.0000", "3.0000", "5.00000000"]]
    text = plan(got, "simple")
    between = text[text.index("Window"):text.index("HashAggregate")]
    assert "isnotnull(real_asset" in between and "isnotnull(trade_value" in between
