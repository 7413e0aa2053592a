"""The submitted jobs over stored text tables, from valuation to income."""

import json

import pytest
from helpers import rows

from tallyhouse import __main__ as jobs
from tallyhouse import schemas
from tallyhouse.sinks.keyed import read_dates, read_keyed


def store(spark, path, schema, *data):
    spark.createDataFrame([tuple(map(str, (i, *row))) for i, row in enumerate(data)], schema).write.parquet(path)


@pytest.fixture
def tables(spark, tmp_path):
    root = str(tmp_path / "tables")
    amounts = ("10", "", "", "")
    store(spark, f"{root}/positions", schemas.POSITIONS, ("a", "s", "1", "0", *amounts), ("ab", "s", "1", "0", *amounts))
    store(spark, f"{root}/credit_positions", schemas.POSITIONS, ("a", "t", "1", "0", *amounts))
    store(spark, f"{root}/prices", schemas.PRICES, ("s", "1", "0", "2", "2.5"), ("t", "1", "0", "3", "0"))
    store(spark, f"{root}/holdings", schemas.HOLDINGS, ("a", "0", "n", "c", *amounts))
    store(spark, f"{root}/navs", schemas.NAVS, ("c", "n", "1.2345"))
    store(spark, f"{root}/cash", schemas.CASH, ("a", "0", "7", "", "", ""))
    store(spark, f"{root}/contracts", schemas.CONTRACTS, ("a", "0", "0", "5", "1"))
    store(spark, f"{root}/journal", schemas.JOURNAL, ("a", "0", "20240102", "4"), ("a", "0", "20240101", "9"))
    trade = ("a", "s", "20240102", "0", "0", "1", "6")
    store(spark, f"{root}/trades", schemas.TRADES, trade)
    store(spark, f"{root}/credit_trades", schemas.TRADES, ("a", "t", "20240102", "7", "4", "2", "1"))
    return root


def test_valuation_snapshot_and_income(spark, tmp_path, tables):
    run, last, credit_last, out = (str(tmp_path / n) for n in ("run", "last", "credit_last", "out"))
    jobs.main(["valuation", "--tables", tables, "--out", run, "--date", "20240102"])
    value = lambda table, column: [float(v) for (v,) in rows(read_dates(spark, f"{run}/{table}"), column)]
    assert value("account_value", "market_value") == [25.0, 25.0]
    assert value("credit_account_value", "market_value") == [30.0]
    assert value("offexchange_value", "market_value") == [12.345]
    assert value("cash", "balance") == [7.0]
    assert value("credit_debt", "liability") == [6.0]
    assert value("net_in", "net_in") == [4.0]

    for name, target, key, number in (("last_stored", last, "a_s_0", "20"), ("credit_stored", credit_last, "a_t_0", "")):
        stored = str(tmp_path / name)
        spark.createDataFrame([(key, number), ("z_z_0", "0")], "rowkey string, v string").write.parquet(stored)
        jobs.main(["snapshot", "--table", stored, "--value", "v", "--out", target])
    assert read_keyed(spark, last).count() == 1 and read_keyed(spark, credit_last).count() == 0

    jobs.main(["income", "--run", run, "--date", "20240102", "--last-day", last,
               "--credit-last-day", credit_last, "--account", "a", "--out", out])
    got = {r["book"]: json.loads(r["income_json"]) for r in read_keyed(spark, out).collect()}
    assert got == {
        "ordinary": {"tradeValue": "6.0000", "lastDayAsset": "20.0000", "todayIncome": "-1.0000",
                     "realAsset": "25.0000", "stockCode": "s"},
        "credit": {"tradeValue": "-1.0000", "lastDayAsset": "0.0000", "todayIncome": "31.0000",
                   "realAsset": "30.0000", "stockCode": "t"}}


def test_quotes(spark, tmp_path, tables):
    answers, out = str(tmp_path / "answers"), str(tmp_path / "out")
    spark.createDataFrame([("1", '{"results": [[9, "t"], [8, "new"]]}')], "exchange_type string, value string").write.parquet(answers)
    jobs.main(["quotes", "--prices", f"{tables}/prices", "--answers", answers, "--out", out])
    got = read_keyed(spark, out)
    assert rows(got, "stock_code", "exchange_type", "asset_price", "market_price") == [
        ("new", "1", None, "8.0000"), ("s", "1", "2", "2.5"), ("t", "1", "3", "9.0000")]
    assert set(got.columns) == set(schemas.PRICES.fieldNames()), "the other columns stay"
    jobs.main(["quotes", "--prices", out, "--answers", answers, "--out", out])
    assert rows(read_keyed(spark, out)) == rows(got), "prices may be refreshed in place"


@pytest.mark.parametrize("job", ["orders", "transfers", "documents", "rejects"])
def test_stream_options(job):
    paths = ["--seen", "s", "--totals", "t"] if job == "orders" else ["--out", "o"]
    args = jobs.parser().parse_args([job, "--servers", "h:1", "--topics", "x", "--checkpoint", "c", *paths,
                                     "--per-trigger", "200"])
    assert args.every == ("5 seconds" if job == "orders" else "10 seconds") and args.per_trigger == 200
