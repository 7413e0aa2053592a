"""Jobs to submit: ``python -m tallyhouse JOB --help``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import income, quotes, snapshots
from tallyhouse.plans.valuation_run import ACCOUNT_STOCK_CURRENCY, STEPS, run_valuation
from tallyhouse.session import build_session
from tallyhouse.sinks.keyed import read_for_date, read_keyed, write_keyed
from tallyhouse.sources.messages import kafka_messages, saved_offsets
from tallyhouse.sources.tables import scan_table
from tallyhouse.streaming import documents, ledger, orders, rejects, transfers

#: Stored tables a valuation reads, by the folder they are in.
INPUTS = {"positions": schemas.POSITIONS, "credit_positions": schemas.POSITIONS,
          "prices": schemas.PRICES, "holdings": schemas.HOLDINGS, "navs": schemas.NAVS,
          "cash": schemas.CASH, "contracts": schemas.CONTRACTS, "journal": schemas.JOURNAL,
          "trades": schemas.TRADES, "credit_trades": schemas.TRADES}

#: Per book: tables of values now and of trades, as the valuation names them.
BOOKS = {"ordinary": ("stock_value", "net_trade"), "credit": ("credit_stock_value", "credit_net_trade")}


def valuation_job(spark: SparkSession, args: argparse.Namespace) -> None:
    inputs = {name: read_keyed(spark, f"{args.tables}/{name}", schema)
              for name, schema in INPUTS.items()}
    run_valuation(spark, inputs, args.out, args.date, args.steps or tuple(STEPS))


def snapshot_job(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = scan_table(spark, args.table, ["rowkey", F.col(args.value).alias("value")])
    rows = snapshots.snapshot_rows(snapshots.split_rowkey(stored, *args.keys))
    write_keyed(rows, args.out, args.keys)


def income_job(spark: SparkSession, args: argparse.Namespace) -> None:
    def stacked(frames: list[DataFrame]) -> DataFrame:
        return frames[0].unionByName(frames[1])

    def of_date(table: str, book: str) -> DataFrame:
        return read_for_date(spark, f"{args.run}/{table}", args.date).withColumn("book", F.lit(book))

    held = stacked([of_date(now, book) for book, (now, _) in BOOKS.items()])
    trades = stacked([of_date(traded, book) for book, (_, traded) in BOOKS.items()])
    last_day = stacked([read_keyed(spark, path).withColumn("book", F.lit(book))
                        for book, path in zip(BOOKS, (args.last_day, args.credit_last_day))])
    if args.account is not None:
        held, trades, last_day = (income.account_rows(df, args.account)
                                  for df in (held, trades, last_day))
    result = income.stock_income_json(income.stock_income_today(held, trades, last_day))
    write_keyed(result, args.out, ["fund_account", "stock_code", "money_type"])


def quotes_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """``answers`` holds (exchange_type, value) and, to order repeated quotes, seq. The result
    may take the place of the prices it was made from."""
    answers = quotes.quote_explode(spark.read.parquet(args.answers))
    prices = read_keyed(spark, args.prices, schemas.PRICES)
    write_keyed(quotes.quote_upsert(prices, answers), args.out, ["stock_code", "exchange_type"])


def _messages(spark: SparkSession, args: argparse.Namespace, start: str, group: str | None = None) -> DataFrame:
    """Messages from ``start``, or from where the ledger of ``group`` ends. A row a partition is read for that."""
    if getattr(args, "ledger", None) is not None:
        saved = ledger.offset_progress(spark, args.ledger).filter(F.col("group_id") == group).collect()
        start = saved_offsets(saved) or start
    return kafka_messages(spark, servers=args.servers, topics=args.topics, start=start,
                          per_trigger=args.per_trigger)


def orders_job(spark: SparkSession, args: argparse.Namespace) -> None:
    orders.start_orders(_messages(spark, args, "latest"), args.seen, args.totals, args.checkpoint,
                        args.every, args.forget_after).awaitTermination()


def seconds_job(spark: SparkSession, args: argparse.Namespace) -> None:
    orders.start_second_totals(_messages(spark, args, "earliest"), args.out, args.checkpoint, args.late_after,
                               args.ahead, args.skew, args.every).awaitTermination()


def _table_job(job) -> Callable[[SparkSession, argparse.Namespace], None]:
    start = {transfers: transfers.start_transfers, documents: documents.start_documents,
             rejects: rejects.start_rejects}[job]

    def run(spark: SparkSession, args: argparse.Namespace) -> None:
        more = {"late_after": args.late_after, "ahead": args.ahead} if job is rejects else {}
        start(_messages(spark, args, "earliest", job.GROUP), args.out, args.checkpoint, args.every,
              args.ledger, **more).awaitTermination()
    return run


def _list(text: str) -> list[str]:
    return text.split(",")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyhouse", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, text: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.set_defaults(job=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    job("valuation", valuation_job, "price positions and write the result tables of one date",
        "tables", "out", "date").add_argument("--steps", type=_list, help=",".join(STEPS))
    job("snapshot", snapshot_job, "load a last-day table", "table", "value", "out").add_argument(
        "--keys", type=_list, default=list(ACCOUNT_STOCK_CURRENCY), help="pieces of the row key")
    job("income", income_job, "income today per stock held, as JSON", "run", "date", "last-day",
        "credit-last-day", "out").add_argument("--account")
    job("quotes", quotes_job, "refresh prices from quote answers", "prices", "answers", "out")
    stream = ("servers", "topics", "checkpoint")
    order_job = job("orders", orders_job, "count and sum new orders per second", *stream, "seen", "totals")
    order_job.add_argument("--forget-after", help="forget keys this long after their time")
    order_job.add_argument("--every", default="5 seconds")
    tables = [job("transfers", _table_job(transfers), "keep the bank-transfer table", *stream, "out"),
              job("documents", _table_job(documents), "keep the index documents", *stream, "out"),
              job("rejects", _table_job(rejects), "list the messages that the other jobs leave out", *stream, "out")]
    for sub in tables:
        sub.add_argument("--every", default="10 seconds")
        sub.add_argument("--ledger", help="table of the offsets read; a job without a checkpoint starts from it")
    seconds = job("seconds", seconds_job, "count and sum orders per second by their own times", *stream, "out")
    seconds.add_argument("--every", default="5 seconds")
    seconds.add_argument("--skew", type=int, default=60, help="seconds that partitions may be read apart")
    for sub, needed in ((seconds, True), (tables[-1], False)):
        sub.add_argument("--late-after", type=int, required=needed, help="an order is late this many seconds after its time")
        sub.add_argument("--ahead", type=int, default=0, help="an order is early this many seconds before its time")
    for sub in (order_job, seconds, *tables):
        sub.add_argument("--per-trigger", type=int, help="most messages per micro-batch")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(build_session(), args)


if __name__ == "__main__":
    main()
