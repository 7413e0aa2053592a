"""Today's income of each stock held: value now - traded today - value last day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import rules

_STOCK = ("book", "fund_account", "stock_code")

#: Result amounts and the column of the input each comes from.
_AMOUNTS = {"real_asset": "market_value", "last_day_asset": "value", "trade_value": "net_trade"}


def stock_income_today(valued: DataFrame, trades: DataFrame, last_day: DataFrame) -> DataFrame:
    """Income per (book, account, stock, currency) held now, for all accounts.

    ``valued`` are priced positions with ``market_value``, ``trades`` signed trade
    values ``net_trade``, ``last_day`` snapshot rows ``value``, each with ``book``.

    The three inputs are stacked and summed in one aggregate instead of being
    joined: rows add up before the shuffle, and no join can be skewed. Trades carry
    no currency; where an account holds a stock in two, the trade value goes to the
    lowest ``money_type`` so that it counts once. The window below only sees the
    currencies of one stock. Stocks sold out today have no row, as in the reference.
    """
    inputs = {"real_asset": valued, "last_day_asset": last_day, "trade_value": trades}
    # Each amount comes from one input and keeps its type, so none is widened row by row.
    kinds = {name: df.schema[_AMOUNTS[name]].dataType for name, df in inputs.items()}

    def entries(amount: str) -> DataFrame:
        df = inputs[amount]
        currency = F.col("money_type") if "money_type" in df.columns else F.lit(None).cast("string")
        amounts = [(F.col(_AMOUNTS[n]) if n == amount else F.lit(None).cast(kind)).alias(n)
                   for n, kind in kinds.items()]
        return df.select(*_STOCK, currency.alias("money_type"), *amounts)

    stacked = reduce(DataFrame.unionByName, map(entries, inputs))
    totals = (stacked.groupBy(*_STOCK, "money_type").agg(*[F.sum(c).alias(c) for c in _AMOUNTS])
              # What was sold out before today has no row and no part in another's.
              .filter(F.col("real_asset").isNotNull() | F.col("trade_value").isNotNull()))
    # Held rows come first, lowest currency first; the trade row has no real_asset.
    # Both windows use the one order, so the rows are sorted once.
    ranked = Window.partitionBy(*_STOCK).orderBy(F.col("real_asset").isNull(), "money_type")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    placed = (
        totals.select("*", F.sum("trade_value").over(whole).alias("_traded"),
                      F.row_number().over(ranked).alias("_place"))
        .filter(F.col("real_asset").isNotNull())
        .withColumn("trade_value", F.when(F.col("_place") == 1, F.coalesce("_traded", zero))
                    .otherwise(zero))
        .withColumn("last_day_asset", F.coalesce("last_day_asset", zero))
    )
    # 36 digits each, so that the difference of three keeps all eight decimals.
    now, traded, before = (F.col(c).cast("decimal(36,8)") for c in ("real_asset", "trade_value", "last_day_asset"))
    income = now - traded - before
    return placed.select(*_STOCK, "money_type", "real_asset", "last_day_asset", "trade_value",
                         income.cast("decimal(38,8)").alias("today_income"))


def stock_income_text(income: DataFrame) -> DataFrame:
    """The four amounts as text with four decimals."""
    return income.select(*_STOCK, "money_type", *[rules.text4(F.col(c)).alias(c)
                                                  for c in (*_AMOUNTS, "today_income")])


def stock_income_json(income: DataFrame) -> DataFrame:
    """One JSON object per stock held, in the field names of the income service.

    One object per row rather than one list per account: an account may hold a
    large part of all rows, and a list would gather it in one task.
    """
    text = stock_income_text(income)
    body = F.struct(F.col("trade_value").alias("tradeValue"),
                    F.col("last_day_asset").alias("lastDayAsset"),
                    F.col("today_income").alias("todayIncome"),
                    F.col("real_asset").alias("realAsset"),
                    F.col("stock_code").alias("stockCode"))
    return text.select(*_STOCK, "money_type", F.to_json(body).alias("income_json"))


def account_rows(table: DataFrame, fund_account: str) -> DataFrame:
    """All rows of exactly one account (never a prefix, never a first page)."""
    return table.filter(F.col("fund_account") == fund_account)
