"""Prices, positions, cash, credit debt, fund inflow and trades.

Amounts stay decimals throughout, so a sum does not depend on the order of its
rows. Every total is one partial aggregate, one shuffle and one final aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.operators.keepone import keep_last
from tallyhouse.operators.lookup import left_lookup

PRICE_KEYS = ("stock_code", "exchange_type")
NAV_KEYS = ("prod_code", "prodta_no")


def _total(df: DataFrame, keys: Sequence[str], value: Column | str, name: str) -> DataFrame:
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(column).alias(name))


def _last_row(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    if "rowkey" not in df.columns:
        # Without an order no row of a repeated key is the last one, so a key that holds
        # two values stops the job.
        one = F.when(F.min(value).isNull() | (F.min(value) == F.max(value)), F.max(value)).otherwise(
            F.raise_error(F.lit(f"several values of {value} under one key and no rowkey to choose by")))
        return df.groupBy(*keys).agg(one.alias(value))
    return keep_last(df, keys, "rowkey", value).select(*keys, value)


def price_effective(prices: DataFrame) -> DataFrame:
    """One price per (stock, exchange): that of the last row key.

    A row that lacks a cell does not take the previous row's value (the
    reference leaks it); a missing price is null here and 0 once looked up.
    """
    priced = prices.withColumn("price", rules.effective_price(prices))
    columns = [c for c in ("rowkey",) if c in prices.columns]
    return _last_row(priced.select(*columns, *PRICE_KEYS, "price"), PRICE_KEYS, "price")


def nav_latest(navs: DataFrame) -> DataFrame:
    """One value per (product, registrar): that of the last row key, as text order."""
    columns = [c for c in ("rowkey",) if c in navs.columns]
    typed = navs.select(*columns, *NAV_KEYS, rules.amount(navs, "nav").alias("nav"))
    return _last_row(typed, NAV_KEYS, "nav")


def instrument_list(prices: DataFrame) -> DataFrame:
    """Instruments to ask quotes for: every price row with a stock code, quote 0."""
    return (prices.filter(F.col("stock_code") != "")
            .select("stock_code", "money_type", "exchange_type",
                    F.lit(0).cast(rules.AMOUNT_TYPE).alias("market_price")))


def position_quantity(positions: DataFrame) -> DataFrame:
    """Positions with ``quantity`` in place of its four parts."""
    parts = ("current_amount", "correct_amount", "real_buy_amount", "real_sell_amount")
    return positions.withColumn("quantity", rules.position_quantity(positions)).drop(*parts)


def position_market_value(positions: DataFrame, prices: DataFrame, **lookup) -> DataFrame:
    """Each position with ``price`` (0 where none is known) and ``market_value``.

    ``lookup`` options go to :func:`~tallyhouse.operators.lookup.left_lookup`.
    """
    valued = left_lookup(position_quantity(positions), price_effective(prices), PRICE_KEYS,
                         **lookup)
    price = F.coalesce("price", F.lit(0).cast(rules.PRICE_TYPE))
    return (valued.withColumn("price", price)
            .withColumn("market_value", rules.value_of("quantity", "price")))


def stock_market_value(valued: DataFrame, *extra_keys: str) -> DataFrame:
    """Value per (account, stock, currency) of priced positions.

    Rows of the same key are summed; the reference lets an arbitrary one win.
    """
    keys = [*extra_keys, "fund_account", "stock_code", "money_type"]
    return _total(valued, keys, "market_value", "market_value")


def account_market_value(valued: DataFrame, *extra_keys: str) -> DataFrame:
    """Value per (account, currency) of priced positions or of stock totals."""
    keys = [*extra_keys, "fund_account", "money_type"]
    return _total(valued, keys, "market_value", "market_value")


def offexchange_market_value(holdings: DataFrame, navs: DataFrame, **lookup) -> DataFrame:
    """Value per (account, currency) of fund holdings; 0 where no NAV is known."""
    valued = left_lookup(position_quantity(holdings), nav_latest(navs), NAV_KEYS, **lookup)
    nav = F.coalesce("nav", F.lit(0).cast(rules.PRICE_TYPE))
    return _total(valued, ["fund_account", "money_type"], rules.value_of("quantity", nav), "market_value")


def cash_balance(cash: DataFrame) -> DataFrame:
    """Cash per (account, currency), without zeros.

    The key is unique by configuration; copies are summed, where the reference
    keeps an arbitrary one.
    """
    total = _total(cash, ["fund_account", "money_type"], rules.cash_balance(cash), "balance")
    return total.filter(F.abs("balance") > 0)


def open_contracts(contracts: DataFrame) -> DataFrame:
    """Contracts that still run, or do not tell."""
    return contracts.filter(rules.equals_or_missing("compact_type", rules.OPEN_CONTRACT))


def credit_liability(contracts: DataFrame) -> DataFrame:
    """Debt per (account, currency) of open contracts; a missing type counts as open."""
    still_open = open_contracts(contracts)
    return _total(still_open, ["fund_account", "money_type"], rules.contract_debt(still_open), "liability")


def on_date(df: DataFrame, biz_date: str | None) -> DataFrame:
    """Rows of one business date, or without one; all rows if no date is given."""
    return df if biz_date is None else df.filter(rules.equals_or_missing("init_date", biz_date))


def fund_net_in(journal: DataFrame, biz_date: str | None = None) -> DataFrame:
    """Net inflow per (account, currency), of one business date if given."""
    return _total(on_date(journal, biz_date), ["fund_account", "money_type"],
                  rules.amount(journal, "occur_balance"), "net_in")


def valid_trades(trades: DataFrame, types: Sequence[str], biz_date: str | None = None) -> DataFrame:
    """Trades of the given types that count."""
    valid = F.col("real_status").isin(*rules.TRADE_STATUSES) & F.col("real_type").isin(*types)
    return on_date(trades, biz_date).filter(valid)


def trade_rows(trades: DataFrame, types: Sequence[str], biz_date: str | None = None) -> DataFrame:
    """Valid trades of the given types with their signed value."""
    return (valid_trades(trades, types, biz_date)
            .select("fund_account", "stock_code", "real_type",
                    rules.signed_trade_value(trades).alias("net_trade")))


def trade_rows_by_book(trades: DataFrame, biz_date: str | None = None) -> DataFrame:
    """Valid trades of both kinds in one pass, with their ``book``."""
    rows = trade_rows(trades, (*rules.TRADE_TYPES, *rules.CREDIT_TRADE_TYPES), biz_date)
    book = F.when(F.col("real_type").isin(*rules.TRADE_TYPES), "ordinary").otherwise("credit")
    return rows.withColumn("book", book)


def trade_net(trades: DataFrame, biz_date: str | None = None) -> DataFrame:
    """Net trade value per (account, stock), ordinary trades."""
    rows = trade_rows(trades, rules.TRADE_TYPES, biz_date)
    return _total(rows, ["fund_account", "stock_code"], "net_trade", "net_trade")


def trade_net_credit(trades: DataFrame, biz_date: str | None = None) -> DataFrame:
    """Net trade value per (account, stock), credit trades."""
    rows = trade_rows(trades, rules.CREDIT_TRADE_TYPES, biz_date)
    return _total(rows, ["fund_account", "stock_code"], "net_trade", "net_trade")
