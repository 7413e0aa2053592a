"""Quotes: symbols to ask for, answers to parse, prices to refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import rules


def quote_symbol(instruments: DataFrame) -> DataFrame:
    """Instruments of a quoted exchange with the ``symbol`` to ask for."""
    return instruments.withColumn("symbol", rules.quote_symbol()).filter("symbol is not null")


def quote_explode(answers: DataFrame, value: str = "value") -> DataFrame:
    """Price and code of each quote in JSON answers ``{"results": [[price, code], ...]}``.

    Keeps the other columns of ``answers``, such as the exchange asked about.
    """
    rest = [c for c in answers.columns if c != value]
    parsed = F.from_json(value, "results array<array<string>>")
    quotes = answers.select(*rest, F.explode(parsed["results"]).alias("_quote"))
    price = F.try_element_at("_quote", F.lit(1)).try_cast(rules.AMOUNT_TYPE)
    return quotes.select(*rest, F.try_element_at("_quote", F.lit(2)).alias("stock_code"),
                         price.alias("market_price"))


def quote_upsert(prices: DataFrame, quotes: DataFrame) -> DataFrame:
    """Prices with ``market_price`` replaced where a quote came in; other columns stay.

    A price key that repeats keeps the row of the last row key, as the valuation does.
    ``quotes`` has (stock_code, exchange_type, market_price) and may have ``seq``; the
    greatest wins if a key is quoted twice, the higher price at one ``seq``. A quote
    without a number is left out; one for an unknown key makes a new row whose other
    columns are null. Stacked and aggregated, which is the full outer join of the two
    with one shuffle and no sort of the whole rows.
    """
    keys = ["stock_code", "exchange_type"]
    rest = [c for c in prices.columns if c not in (*keys, "market_price")]
    row = F.struct(*rest, "market_price") if rest else F.struct("market_price")
    order = F.col("rowkey") if "rowkey" in prices.columns else F.struct(*rest, "market_price")
    seq = F.col("seq").cast("long") if "seq" in quotes.columns else F.lit(0).cast("long")
    price_type, quote_type = prices.schema["market_price"].dataType, quotes.schema["market_price"].dataType
    old = prices.select(*keys, row.alias("_row"), F.struct(order.alias("_by")).alias("_order"),
                        F.lit(None).cast(quote_type).alias("_quote"), F.lit(None).cast("long").alias("_seq"))
    new = (quotes.filter("market_price is not null")
           .select(*keys, F.lit(None).cast(old.schema["_row"].dataType).alias("_row"),
                   F.lit(None).cast(old.schema["_order"].dataType).alias("_order"),
                   F.col("market_price").alias("_quote"), seq.alias("_seq")))
    quoted = F.col("_quote").isNotNull()
    merged = old.unionByName(new).groupBy(*keys).agg(
        F.max_by("_row", "_order").alias("_row"),
        F.max(F.when(quoted, F.struct("_seq", "_quote"))).alias("_new"))
    return merged.select(*[F.col(c) if c in keys else
                           F.coalesce(F.col("_new._quote").cast(price_type), F.col("_row.market_price")).alias(c)
                           if c == "market_price" else F.col(f"_row.{c}").alias(c) for c in prices.columns])
