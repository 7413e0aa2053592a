"""The valuation and event rules as pure column expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code lists the rules test against.
SELL = "2"
ORDER_TABLES = ("ENTRUST", "CBSENTRUST", "CBPENTRUST", "", "CRDTENTRUST")
ORDER_OPERATIONS = ("I", "U")
JOURNAL_TABLES = ("FUNDJOUR", "")
JOURNAL_OPERATIONS = ("I", "U")
JOURNAL_CURRENCIES = ("0", "1")
JOURNAL_FLAGS = ("2041", "2042", "2141", "2142")
TRADE_STATUSES = ("0", "4")
TRADE_TYPES = ("0",)
CREDIT_TRADE_TYPES = ("6", "7", "8", "9")
OPEN_CONTRACT = "0"
QUOTE_PREFIXES = {"G": "HK:", "S": "HK:", "2": "SZ:", "9": "SZ:", "1": "SH:"}

#: Amounts of up to 26 digits before the point; sums use all 38 digits.
AMOUNT_TYPE = "decimal(30,4)"

#: Parts of a quantity, a quantity, and a price: a product of the last two has 38 digits,
#: eight of them after the point, so none is lost.
PART_TYPE, QUANTITY_TYPE, PRICE_TYPE, VALUE_TYPE = "decimal(23,4)", "decimal(24,4)", "decimal(13,4)", "decimal(38,8)"

#: Columns that are multiplied; all other amounts are only added.
_TYPES = {**dict.fromkeys(("current_amount", "correct_amount", "real_buy_amount", "real_sell_amount"), PART_TYPE),
          **dict.fromkeys(("asset_price", "market_price", "nav"), PRICE_TYPE)}


def _type_of(name: str) -> str:
    return _TYPES.get(name, AMOUNT_TYPE)


def _parsed(df: DataFrame, name: str) -> Column:
    column, kind = F.col(name), _type_of(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return column.try_cast(kind)
    # Empty text is common and a failed cast is slow, so it never gets that far.
    text = F.when(column != "", column)
    # Spellings such as "1d" only read as a double.
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))


def amount(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as an exact amount; empty, missing, unreadable or too large is 0."""
    return F.coalesce(_parsed(df, name), F.lit(0).cast(_type_of(name)))


def is_bad_amount(df: DataFrame, name: str) -> Column:
    """True where ``name`` holds something that :func:`amount` has to count as 0, or has to round."""
    filled = F.col(name).isNotNull()
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        filled = F.trim(name) != ""
    rounded = F.lit(False)
    if isinstance(kind, T.StringType) or (isinstance(kind, T.DecimalType) and kind.scale > 4):
        # More decimals than an amount has; what does not fit here does not fit an amount either.
        rounded = F.col(name).try_cast("decimal(38,10)") != _parsed(df, name)
    return F.coalesce(filled & (_parsed(df, name).isNull() | F.coalesce(rounded, F.lit(False))), F.lit(False))


def value_of(quantity: Column | str, price: Column | str) -> Column:
    """Quantity times price with all eight decimals."""
    quantity, price = (F.col(c) if isinstance(c, str) else c for c in (quantity, price))
    return (quantity.cast(QUANTITY_TYPE) * price.cast(PRICE_TYPE)).cast(VALUE_TYPE)


def position_quantity(df: DataFrame) -> Column:
    """Shares held: current + correction + bought - sold."""
    parts = (amount(df, "current_amount") + amount(df, "correct_amount")
             + amount(df, "real_buy_amount") - amount(df, "real_sell_amount"))
    return parts.cast(QUANTITY_TYPE)


def cash_balance(df: DataFrame) -> Column:
    """Cash held: buying spends it and selling brings it in."""
    return (amount(df, "current_balance") + amount(df, "correct_balance")
            - amount(df, "real_buy_balance") + amount(df, "real_sell_balance"))


def contract_debt(df: DataFrame) -> Column:
    """Open principal plus fee of one credit contract."""
    return amount(df, "real_compact_balance") + amount(df, "real_compact_fare")


def signed_trade_value(df: DataFrame) -> Column:
    """Trade value, negative for a sale."""
    value = amount(df, "business_balance")
    return F.when(F.col("entrust_bs") == SELL, -value).otherwise(value)


def effective_price(df: DataFrame) -> Column:
    """The quote where there is one above zero, else the closing price."""
    quote = _parsed(df, "market_price")
    return F.when(quote > 0, quote).otherwise(_parsed(df, "asset_price"))


def equals_or_missing(name: str, value: str) -> Column:
    """``name = value``, letting rows without the cell pass.

    Spelled as an OR, which the Parquet reader takes as a pushed filter;
    ``coalesce(name = value, true)`` would not be pushed.
    """
    return (F.col(name) == value) | F.col(name).isNull()


def is_order_event() -> Column:
    """An insert or update (case matters) of one of the order tables."""
    return F.col("oper_type").isin(*ORDER_OPERATIONS) & F.col("tablename").isin(*ORDER_TABLES)


def is_transfer_event() -> Column:
    """An insert or update (any case) of a bank transfer in the fund journal."""
    return reduce(and_, [
        F.upper("oper_type").isin(*JOURNAL_OPERATIONS),
        F.col("tablename").isin(*JOURNAL_TABLES),
        F.col("money_type").isin(*JOURNAL_CURRENCIES),
        F.col("business_flag").isin(*JOURNAL_FLAGS),
    ])


def entrust_time() -> Column:
    """Second of an order, ``yyyyMMddHHmmss``, from date and unpadded clock time."""
    return F.substring(F.concat(F.col("init_date"), F.lpad("curr_time", 9, "0")), 1, 14)


def second_time(second: Column) -> Column:
    """A second as :func:`entrust_time` writes it as a time of the session's zone; null if it is none."""
    return F.try_to_timestamp(second, F.lit("yyyyMMddHHmmss"))


def quote_symbol() -> Column:
    """Instrument name at the quote service; null for an unlisted exchange."""
    exchange = F.col("exchange_type")
    prefix = F.lit(None).cast("string")
    for code, text in QUOTE_PREFIXES.items():
        prefix = F.when(exchange == code, text).otherwise(prefix)
    return F.concat(prefix, F.col("stock_code"))


def in_session(ts: str, begin: str = "09:10", end: str = "19:00") -> Column:
    """Monday to Friday, strictly between two clock minutes.

    The weekday is that of ``ts`` itself (the reference tests a date that is
    always 1 January 1970).
    """
    minute = F.date_format(ts, "HH:mm")
    return (minute > begin) & (minute < end) & ~F.dayofweek(ts).isin(1, 7)


def text4(value: Column) -> Column:
    """Number as text with four decimals and no thousands mark; no minus zero."""
    text = F.call_function("format_number", value, F.lit("0.0000"))
    return F.when(text == "-0.0000", F.lit("0.0000")).otherwise(text)


def joined_key(*names: str) -> Column:
    """Field name of a hash entry: the key columns joined by ``_``."""
    return F.concat_ws("_", *names)


def key_part(key: str, position: int) -> Column:
    """Piece ``position`` (from 0) of a joined key."""
    return F.split(F.col(key), "_").getItem(position)
