"""Record shapes: stored tables, change messages and results.

Stored cells are text; :mod:`tallyhouse.functions.rules` turns them into numbers.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_AMOUNTS = ("current_amount", "correct_amount", "real_buy_amount", "real_sell_amount")

POSITIONS = _text("rowkey", "fund_account", "stock_code", "exchange_type", "money_type", *_AMOUNTS)
PRICES = _text("rowkey", "stock_code", "exchange_type", "money_type", "asset_price", "market_price")
HOLDINGS = _text("rowkey", "fund_account", "money_type", "prodta_no", "prod_code", *_AMOUNTS)
NAVS = _text("rowkey", "prod_code", "prodta_no", "nav")
CASH = _text("rowkey", "fund_account", "money_type", "current_balance", "correct_balance",
             "real_buy_balance", "real_sell_balance")
CONTRACTS = _text("rowkey", "fund_account", "money_type", "compact_type",
                  "real_compact_balance", "real_compact_fare")
JOURNAL = _text("rowkey", "fund_account", "money_type", "init_date", "occur_balance")
TRADES = _text("rowkey", "fund_account", "stock_code", "init_date", "real_type", "real_status",
               "entrust_bs", "business_balance")
SNAPSHOT = _text("rowkey", "value")

#: Key columns of each stored table.
KEYS = {
    "positions": ("fund_account", "position_str"),
    "prices": ("stock_code", "exchange_type"),
    "holdings": ("fund_account", "money_type", "prod_code", "prodta_no"),
    "navs": ("prod_code", "prodta_no"),
    "cash": ("fund_account", "money_type"),
    "contracts": ("compact_id",),
    "journal": ("position_str",),
    "trades": ("position_str",),
}

#: What a message source delivers; the names are those of Spark's Kafka source.
MESSAGE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("message_time", T.TimestampType()),
])

#: The order of messages: by the time the stream gave them, which is comparable across
#: topics and partitions as offsets are not, then by place. A missing time comes first.
ORDER = ("message_time", "topic", "partition", "offset")

_ORDER_FIELDS = [next(f for f in MESSAGE.fields if f.name == n) for n in ORDER]

#: A message's place in that order, as one value.
AT = T.StructType(_ORDER_FIELDS)

#: The change envelope. ``columnInfo`` stays text on the first parse: Spark hands
#: over a nested object as its JSON text and a quoted one unescaped, so both
#: spellings read the same. ``_corrupt_record`` holds what does not parse.
ENVELOPE = _text("Tablename", "operType", "timeload", "columnInfo", "_corrupt_record")

#: Fields of ``columnInfo`` that any job reads.
COLUMN_INFO = _text("POSITION_STR", "COMPACT_ID", "FUND_ACCOUNT", "MONEY_TYPE", "BUSINESS_FLAG",
                    "INIT_DATE", "CURR_TIME", "BUSINESS_BALANCE", "OCCUR_BALANCE",
                    "_corrupt_record")

MONEY = T.DecimalType(30, 4)

FIRST_SEEN = T.StructType([
    T.StructField("position_str", T.StringType()),
    *_ORDER_FIELDS,
    T.StructField("entrust_time", T.StringType()),
    T.StructField("balance", MONEY),
])

SECOND_TOTALS = T.StructType([
    T.StructField("init_date", T.StringType()),
    T.StructField("load_time", T.StringType()),
    T.StructField("entrust_num", T.LongType()),
    T.StructField("balance", T.DecimalType(38, 4)),
])

TRANSFERS = T.StructType([
    T.StructField("position_str", T.StringType()),
    T.StructField("first_at", AT),
    T.StructField("last_at", AT),
    T.StructField("init_time", T.StringType()),
    T.StructField("load_time", T.StringType()),
    T.StructField("balance", MONEY),
    T.StructField("fund_account", T.StringType()),
    T.StructField("money_type", T.StringType()),
    T.StructField("biz_dt", T.TimestampType()),
])

DOCUMENTS = T.StructType([
    T.StructField("index", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    *_ORDER_FIELDS,
    T.StructField("fund_account", T.StringType()),
    T.StructField("money_type", T.StringType()),
    T.StructField("occur_balance", MONEY),
    T.StructField("time_load", T.StringType()),
    T.StructField("biz_dt", T.TimestampType()),
])

#: Next offset to read, by the batch that settled it.
OFFSETS = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("until_offset", T.LongType()),
])

REJECTS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("corrupt", T.StringType()),
])

RUN_LOG = T.StructType([
    T.StructField("biz_date", T.StringType()),
    T.StructField("step_name", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()),
    T.StructField("rows_written", T.LongType()),
    T.StructField("bad_amounts", T.LongType()),
])
