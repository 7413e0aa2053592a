"""Brokerage record shapes derived from star-schema tables.

Each text is valid in Spark and in DuckDB; ``{name}`` stands for a stored table.
The derived columns are text, with empty, missing and repeated values, so that
every rule has rows to act on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import new_folder
from tallyhouse.sources.tables import scan_table

SHAPES = {
    "fx_positions": """
select cast(o.o_custkey as string) as fund_account,
       cast(l.l_partkey as string) as stock_code,
       case when l.l_linenumber = 7 then 'X'
            when l.l_partkey % 5 = 0 then 'G' when l.l_partkey % 5 = 1 then 'S'
            when l.l_partkey % 5 = 2 then '2' when l.l_partkey % 5 = 3 then '9' else '1' end as exchange_type,
       case when l.l_linestatus = 'O' then '0' else '1' end as money_type,
       case when l.l_returnflag = 'R' then 'credit' else 'ordinary' end as book,
       cast(cast(l.l_quantity as int) as string) as current_amount,
       cast(l.l_linenumber as string) as correct_amount,
       case when l.l_returnflag = 'N' then '' else cast(l.l_suppkey as string) end as real_buy_amount,
       case when l.l_returnflag = 'A' then '' else cast(l.l_linenumber as string) end as real_sell_amount
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
""",
    "fx_position_keys": """
select cast(l_partkey as string) as stock_code,
       case when l_linenumber = 7 then 'X'
            when l_partkey % 5 = 0 then 'G' when l_partkey % 5 = 1 then 'S'
            when l_partkey % 5 = 2 then '2' when l_partkey % 5 = 3 then '9' else '1' end as exchange_type
from {lineitem}
""",
    "fx_holding_keys": """
select cast(l_suppkey % 9 as string) as prod_code, cast(l_suppkey % 2 as string) as prodta_no
from {lineitem}
""",
    "fx_prices": """
select cast(p_partkey as string) as stock_code,
       case when p_partkey % 5 = 0 then 'G' when p_partkey % 5 = 1 then 'S'
            when p_partkey % 5 = 2 then '2' when p_partkey % 5 = 3 then '9' else '1' end as exchange_type,
       cast(p_retailprice as decimal(18,2)) as asset_price,
       case when p_size % 3 = 0 then null
            when p_size % 3 = 1 then cast(0 as decimal(18,2))
            else cast(p_retailprice + 5 as decimal(18,2)) end as market_price
from {part}
""",
    "fx_nav": """
select concat('rowkey_', cast(s_suppkey as string)) as rowkey,
       cast(s_suppkey % 7 as string) as prod_code,
       cast(s_suppkey % 2 as string) as prodta_no,
       cast(abs(s_acctbal) as decimal(18,2)) as nav
from {supplier}
""",
    "fx_offexchange": """
select cast(o.o_custkey as string) as fund_account,
       case when l.l_linestatus = 'O' then '0' else '1' end as money_type,
       cast(l.l_suppkey % 9 as string) as prod_code,
       cast(l.l_suppkey % 2 as string) as prodta_no,
       cast(l.l_quantity as decimal(18,2)) as current_amount,
       cast(0 as decimal(18,2)) as correct_amount,
       cast(l.l_linenumber as decimal(18,2)) as real_buy_amount,
       cast(1 as decimal(18,2)) as real_sell_amount
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
""",
    "fx_cash": """
select cast(c_custkey as string) as fund_account,
       case when c_nationkey % 2 = 0 then '0' else '1' end as money_type,
       case when c_custkey % 10 = 0 then cast(0 as decimal(18,2)) else cast(c_acctbal as decimal(18,2)) end as current_balance,
       cast(0 as decimal(18,2)) as correct_balance,
       case when c_custkey % 10 = 0 then cast(0 as decimal(18,2)) else cast(c_nationkey as decimal(18,2)) end as real_buy_balance,
       cast(0 as decimal(18,2)) as real_sell_balance
from {customer}
""",
    "fx_contracts": """
select cast(o_custkey as string) as fund_account,
       case when o_orderkey % 2 = 0 then '0' else '1' end as money_type,
       case o_orderstatus when 'F' then '0' when 'O' then '1' else null end as compact_type,
       cast(o_totalprice as decimal(18,2)) as real_compact_balance,
       cast(o_orderkey % 100 as decimal(18,2)) as real_compact_fare
from {orders}
""",
    "fx_contracts_text": """
select cast(o_custkey as string) as fund_account,
       case when o_orderkey % 2 = 0 then '0' else '1' end as money_type,
       case o_orderstatus when 'F' then '0' when 'O' then '1' else null end as compact_type,
       cast(cast(o_totalprice as decimal(18,2)) as string) as real_compact_balance,
       case when o_orderkey % 100 = 13 then 'none' when o_orderkey % 100 = 14 then '13.00005'
            else cast(o_orderkey % 100 as string) end as real_compact_fare
from {orders}
""",
    "fx_journal": """
select cast(o_custkey as string) as fund_account,
       case when o_orderkey % 2 = 0 then '0' else '1' end as money_type,
       cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as string) as init_date,
       case o_orderpriority when '1-URGENT' then '2041' when '2-HIGH' then '2042'
            when '3-MEDIUM' then '2141' when '5-LOW' then '2142' else '9999' end as business_flag,
       cast(case when o_orderstatus = 'O' then -o_totalprice else o_totalprice end as decimal(18,2)) as occur_balance
from {orders}
""",
    "fx_trades": """
select cast(o.o_custkey as string) as fund_account,
       cast(l.l_partkey as string) as stock_code,
       cast(year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate) as string) as init_date,
       cast(case when l.l_linenumber <= 4 then 0 else l.l_linenumber + 2 end as string) as real_type,
       cast(case when l.l_suppkey % 3 = 0 then 0 when l.l_suppkey % 3 = 1 then 4 else 2 end as string) as real_status,
       case when l.l_returnflag = 'R' then '2' else '1' end as entrust_bs,
       cast(l.l_extendedprice as decimal(18,2)) as business_balance
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
""",
    "fx_lastday": """
select cast(o.o_custkey as string) as fund_account,
       cast(l.l_partkey as string) as stock_code,
       case when l.l_linestatus = 'O' then '0' else '1' end as money_type,
       case when l.l_returnflag = 'R' then 'credit' else 'ordinary' end as book,
       cast(sum(case when l.l_linenumber = 1 then 0 else cast(l.l_extendedprice as decimal(18,2)) end) as decimal(18,2)) as value
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
group by 1, 2, 3, 4
""",
    "fx_cdc": """
select event_id,
       ts,
       case when event_id % 2 = 0 then 'trades' else 'journal' end as topic,
       cast((event_id % 4 - event_id % 2) / 2 as int) as part,
       cast((event_id - event_id % 4) / 4 as bigint) + case when event_id % 2 = 0 then 5000 else 0 end as off,
       case event_type when 'click' then 'ENTRUST' when 'view' then 'CBSENTRUST'
            when 'purchase' then 'CRDTENTRUST' when 'signup' then 'FUNDJOUR' else '' end as tablename,
       case event_id % 4 when 0 then 'I' when 1 then 'U' when 2 then 'D' else 'i' end as oper_type,
       concat(cast(user_id as string), '_', regexp_extract(props, '[0-9]+', 0)) as position_str,
       cast(user_id as string) as fund_account,
       cast(event_id % 3 as string) as money_type,
       case event_id % 5 when 0 then '2041' when 1 then '2042' when 2 then '2141' when 3 then '2142' else '9999' end as business_flag,
       cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as string) as init_date,
       cast(hour(ts) * 10000000 + (minute(ts) - minute(ts) % 10) * 100000 as string) as curr_time,
       cast(value as decimal(18,2)) as balance
from {events}
""",
    "fx_instruments": """
select case when p_partkey % 10 = 0 then '' else cast(p_partkey as string) end as stock_code,
       case when p_size % 2 = 0 then '0' else '1' end as money_type,
       case when p_partkey % 6 = 0 then 'G' when p_partkey % 6 = 1 then 'S'
            when p_partkey % 6 = 2 then '2' when p_partkey % 6 = 3 then '9'
            when p_partkey % 6 = 4 then '1' else 'K' end as exchange_type
from {part}
""",
    "fx_quotes": """
select case when p_partkey % 10 = 4 then concat('N', cast(p_partkey as string))
            else cast(p_partkey as string) end as stock_code,
       case when p_partkey % 5 = 0 then 'G' when p_partkey % 5 = 1 then 'S'
            when p_partkey % 5 = 2 then '2' when p_partkey % 5 = 3 then '9' else '1' end as exchange_type,
       cast(p_retailprice + 7 as decimal(18,2)) as market_price
from {part}
where p_partkey % 2 = 0
""",
    "fx_doc_cdc": """
select event_id,
       ts,
       case when event_id % 2 = 0 then 'trades' else 'journal' end as topic,
       cast((event_id % 4 - event_id % 2) / 2 as int) as part,
       cast((event_id - event_id % 4) / 4 as bigint) + case when event_id % 2 = 0 then 5000 else 0 end as off,
       case event_id % 8 when 0 then 'STOCKREAL' when 1 then 'CRDTSTOCKREAL' when 2 then 'SECUMREAL'
            when 3 then 'COMPACT' when 4 then 'BANKTRANSFER' when 5 then 'ENTRUST' else 'FUNDJOUR' end as tablename,
       case when event_id % 32 < 8 then 'I' when event_id % 32 < 16 then 'U'
            when event_id % 32 < 24 then 'D' else 'i' end as oper_type,
       concat(cast(user_id as string), '_', regexp_extract(props, '[0-9]+', 0)) as position_str,
       concat('C', regexp_extract(props, '[0-9]+', 0)) as compact_id,
       cast(user_id as string) as fund_account,
       case when event_id % 24 < 8 then '0' when event_id % 24 < 16 then '1' else '2' end as money_type,
       case when event_id % 40 < 8 then '2041' when event_id % 40 < 16 then '2042'
            when event_id % 40 < 24 then '2141' when event_id % 40 < 32 then '2142'
            else '9999' end as business_flag,
       cast(value as decimal(18,2)) as balance
from {events}
""",
}



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table."""
    return scan_table(spark, f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived record shape over the tables in ``sf_dir``.

    The ``_keys`` shapes are the lookup keys of another shape without its join.
    """
    text = SHAPES[name]
    names = set(re.findall(r"{(\w+)}", text))
    sources = {t: table(spark, sf_dir, t) for t in names}
    return spark.sql(text, **sources)


#: How the shapes of order lines come by the account of a line.
_LINES = "{lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey"


def shapes_of_lines(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Several shapes of order lines, the same rows as :func:`shape` gives one by one.

    Lines and orders are joined once and the columns that the shapes name are written for
    all of them, so that a line is shuffled to its order once and not once a shape. Totals
    by account and stock are grouped by the numbers and not by their longer texts.
    """
    texts = [SHAPES[name] for name in names]
    columns = sorted({column for text in texts for column in re.findall(r"\b[lo]\.(\w+)", text.replace(_LINES, ""))})
    joined = spark.sql(f"select {', '.join(columns)} from {_LINES}",
                       lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders"))
    path = new_folder(spark, "lines")
    joined.write.parquet(path)
    lines = scan_table(spark, path, schema=joined.schema)
    return [spark.sql(text.replace(_LINES, "{lines} l").replace("o.o_", "l.o_")
                      .replace("group by 1, 2,", "group by l.o_custkey, l.l_partkey,"), lines=lines) for text in texts]


def _json_messages(events: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Events as a message source delivers them.

    Every second message holds ``columnInfo`` as text instead of as an object. There are
    two topics of two partitions, and an offset of the one is far from that of the other
    at the same time.
    """
    info = F.struct(*[F.col(column).cast("string").alias(name) for name, column in fields.items()])
    head = [F.col("tablename").alias("Tablename"), F.col("oper_type").alias("operType"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timeload")]
    nested = F.to_json(F.struct(*head, info.alias("columnInfo")))
    quoted = F.to_json(F.struct(*head, F.to_json(info).alias("columnInfo")))
    return events.select(F.when(F.col("event_id") % 2 == 0, nested).otherwise(quoted).alias("value"),
                         "topic", F.col("part").alias("partition"), F.col("off").alias("offset"),
                         F.col("ts").cast("timestamp").alias("message_time"))


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and journal changes as JSON messages."""
    return _json_messages(shape(spark, sf_dir, "fx_cdc"), {
        "POSITION_STR": "position_str", "FUND_ACCOUNT": "fund_account", "MONEY_TYPE": "money_type",
        "BUSINESS_FLAG": "business_flag", "INIT_DATE": "init_date", "CURR_TIME": "curr_time",
        "BUSINESS_BALANCE": "balance", "OCCUR_BALANCE": "balance"})


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, one in fifty cut off and one in fifty without a key."""
    place = F.col("offset") % 50
    whole = change_messages(spark, sf_dir)
    keyless = F.regexp_replace("value", "POSITION_STR", "OTHER_STR")
    return whole.withColumn("value", F.when(place == 7, F.substring("value", 1, 20))
                            .when(place == 8, keyless).otherwise(F.col("value")))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the indexed tables as JSON messages."""
    return _json_messages(shape(spark, sf_dir, "fx_doc_cdc"), {
        "POSITION_STR": "position_str", "COMPACT_ID": "compact_id", "FUND_ACCOUNT": "fund_account",
        "MONEY_TYPE": "money_type", "BUSINESS_FLAG": "business_flag", "OCCUR_BALANCE": "balance"})


def quote_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the quote service, each with two quotes of one exchange.

    The first price is a JSON number and the second is text.
    """
    prices = shape(spark, sf_dir, "fx_prices").select(
        "exchange_type", "stock_code", F.col("asset_price").cast("string").alias("price"),
        (F.col("asset_price") + 1).cast("string").alias("price_r"))
    body = F.format_string('{"results": [[%s, "%s"], ["%s", "%sR"]]}',
                           "price", "stock_code", "price_r", "stock_code")
    return prices.select("exchange_type", body.alias("value"))
