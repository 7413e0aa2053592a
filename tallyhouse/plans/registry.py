"""The registered queries, each with the SQL that gives the same rows.

The SQL runs on the stored tables alone. Amounts are decimals inside and doubles
in the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import rules
from tallyhouse.operators import documents, events, income, pairs, quotes, snapshots, valuation
from tallyhouse.plans import fixtures
from tallyhouse.plans.fixtures import shape, shapes_of_lines, table
from tallyhouse.plans.valuation_run import run_valuation
from tallyhouse.session import new_folder
from tallyhouse.sinks import deletes, outside, seen
from tallyhouse.sinks.keyed import lookup, read_for_date, read_keyed, write_for_date, write_keyed
from tallyhouse.sources.messages import file_messages
from tallyhouse.sources.tables import row_counts, scan_table
from tallyhouse.streaming import ledger, orders, rejects, replay, transfers
from tallyhouse.streaming.documents import documents_table

Query = Callable[[SparkSession, str], DataFrame]

#: Where a message came from, besides its time.
PLACE = ("topic", "partition", "offset")

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Parameters of the queries that look up one account, document or date.
ACCOUNT = "7"
BIZ_DATE = "19970115"
RUN_DATE = "20240102"
SCANNED = ("customer", "supplier", "part", "orders", "lineitem", "events")


def _oracle(sql: str) -> str:
    """``sql`` with the record shapes it names put in front of it."""
    names = [n for n in fixtures.SHAPES if re.search(rf"\b{n}\b", sql)]
    shapes = [f"{n} as ({re.sub(r'{(\w+)}', r'\1', fixtures.SHAPES[n])})" for n in names]
    own = re.match(r"\s*with\s+(.*)", sql, re.S | re.I)
    if own:
        return "with " + ",\n".join([*shapes, own.group(1)])
    return ("with " + ",\n".join(shapes) + "\n" if shapes else "") + sql


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = _oracle(sql)
        return function
    return register


def as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


# SQL pieces used by several oracles.
def _amt(column: str) -> str:
    return f"coalesce(try_cast(nullif({column}, '') as decimal(18,2)), 0)"


_QTY = (f"{_amt('current_amount')} + {_amt('correct_amount')} "
        f"+ {_amt('real_buy_amount')} - {_amt('real_sell_amount')}")
_PRICE = "case when market_price > 0 then market_price else asset_price end"
_VALUED = f"""valued as (
  select p.book, p.fund_account, p.stock_code, p.exchange_type, p.money_type,
         cast({_QTY} as decimal(18,2)) as quantity,
         cast(coalesce(x.price, 0) as decimal(18,2)) as price
  from fx_positions p left join (select stock_code, exchange_type, {_PRICE} as price from fx_prices) x
    on p.stock_code = x.stock_code and p.exchange_type = x.exchange_type)"""
_IS_ORDER = ("oper_type in ('I','U') and tablename in "
             "('ENTRUST','CBSENTRUST','CBPENTRUST','','CRDTENTRUST')")
_ORDERS = f"""ord as (
  select position_str, ts, topic, part as "partition", off as "offset", strftime(ts, '%Y-%m-%d %H:%M:%S') as timeload,
         substr(init_date || lpad(curr_time, 9, '0'), 1, 14) as entrust_time, balance
  from fx_cdc where {_IS_ORDER})"""
_FIRST = """first_seen as (
  select position_str, topic, "partition", "offset", entrust_time, balance from (
    select *, row_number() over (partition by position_str order by ts, topic, "partition", "offset") as n from ord)
  where n = 1)"""
_IS_TRANSFER = ("upper(oper_type) in ('I','U') and tablename in ('FUNDJOUR','') "
                "and money_type in ('0','1') and business_flag in ('2041','2042','2141','2142')")
_MERGED = f"""merged as (
  select position_str, first(ts order by ts, topic, part, off) as init_ts, last(ts order by ts, topic, part, off) as load_ts,
         last(balance order by ts, topic, part, off) as balance, last(fund_account order by ts, topic, part, off) as fund_account,
         last(money_type order by ts, topic, part, off) as money_type
  from fx_cdc where {_IS_TRANSFER} group by position_str)
select position_str, strftime(init_ts, '%Y-%m-%d %H:%M:%S') as init_time,
       strftime(load_ts, '%Y-%m-%d %H:%M:%S') as load_time, cast(balance as double) as balance,
       fund_account, money_type from merged"""
_JOURNAL_DOC = ("tablename in ('BANKTRANSFER','FUNDJOUR') and money_type in ('0','1') "
                "and business_flag in ('2041','2042','2141','2142')")
_DOCS = f"""routed as (
  select case when {_JOURNAL_DOC} then 'hs_asset_fundjour' when tablename = 'COMPACT' then 'hs_crdt_compact'
              when tablename = 'STOCKREAL' then 'hs_secu_stockreal'
              when tablename = 'CRDTSTOCKREAL' then 'hs_crdt_crdtstockreal'
              when tablename = 'SECUMREAL' then 'hs_prod_secumreal' end as index,
         case when tablename = 'COMPACT' then compact_id else position_str end as doc_id,
         ts, topic, part as "partition", off as "offset", fund_account, money_type,
         cast(case when {_JOURNAL_DOC} then balance else 0 end as decimal(18,2)) as occur_balance,
         strftime(ts, '%Y-%m-%d %H:%M:%S') as time_load
  from fx_doc_cdc where upper(oper_type) in ('I','U')),
docs as (
  select * from (
    select *, row_number() over (partition by index, doc_id order by ts desc, topic desc, "partition" desc, "offset" desc) as n
    from routed where index is not null) where n = 1)"""
_DOC_COLUMNS = ('index, doc_id, topic, "partition", "offset", fund_account, money_type, '
                'cast(occur_balance as double) as occur_balance, time_load')


def _valued(spark: SparkSession, sf_dir: str, book: str | None = None, positions: DataFrame | None = None, **lookup) -> DataFrame:
    if positions is None:
        positions = shape(spark, sf_dir, "fx_positions")
    if book is not None:
        positions = positions.filter(F.col("book") == book)
    return valuation.position_market_value(positions, shape(spark, sf_dir, "fx_prices"),
                                           keys_from=lambda: shape(spark, sf_dir, "fx_position_keys"), **lookup)


# --- sources ---------------------------------------------------------------

@query("select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem")
def src_scan(spark, sf_dir):
    return scan_table(spark, f"{sf_dir}/lineitem.parquet",
                      ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])


@query("\nunion all ".join(f"select '{t}' as source, count(*) as row_count from {t}" for t in SCANNED))
def src_counts(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in SCANNED})


# --- prices and positions --------------------------------------------------

@query(f"select stock_code, exchange_type, cast({_PRICE} as double) as price from fx_prices")
def price_effective(spark, sf_dir):
    return as_doubles(valuation.price_effective(shape(spark, sf_dir, "fx_prices")))


@query("""select prod_code, prodta_no, cast(last(nav order by rowkey) as double) as nav
from fx_nav group by prod_code, prodta_no""")
def nav_latest(spark, sf_dir):
    return as_doubles(valuation.nav_latest(shape(spark, sf_dir, "fx_nav")))


@query("""select stock_code, money_type, exchange_type, cast(0 as double) as market_price
from fx_instruments where stock_code <> ''""")
def instrument_list(spark, sf_dir):
    return as_doubles(valuation.instrument_list(shape(spark, sf_dir, "fx_instruments")))


@query(f"""select fund_account, stock_code, exchange_type, money_type, book,
       cast({_QTY} as double) as quantity from fx_positions""")
def position_quantity(spark, sf_dir):
    return as_doubles(valuation.position_quantity(shape(spark, sf_dir, "fx_positions")))


_POSITION_VALUE = f"""with {_VALUED}
select book, fund_account, stock_code, exchange_type, money_type, cast(quantity as double) as quantity,
       cast(price as double) as price, cast(quantity * price as double) as market_value from valued"""


@query(_POSITION_VALUE)
def position_market_value(spark, sf_dir):
    return as_doubles(_valued(spark, sf_dir))


@query(_POSITION_VALUE)
def position_market_value_salted(spark, sf_dir):
    """The way taken when the prices are too large to broadcast."""
    return as_doubles(_valued(spark, sf_dir, broadcast_limit=-1))


_STOCK_VALUE = f"""with {_VALUED}
select book, fund_account, stock_code, money_type, cast(sum(quantity * price) as double) as market_value
from valued group by book, fund_account, stock_code, money_type"""


@query(_STOCK_VALUE)
def stock_market_value(spark, sf_dir):
    return as_doubles(valuation.stock_market_value(_valued(spark, sf_dir), "book"))


_ACCOUNT_VALUE = f"""with {_VALUED}
select fund_account, money_type, cast(sum(quantity * price) as double) as market_value
from valued where book = '%s' group by fund_account, money_type"""


@query(_ACCOUNT_VALUE % "ordinary")
def account_market_value(spark, sf_dir):
    return as_doubles(valuation.account_market_value(_valued(spark, sf_dir, "ordinary")))


@query(_ACCOUNT_VALUE % "credit")
def account_market_value_credit(spark, sf_dir):
    return as_doubles(valuation.account_market_value(_valued(spark, sf_dir, "credit")))


@query("""with n as (select prod_code, prodta_no, last(nav order by rowkey) as nav
  from fx_nav group by prod_code, prodta_no)
select h.fund_account, h.money_type,
       cast(sum(cast(current_amount + correct_amount + real_buy_amount - real_sell_amount as decimal(18,2))
                * cast(coalesce(n.nav, 0) as decimal(18,2))) as double) as market_value
from fx_offexchange h left join n on h.prod_code = n.prod_code and h.prodta_no = n.prodta_no
group by h.fund_account, h.money_type""")
def offexchange_market_value(spark, sf_dir):
    return as_doubles(valuation.offexchange_market_value(
        shape(spark, sf_dir, "fx_offexchange"), shape(spark, sf_dir, "fx_nav"),
        keys_from=lambda: shape(spark, sf_dir, "fx_holding_keys")))


# --- cash, credit, journal, trades -----------------------------------------

@query("""select fund_account, money_type, cast(b as double) as balance from (
  select fund_account, money_type,
         sum(current_balance + correct_balance - real_buy_balance + real_sell_balance) as b
  from fx_cash group by fund_account, money_type) where b <> 0""")
def cash_balance(spark, sf_dir):
    return as_doubles(valuation.cash_balance(shape(spark, sf_dir, "fx_cash")))


@query("""select fund_account, money_type,
       cast(sum(real_compact_balance + real_compact_fare) as double) as liability
from fx_contracts where compact_type = '0' or compact_type is null
group by fund_account, money_type""")
def credit_liability(spark, sf_dir):
    return as_doubles(valuation.credit_liability(shape(spark, sf_dir, "fx_contracts")))


@query(f"""select fund_account, money_type, cast(sum(occur_balance) as double) as net_in
from fx_journal where init_date = '{BIZ_DATE}' group by fund_account, money_type""")
def fund_net_in(spark, sf_dir):
    return as_doubles(valuation.fund_net_in(shape(spark, sf_dir, "fx_journal"), BIZ_DATE))


_NET_TRADE = """select fund_account, stock_code,
       cast(sum(case when entrust_bs = '2' then -business_balance else business_balance end) as double) as net_trade
from fx_trades where real_status in ('0','4') and real_type in (%s) group by fund_account, stock_code"""


@query(_NET_TRADE % "'0'")
def trade_net(spark, sf_dir):
    return as_doubles(valuation.trade_net(shape(spark, sf_dir, "fx_trades")))


@query(_NET_TRADE % "'6','7','8','9'")
def trade_net_credit(spark, sf_dir):
    return as_doubles(valuation.trade_net_credit(shape(spark, sf_dir, "fx_trades")))


#: A date on which trades of both kinds were made, whatever the size of the tables.
TRADE_DATE = "19950610"


@query(_NET_TRADE.replace("group by", f"and init_date = '{TRADE_DATE}' group by") % "'0'")
def trade_net_of_date(spark, sf_dir):
    return as_doubles(valuation.trade_net(shape(spark, sf_dir, "fx_trades"), TRADE_DATE))


@query(_NET_TRADE.replace("group by", f"and init_date = '{TRADE_DATE}' group by") % "'6','7','8','9'")
def trade_net_credit_of_date(spark, sf_dir):
    return as_doubles(valuation.trade_net_credit(shape(spark, sf_dir, "fx_trades"), TRADE_DATE))


@query("""select fund_account || '_' || stock_code || '_' || money_type as stock_key,
       fund_account || '_' || money_type as account_key from fx_positions""")
def key_format(spark, sf_dir):
    keyed = shape(spark, sf_dir, "fx_positions").select(
        rules.joined_key("fund_account", "stock_code", "money_type").alias("stock_key"))
    return keyed.select("stock_key", F.concat_ws("_", rules.key_part("stock_key", 0),
                                                 rules.key_part("stock_key", 2)).alias("account_key"))


# --- snapshots -------------------------------------------------------------

@query("""select fund_account, money_type, cast(sum(value) as double) as value
from fx_lastday group by fund_account, money_type having sum(value) <> 0""")
def lastday_asset(spark, sf_dir):
    keys = ["fund_account", "money_type"]
    total = snapshots.snapshot_totals(shape(spark, sf_dir, "fx_lastday"), keys)
    return as_doubles(snapshots.load_snapshot(total, new_folder(spark, "lastday"), keys))


def _lastday_book(spark, sf_dir, book):
    rows = snapshots.snapshot_rows(shape(spark, sf_dir, "fx_lastday").filter(F.col("book") == book))
    kept = rows.select("fund_account", "stock_code", "money_type", "value")
    return as_doubles(snapshots.load_snapshot(
        kept, new_folder(spark, "lastday"), ["fund_account", "stock_code", "money_type"]))


_LASTDAY = """select fund_account, stock_code, money_type, cast(value as double) as value
from fx_lastday where book = '%s' and value <> 0"""


@query(_LASTDAY % "ordinary")
def lastday_stock(spark, sf_dir):
    return _lastday_book(spark, sf_dir, "ordinary")


@query(_LASTDAY % "credit")
def lastday_credit(spark, sf_dir):
    return _lastday_book(spark, sf_dir, "credit")


# --- income today ----------------------------------------------------------

_INCOME = f"""with {_VALUED},
held as (select book, fund_account, stock_code, money_type, sum(quantity * price) as real_asset
  from valued group by book, fund_account, stock_code, money_type),
lowest as (select book, fund_account, stock_code, min(money_type) as money_type
  from held group by book, fund_account, stock_code),
traded as (select case when real_type = '0' then 'ordinary' else 'credit' end as book, fund_account, stock_code,
    sum(case when entrust_bs = '2' then -business_balance else business_balance end) as net_trade
  from fx_trades where real_status in ('0','4') and real_type in ('0','6','7','8','9') group by 1, 2, 3),
income as (
  select h.book, h.fund_account, h.stock_code, h.money_type, cast(h.real_asset as decimal(38,4)) as real_asset,
         cast(coalesce(d.value, 0) as decimal(38,4)) as last_day_asset,
         cast(case when w.money_type is not null then coalesce(t.net_trade, 0) else 0 end as decimal(38,4)) as trade_value
  from held h
  left join fx_lastday d on h.book = d.book and h.fund_account = d.fund_account
    and h.stock_code = d.stock_code and h.money_type = d.money_type and d.value <> 0
  left join lowest w on h.book = w.book and h.fund_account = w.fund_account
    and h.stock_code = w.stock_code and h.money_type = w.money_type
  left join traded t on h.book = t.book and h.fund_account = t.fund_account and h.stock_code = t.stock_code),
result as (select *, cast(real_asset - trade_value - last_day_asset as decimal(38,4)) as today_income from income)
"""


def _income(spark, sf_dir):
    positions, trades, last_day = shapes_of_lines(spark, sf_dir, "fx_positions", "fx_trades", "fx_lastday")
    return income.stock_income_today(_valued(spark, sf_dir, positions=positions), valuation.trade_rows_by_book(trades),
                                     snapshots.snapshot_rows(last_day))


@query(_INCOME + """select book, fund_account, stock_code, money_type, cast(real_asset as double) as real_asset,
       cast(last_day_asset as double) as last_day_asset, cast(trade_value as double) as trade_value,
       cast(today_income as double) as today_income from result""")
def stock_income_today(spark, sf_dir):
    return as_doubles(_income(spark, sf_dir))


@query(_INCOME + """select book, fund_account, stock_code, money_type, cast(real_asset as varchar) as real_asset,
       cast(last_day_asset as varchar) as last_day_asset, cast(trade_value as varchar) as trade_value,
       cast(today_income as varchar) as today_income from result""")
def stock_income_text(spark, sf_dir):
    return income.stock_income_text(_income(spark, sf_dir))


@query(_INCOME + """select book, fund_account, stock_code, money_type,
       '{"tradeValue":"' || cast(trade_value as varchar) || '","lastDayAsset":"' || cast(last_day_asset as varchar)
       || '","todayIncome":"' || cast(today_income as varchar) || '","realAsset":"' || cast(real_asset as varchar)
       || '","stockCode":"' || stock_code || '"}' as income_json from result""")
def stock_income_json(spark, sf_dir):
    return income.stock_income_json(_income(spark, sf_dir))


@query(f"""with {_VALUED}
select book, fund_account, stock_code, money_type, cast(sum(quantity * price) as double) as market_value
from valued where fund_account = '{ACCOUNT}' group by book, fund_account, stock_code, money_type""")
def account_positions(spark, sf_dir):
    return income.account_rows(stock_market_value(spark, sf_dir), ACCOUNT)


@query(_ACCOUNT_VALUE.replace("where", f"where fund_account = '{ACCOUNT}' and money_type = '0' and")
       % "ordinary")
def kv_lookup(spark, sf_dir):
    """One key of the account totals, stored as a keyed table before."""
    totals = valuation.account_market_value(_valued(spark, sf_dir, "ordinary"))
    path = new_folder(spark, "totals")
    write_keyed(totals, path, ["fund_account", "money_type"])
    stored = read_keyed(spark, path, totals.schema)
    return as_doubles(lookup(stored, fund_account=ACCOUNT, money_type="0"))


# --- session and pairs -----------------------------------------------------

@query("""select event_id, user_id, event_type from events
where hour(ts) * 60 + minute(ts) > 550 and hour(ts) * 60 + minute(ts) < 1140
  and dayofweek(ts) between 1 and 5""")
def session_filter(spark, sf_dir):
    return (table(spark, sf_dir, "events").filter(rules.in_session("ts"))
            .select("event_id", "user_id", "event_type"))


@query("""select c_custkey as left_value, v.right_value
from customer, (values (6), (7), (8), (9), (10)) as v(right_value)""")
def cross_pairs(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("left_value"))
    return pairs.pair_with(left, [6, 7, 8, 9, 10], "right_value")


# --- change events, batch --------------------------------------------------

def _events(spark, sf_dir):
    return events.parse_events(fixtures.change_messages(spark, sf_dir))


@query("""select topic, part as "partition", off as "offset", tablename, oper_type,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as timeload, strftime(ts, '%Y%m%d%H%M%S') as load_second,
       position_str, fund_account, money_type, business_flag, init_date, curr_time,
       cast(balance as double) as business_balance, cast(balance as double) as occur_balance from fx_cdc""")
def cdc_parse(spark, sf_dir):
    parsed = _events(spark, sf_dir)
    return as_doubles(parsed.select(
        *PLACE, "tablename", "oper_type", "timeload",
        F.date_format("load_ts", "yyyyMMddHHmmss").alias("load_second"), "position_str", "fund_account",
        "money_type", "business_flag", "init_date", "curr_time", "business_balance",
        "occur_balance"))


@query(f"""select topic, part as "partition", off as "offset", tablename, oper_type, position_str,
       cast(balance as double) as business_balance from fx_cdc where {_IS_ORDER}""")
def entrust_filter(spark, sf_dir):
    kept = _events(spark, sf_dir).filter(rules.is_order_event())
    return as_doubles(kept.select(*PLACE, "tablename", "oper_type", "position_str",
                                  "business_balance"))


@query("""select topic, part as "partition", off as "offset", init_date, curr_time,
       substr(init_date || lpad(curr_time, 9, '0'), 1, 14) as entrust_time from fx_cdc""")
def entrust_time(spark, sf_dir):
    return _events(spark, sf_dir).select(*PLACE, "init_date", "curr_time",
                                         rules.entrust_time().alias("entrust_time"))


_REJECTS = f"""select topic, part as "partition", off as "offset",
       case when off % 50 = 7 then 'unreadable' else 'no key' end as reason
from fx_cdc where off % 50 = 7 or off % 50 = 8 and (({_IS_ORDER}) or ({_IS_TRANSFER}))"""


@query(_REJECTS)
def cdc_rejects(spark, sf_dir):
    parsed = events.parse_events(fixtures.broken_messages(spark, sf_dir))
    return events.rejected_events(parsed).drop("corrupt")


@query(_REJECTS)
def cdc_rejects_stream(spark, sf_dir):
    root = new_folder(spark, "rejects")
    inbox, path = f"{root}/inbox", f"{root}/table"
    replay.replay(fixtures.broken_messages(spark, sf_dir), inbox,
                  lambda: rejects.start_rejects(file_messages(spark, inbox), path, f"{root}/checkpoint", every=None))
    return rejects.read_rejects(spark, path).drop("corrupt")


def _orders(spark, sf_dir):
    return events.order_events(_events(spark, sf_dir))


@query(f"""with {_ORDERS}
select position_str, topic, "partition", "offset", timeload, entrust_time, cast(balance as double) as balance from (
  select *, row_number() over (partition by position_str order by timeload desc, ts, topic, "partition", "offset") as n from ord)
where n = 1""")
def entrust_latest(spark, sf_dir):
    return as_doubles(events.latest_orders(_orders(spark, sf_dir)).drop("message_time"))


_FIRST_SEEN = f"""with {_ORDERS}, {_FIRST}
select position_str, topic, "partition", "offset", entrust_time, cast(balance as double) as balance from first_seen"""
_PER_SECOND = f"""with {_ORDERS}, {_FIRST}
select substr(entrust_time, 1, 8) as init_date, substr(entrust_time, 9, 6) as load_time,
       count(*) as entrust_num, cast(sum(balance) as double) as balance from first_seen group by entrust_time"""


@query(_FIRST_SEEN)
def entrust_first_seen(spark, sf_dir):
    return as_doubles(events.first_seen_orders(_orders(spark, sf_dir).drop("timeload")).drop("message_time"))


@query(_FIRST_SEEN)
def entrust_first_seen_table(spark, sf_dir):
    """First orders found by three runs in the order of time, each against the keys seen before."""
    root = new_folder(spark, "seen")
    keys = seen.SeenKeys(f"seen_{root.rsplit('-', 1)[-1]}", f"{root}/keys", buckets=8)
    keys.create(spark)
    found, all_orders = f"{root}/found", _orders(spark, sf_dir).drop("timeload")
    for number, part in enumerate(replay.slices_of(all_orders, 3)):
        run = f"run-{number}"
        keys.unseen(part, run).write.parquet(f"{found}/{run}")
        fresh = spark.read.parquet(f"{found}/{run}")
        keys.add(fresh, run)
    return as_doubles(spark.read.parquet(*[f"{found}/run-{n}" for n in range(3)]).drop("message_time"))


@query(_PER_SECOND)
def entrust_per_second(spark, sf_dir):
    first = events.first_seen_orders(_orders(spark, sf_dir).drop("timeload"))
    return as_doubles(events.per_second(first))


@query(f"""select position_str, topic, part as "partition", off as "offset", strftime(ts, '%Y-%m-%d %H:%M:%S') as load_time,
       cast(balance as double) as balance, fund_account, money_type from fx_cdc where {_IS_TRANSFER}""")
def bank_transfer_filter(spark, sf_dir):
    return as_doubles(events.transfer_events(_events(spark, sf_dir)).drop("message_time"))


def _transfer_table(changes: DataFrame) -> DataFrame:
    return as_doubles(changes.select("position_str", "init_time", "load_time", "balance",
                                     "fund_account", "money_type"))


@query(f"with {_MERGED}")
def bank_transfer_merge(spark, sf_dir):
    transfers = events.transfer_events(_events(spark, sf_dir))
    return _transfer_table(events.transfer_changes(transfers))


# --- change events, streams ------------------------------------------------

def _run_orders(spark, sf_dir) -> tuple[str, str]:
    root = new_folder(spark, "orders")
    inbox, seen, totals = (f"{root}/{part}" for part in ("inbox", "seen", "totals"))
    replay.replay(fixtures.change_messages(spark, sf_dir), inbox,
                  lambda: orders.start_orders(file_messages(spark, inbox), seen, totals,
                                              f"{root}/checkpoint", every=None))
    return seen, totals


@query(_FIRST_SEEN)
def entrust_first_seen_stream(spark, sf_dir):
    seen, _ = _run_orders(spark, sf_dir)
    return as_doubles(orders.read_seen(spark, seen).drop("message_time"))


@query(_PER_SECOND)
def entrust_per_second_stream(spark, sf_dir):
    _, totals = _run_orders(spark, sf_dir)
    return as_doubles(orders.read_totals(spark, totals))


#: Seconds after which an order of the fixture is late, and that its slices may be apart.
_LATE, _SKEW = 480, 60
_TIMED = f"""{_ORDERS}, timed as (
  select *, strptime(entrust_time, '%Y%m%d%H%M%S') as order_ts from ord), in_time as (
  select * from timed where epoch_us(ts) - epoch_us(order_ts) between 0 and {_LATE} * 1000000)"""


@query(f"""with {_TIMED}, once as (
  select order_ts, position_str, first(balance order by ts, topic, "partition", "offset") as balance
  from in_time group by order_ts, position_str)
select strftime(order_ts, '%Y%m%d') as init_date, strftime(order_ts, '%H%M%S') as load_time,
       count(*) as entrust_num, cast(sum(balance) as double) as balance
from once where order_ts + interval 1 second <= (select max(order_ts) from in_time) - interval {_LATE + _SKEW} second
group by order_ts""")
def entrust_per_second_windowed(spark, sf_dir):
    root = new_folder(spark, "seconds")
    inbox, path = f"{root}/inbox", f"{root}/table"
    replay.replay(fixtures.change_messages(spark, sf_dir), inbox,
                  lambda: orders.start_second_totals(file_messages(spark, inbox), path, f"{root}/checkpoint",
                                                     _LATE, skew=_SKEW, every=None))
    return as_doubles(orders.read_totals(spark, path))


@query(f"""with {_TIMED}
select topic, "partition", "offset", 'late' as reason from timed where epoch_us(ts) - epoch_us(order_ts) > {_LATE} * 1000000""")
def entrust_late_stream(spark, sf_dir):
    """The orders that the totals by event time leave out."""
    root = new_folder(spark, "late")
    inbox, path = f"{root}/inbox", f"{root}/table"
    replay.replay(fixtures.change_messages(spark, sf_dir), inbox,
                  lambda: rejects.start_rejects(file_messages(spark, inbox), path, f"{root}/checkpoint", every=None,
                                                late_after=_LATE))
    return rejects.read_rejects(spark, path).drop("corrupt")


def _run_transfers(spark, sf_dir):
    root = new_folder(spark, "transfers")
    inbox, path, book = (f"{root}/{part}" for part in ("inbox", "table", "ledger"))
    replay.replay(fixtures.change_messages(spark, sf_dir), inbox,
                  lambda: transfers.start_transfers(file_messages(spark, inbox), path, f"{root}/checkpoint",
                                                    every=None, ledger=book))
    return path, book


@query(f"with {_MERGED}")
def bank_transfer_stream(spark, sf_dir):
    path, _ = _run_transfers(spark, sf_dir)
    return _transfer_table(transfers.read_transfers(spark, path))


@query("""select 'transfers' as group_id, topic, part as "partition", max(off) + 1 as until_offset
from fx_cdc group by topic, part""")
def offset_progress(spark, sf_dir):
    """The ledger of a transfer stream that has read all messages."""
    _, ledger_path = _run_transfers(spark, sf_dir)
    return ledger.offset_progress(spark, ledger_path)


# --- quotes ----------------------------------------------------------------

@query("""select stock_code, money_type, exchange_type, case exchange_type when 'G' then 'HK:' when 'S' then 'HK:'
         when '2' then 'SZ:' when '9' then 'SZ:' else 'SH:' end || stock_code as symbol
from fx_instruments where stock_code <> '' and exchange_type in ('G','S','2','9','1')""")
def quote_symbol(spark, sf_dir):
    listed = valuation.instrument_list(shape(spark, sf_dir, "fx_instruments"))
    return quotes.quote_symbol(listed.drop("market_price"))


@query("""select exchange_type, stock_code, cast(asset_price as double) as market_price from fx_prices
union all
select exchange_type, stock_code || 'R' as stock_code, cast(asset_price + 1 as double) as market_price from fx_prices""")
def quote_explode(spark, sf_dir):
    return as_doubles(quotes.quote_explode(fixtures.quote_answers(spark, sf_dir)))


@query("""select coalesce(p.stock_code, q.stock_code) as stock_code,
       coalesce(p.exchange_type, q.exchange_type) as exchange_type, cast(p.asset_price as double) as asset_price,
       cast(coalesce(q.market_price, p.market_price) as double) as market_price
from fx_prices p full outer join fx_quotes q
  on p.stock_code = q.stock_code and p.exchange_type = q.exchange_type""")
def quote_upsert(spark, sf_dir):
    return as_doubles(quotes.quote_upsert(shape(spark, sf_dir, "fx_prices"),
                                          shape(spark, sf_dir, "fx_quotes")))


# --- index documents -------------------------------------------------------

def _routed(spark, sf_dir):
    return documents.doc_route(events.parse_events(fixtures.document_messages(spark, sf_dir)))


def _doc_table(rows: DataFrame) -> DataFrame:
    return as_doubles(rows.drop("message_time"))


def _documents(spark, sf_dir):
    return documents.doc_upsert(_routed(spark, sf_dir))


@query(f"with {_DOCS} select {_DOC_COLUMNS} from routed where index is not null")
def doc_route(spark, sf_dir):
    return _doc_table(_routed(spark, sf_dir))


@query(f"with {_DOCS} select {_DOC_COLUMNS} from docs")
def doc_upsert(spark, sf_dir):
    return _doc_table(_documents(spark, sf_dir))


@query(f"with {_DOCS} select {_DOC_COLUMNS} from docs where fund_account = '{ACCOUNT}'")
def doc_match(spark, sf_dir):
    return _doc_table(documents.doc_match(_documents(spark, sf_dir), "fund_account", ACCOUNT))


@query(f"with {_DOCS} select {_DOC_COLUMNS} from docs where index = '{documents.JOURNAL_INDEX}'")
def doc_match_all(spark, sf_dir):
    return _doc_table(documents.doc_match_all(_documents(spark, sf_dir), documents.JOURNAL_INDEX))


@query("""with asset as (select fund_account, sum(value) as real_total_asset from fx_lastday
  group by fund_account having sum(value) <> 0)
select cast(c.c_custkey as varchar) as fund_account,
       cast(coalesce(a.real_total_asset, 0) as double) as real_total_asset
from customer c left join asset a on cast(c.c_custkey as varchar) = a.fund_account""")
def doc_by_id(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string")
                                                  .alias("fund_account"))
    assets = snapshots.snapshot_totals(shape(spark, sf_dir, "fx_lastday"), ["fund_account"])
    return as_doubles(documents.doc_by_id(
        ids, assets.withColumnRenamed("value", "real_total_asset"), "fund_account",
        "real_total_asset"))


@query(f"""with {_DOCS} select cast(coalesce(sum(occur_balance), 0) as double) as occur_balance
from docs where fund_account = '{ACCOUNT}' and money_type = '0'""")
def doc_match_sum(spark, sf_dir):
    return as_doubles(documents.doc_match_sum(_documents(spark, sf_dir), "fund_account", ACCOUNT))


@query(f"""with {_DOCS} select fund_account, cast(sum(occur_balance) as double) as occur_balance
from docs group by fund_account""")
def doc_terms_sum(spark, sf_dir):
    return as_doubles(documents.doc_terms_sum(_documents(spark, sf_dir), "fund_account"))


@query(f"with {_DOCS} select {_DOC_COLUMNS} from docs where coalesce(fund_account <> '{ACCOUNT}', true)")
def doc_delete(spark, sf_dir):
    """The account's documents deleted from a stored table, by a record beside it."""
    stored = documents_table(new_folder(spark, "documents"))
    stored.write(_documents(spark, sf_dir).withColumn("biz_dt", F.current_timestamp()), 0)
    deletes.delete_where(spark, stored, "fund_account", [ACCOUNT])
    return _doc_table(deletes.read_standing(spark, stored).drop("biz_dt"))


# --- sinks and runs --------------------------------------------------------

@query(_ACCOUNT_VALUE % "ordinary")
def sink_outside(spark, sf_dir):
    """Account totals handed to an outside store by a run that is repeated, and read back."""
    totals = valuation.account_market_value(_valued(spark, sf_dir, "ordinary"))
    store = outside.FolderStore(new_folder(spark, "outside"))
    for _ in range(2):
        outside.write_outside(totals, store, RUN_DATE)
    return as_doubles(store.read(spark))


@query(_STOCK_VALUE)
def sink_keyed(spark, sf_dir):
    result = valuation.stock_market_value(_valued(spark, sf_dir), "book")
    path = new_folder(spark, "keyed")
    write_keyed(result, path, ["fund_account", "stock_code", "money_type", "book"])
    return as_doubles(read_keyed(spark, path, result.schema))


@query(_ACCOUNT_VALUE.replace("select fund_account,", f"select '{RUN_DATE}' as biz_date, fund_account,")
       % "credit")
def daily_reset(spark, sf_dir):
    """Two results written under one date, the first replaced by the second."""
    path = new_folder(spark, "daily")
    keys = ["fund_account", "money_type"]
    for book in ("ordinary", "credit"):
        result = valuation.account_market_value(_valued(spark, sf_dir, book))
        write_for_date(result, path, keys, RUN_DATE)
    back = read_for_date(spark, path, RUN_DATE)
    return as_doubles(back.select(F.lit(RUN_DATE).alias("biz_date"), *keys, "market_value"))


def _run_inputs(spark, sf_dir):
    positions, trades = shape(spark, sf_dir, "fx_positions"), shape(spark, sf_dir, "fx_trades")
    return {"positions": positions.filter("book = 'ordinary'"),
            "credit_positions": positions.filter("book = 'credit'"),
            "prices": shape(spark, sf_dir, "fx_prices"), "navs": shape(spark, sf_dir, "fx_nav"),
            "holdings": shape(spark, sf_dir, "fx_offexchange"),
            "cash": shape(spark, sf_dir, "fx_cash"),
            "contracts": shape(spark, sf_dir, "fx_contracts_text"),
            "journal": shape(spark, sf_dir, "fx_journal"), "trades": trades,
            "credit_trades": trades}


def _counted(name: str, sql: str, bad: str = "0") -> str:
    return f"select '{RUN_DATE}' as biz_date, '{name}' as step_name, (select count(*) from ({sql})) as rows_written, cast({bad} as bigint) as bad_amounts"


_VALUE_OF_BOOK = "select * from ({}) where book = '{}'"
_RUN_LOG = "\nunion all ".join([
    _counted("stock_value", _VALUE_OF_BOOK.format(ORACLES["stock_market_value"], "ordinary")),
    _counted("account_value", ORACLES["account_market_value"]),
    _counted("credit_stock_value", _VALUE_OF_BOOK.format(ORACLES["stock_market_value"], "credit")),
    _counted("credit_account_value", ORACLES["account_market_value_credit"]),
    _counted("offexchange_value", ORACLES["offexchange_market_value"]),
    _counted("cash", ORACLES["cash_balance"]),
    _counted("credit_debt", ORACLES["credit_liability"], "(select count(*) from (" + _oracle(
        "select * from fx_contracts_text where (compact_type = '0' or compact_type is null) and real_compact_fare in ('none', '13.00005')") + "))"),
    _counted("net_in", "select distinct o_custkey, o_orderkey % 2 from orders"),
    _counted("net_trade", ORACLES["trade_net"]),
    _counted("credit_net_trade", ORACLES["trade_net_credit"])])


@query(_RUN_LOG)
def run_log(spark, sf_dir):
    """A whole valuation pass; returns its step log."""
    out = new_folder(spark, "run")
    run_valuation(spark, _run_inputs(spark, sf_dir), out, RUN_DATE, of_date=False)
    return spark.read.parquet(f"{out}/run_log").drop("start_time", "end_time")
