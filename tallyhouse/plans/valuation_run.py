"""One pass of the intraday valuation: eight result tables and a log of the steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from tallyhouse import schemas
from tallyhouse.functions import rules
from tallyhouse.operators import valuation
from tallyhouse.sinks.keyed import Watch, read_for_date, write_for_date
from tallyhouse.sources.tables import observed

ACCOUNT = ("fund_account", "money_type")
ACCOUNT_STOCK = ("fund_account", "stock_code")
ACCOUNT_STOCK_CURRENCY = ("fund_account", "stock_code", "money_type")

_PARTS = ("current_amount", "correct_amount", "real_buy_amount", "real_sell_amount")

#: Amount columns of each input.
AMOUNTS: dict[str, tuple[str, ...]] = {
    "positions": _PARTS, "credit_positions": _PARTS, "holdings": _PARTS,
    "prices": ("asset_price", "market_price"), "navs": ("nav",),
    "cash": ("current_balance", "correct_balance", "real_buy_balance", "real_sell_balance"),
    "contracts": ("real_compact_balance", "real_compact_fare"), "journal": ("occur_balance",),
    "trades": ("business_balance",), "credit_trades": ("business_balance",)}

#: The rows of an input that its step uses, where these are not all.
USED: dict[str, Callable[[DataFrame, str | None], DataFrame]] = {
    "contracts": lambda df, date: valuation.open_contracts(df), "journal": valuation.on_date,
    "trades": lambda df, date: valuation.valid_trades(df, rules.TRADE_TYPES, date),
    "credit_trades": lambda df, date: valuation.valid_trades(df, rules.CREDIT_TRADE_TYPES, date)}


class Watched(Mapping):
    """The inputs of one step, reduced to the rows that it uses, with their unreadable amounts counted."""

    def __init__(self, step: str, inputs: Mapping[str, DataFrame], biz_date: str | None) -> None:
        self._step, self._inputs, self._date = step, inputs, biz_date
        self._seen: list[tuple[Observation, list[str]]] = []

    def __getitem__(self, name: str) -> DataFrame:
        df = self._inputs[name]
        # The step's own filter, here as well: below the observation it reaches the reader.
        df = USED[name](df, self._date) if name in USED else df
        amounts = [c for c in AMOUNTS[name] if c in df.columns]
        watched, seen = observed(df, f"{self._step}_{name}", amounts)
        self._seen.append((seen, amounts))
        return watched

    def __iter__(self):
        return iter(self._inputs)

    def __len__(self) -> int:
        return len(self._inputs)

    def bad_amounts(self) -> int:
        """Amounts that counted as 0 or were rounded; known once the step is written."""
        return sum(seen.get[f"bad_{c}"] for seen, amounts in self._seen for c in amounts)


class RunLog:
    """Date, start, end, row count and bad amounts of each step, appended to a table at the end."""

    def __init__(self, biz_date: str) -> None:
        self._date = biz_date
        self._steps: list[tuple[str, str, str, str, int, int]] = []

    def write(self, name: str, df: DataFrame, save: Callable[[DataFrame, Watch], None],
              bad_amounts: Callable[[], int] = lambda: 0) -> None:
        """Run ``save`` on ``df``; the rows are counted while they are written."""
        counts: list[Observation] = []

        def watch(rows: DataFrame) -> DataFrame:
            counted, seen = observed(rows, f"step_{name}")
            counts.append(seen)
            return counted
        begin = self._now()
        save(df, watch)
        self._steps.append((self._date, name, begin, self._now(), counts[-1].get["rows"], bad_amounts()))

    @staticmethod
    def _now() -> str:
        return datetime.now().strftime("%Y/%m/%d-%H:%M:%S:%f")[:-3]

    def append_to(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self._steps, schemas.RUN_LOG).write.mode("append").parquet(path)


def _stock_step(positions: str):
    def step(inputs: Mapping[str, DataFrame], _: str | None) -> DataFrame:
        valued = valuation.position_market_value(inputs[positions], inputs["prices"])
        return valuation.stock_market_value(valued)
    return step


#: Result table: its key and the step that makes it.
STEPS: dict[str, tuple[tuple[str, ...], Callable]] = {
    "stock_value": (ACCOUNT_STOCK_CURRENCY, _stock_step("positions")),
    "credit_stock_value": (ACCOUNT_STOCK_CURRENCY, _stock_step("credit_positions")),
    "offexchange_value": (ACCOUNT, lambda i, d: valuation.offexchange_market_value(
        i["holdings"], i["navs"])),
    "cash": (ACCOUNT, lambda i, d: valuation.cash_balance(i["cash"])),
    "credit_debt": (ACCOUNT, lambda i, d: valuation.credit_liability(i["contracts"])),
    "net_in": (ACCOUNT, lambda i, d: valuation.fund_net_in(i["journal"], d)),
    "net_trade": (ACCOUNT_STOCK, lambda i, d: valuation.trade_net(i["trades"], d)),
    "credit_net_trade": (ACCOUNT_STOCK, lambda i, d: valuation.trade_net_credit(
        i["credit_trades"], d)),
}

#: Account totals, added up from the stock table just written: positions are
#: priced once for both.
ROLLUPS = {"stock_value": "account_value", "credit_stock_value": "credit_account_value"}


def run_valuation(spark: SparkSession, inputs: Mapping[str, DataFrame], out: str, biz_date: str,
                  steps: Iterable[str] = tuple(STEPS), of_date: bool = True) -> None:
    """Write the chosen result tables for ``biz_date`` below ``out``, and the log.

    A date run again is replaced, other dates stay, and stale accounts go with the
    old rows. ``of_date=False`` takes journal and trades of all dates. A step that
    fails does not keep the others from running; the errors are raised at the end,
    when all finished steps are written and logged.
    """
    log = RunLog(biz_date)
    date = biz_date if of_date else None
    errors: list[Exception] = []
    for name in steps:
        try:
            _run_step(spark, log, name, inputs, out, biz_date, date)
        except Exception as error:
            error.add_note(f"valuation step {name}")
            errors.append(error)
    log.append_to(spark, f"{out}/run_log")
    if errors:
        raise ExceptionGroup("valuation steps failed", errors)


def _run_step(spark: SparkSession, log: RunLog, name: str, inputs: Mapping[str, DataFrame],
              out: str, biz_date: str, date: str | None) -> None:
    keys, build = STEPS[name]
    watched = Watched(name, inputs, date)
    log.write(name, build(watched, date),
              lambda df, watch: write_for_date(df, f"{out}/{name}", keys, biz_date, watch), watched.bad_amounts)
    if name in ROLLUPS:
        total = ROLLUPS[name]
        stocks = read_for_date(spark, f"{out}/{name}", biz_date)
        log.write(total, valuation.account_market_value(stocks),
                  lambda df, watch: write_for_date(df, f"{out}/{total}", ACCOUNT, biz_date, watch))
