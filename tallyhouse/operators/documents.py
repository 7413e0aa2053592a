"""Index documents as a keyed table: route events, upsert, match, total, delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions import rules
from tallyhouse.operators.keepone import keep_last

# Index names and the tables that feed them.
JOURNAL_INDEX = "hs_asset_fundjour"
JOURNAL_SOURCES = ("BANKTRANSFER", "FUNDJOUR")
CONTRACT_INDEX = "hs_crdt_compact"
CONTRACT_SOURCE = "COMPACT"
HOLDING_INDEXES = {"STOCKREAL": "hs_secu_stockreal", "CRDTSTOCKREAL": "hs_crdt_crdtstockreal",
                   "SECUMREAL": "hs_prod_secumreal"}


def doc_route(events: DataFrame) -> DataFrame:
    """Events as documents of the index they belong to; others are left out, and so are
    those without an id, which would pass for one document.

    Journal events carry their amount; holdings and contracts only mark that the
    key changed, with amount 0.
    """
    table = F.col("tablename")
    journal = (table.isin(*JOURNAL_SOURCES) & F.col("money_type").isin(*rules.JOURNAL_CURRENCIES)
               & F.col("business_flag").isin(*rules.JOURNAL_FLAGS))
    index = F.when(journal, JOURNAL_INDEX).when(table == CONTRACT_SOURCE, CONTRACT_INDEX)
    for source, name in HOLDING_INDEXES.items():
        index = index.when(table == source, name)
    is_contract = F.col("index") == CONTRACT_INDEX
    zero = F.lit(0).cast(rules.AMOUNT_TYPE)
    wanted = F.col("corrupt").isNull() & F.upper("oper_type").isin(*rules.JOURNAL_OPERATIONS)
    return (events.filter(wanted)
            .withColumn("index", index).filter("index is not null")
            .filter(F.when(is_contract, F.col("compact_id")).otherwise(F.col("position_str")).isNotNull())
            .select("index",
                    F.when(is_contract, F.col("compact_id")).otherwise(F.col("position_str"))
                    .alias("doc_id"),
                    *schemas.ORDER, "fund_account", "money_type",
                    F.when(F.col("index") == JOURNAL_INDEX, F.col("occur_balance"))
                    .otherwise(zero).alias("occur_balance"),
                    F.col("timeload").alias("time_load")))


def doc_upsert(documents: DataFrame) -> DataFrame:
    """The last document written under each (index, id), in the order of the messages."""
    return keep_last(documents, ["index", "doc_id"], *schemas.ORDER)


def doc_match(documents: DataFrame, column: str, value: str, size: int | None = None) -> DataFrame:
    """Documents whose ``column`` is ``value``; with ``size`` the lowest ids only."""
    hits = documents.filter(F.col(column) == value)
    return hits if size is None else hits.orderBy("doc_id", "index").limit(size)


def doc_match_all(documents: DataFrame, index: str) -> DataFrame:
    """Every document of one index."""
    return documents.filter(F.col("index") == index)


def doc_by_id(ids: DataFrame, documents: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` of the document of each id, 0 where there is none."""
    zero = F.lit(0).cast(documents.schema[value].dataType)
    return (ids.join(documents.select(key, value), key, "left")
            .withColumn(value, F.coalesce(value, zero)))


def doc_match_sum(documents: DataFrame, column: str, value: str) -> DataFrame:
    """Sum of the matching documents in currency 0, over all of them (no hit limit)."""
    matching = documents.filter((F.col(column) == value) & (F.col("money_type") == "0"))
    zero = F.lit(0).cast(rules.AMOUNT_TYPE)
    return matching.agg(F.coalesce(F.sum("occur_balance"), zero).alias("occur_balance"))


def doc_terms_sum(documents: DataFrame, column: str) -> DataFrame:
    """Sum per value of ``column``, for every value."""
    return documents.groupBy(column).agg(F.sum("occur_balance").alias("occur_balance"))


def doc_delete(documents: DataFrame, condition: Column, size: int | None = None) -> DataFrame:
    """The documents left after deleting those that meet ``condition``.

    With ``size`` at most so many go, the lowest ids first.
    """
    doomed = F.coalesce(condition, F.lit(False))
    if size is None:
        return documents.filter(~doomed)
    keys = ["index", "doc_id"]
    first = documents.filter(doomed).select(*keys).orderBy("doc_id", "index").limit(size)
    return documents.join(first, keys, "left_anti")
