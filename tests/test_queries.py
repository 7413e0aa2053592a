"""Every registered query against its SQL, and the shape of the registry."""

import pytest
from check_queries import compare, connect
from helpers import SF_DIR

import __spark_entry__ as entry
from tallyhouse.plans import registry


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, got, want, _ = compare(spark, con, SF_DIR, name)
    assert ok, f"{name}: {got} rows, SQL has {want}"
    assert got > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["fund_account", "money_type", "market_value"]
    assert result.count() > 0


def test_only_run_reports_have_no_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"offset_progress", "run_log"}
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLES) <= set(entry.oracle_sql())
