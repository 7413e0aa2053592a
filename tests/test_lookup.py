"""The left lookup: same rows whether broadcast or salted, and no hot task."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tallyhouse.operators import valuation
from tallyhouse.operators.lookup import heavy_keys, left_lookup, planned_bytes
from tallyhouse.plans.fixtures import shape


@pytest.fixture
def skewed(spark, tmp_path):
    """3,000 rows: a third under key h, a few hundred null, exact copies among them."""
    kind = F.col("id") % 6
    df = spark.range(0, 3000, 1, 6).select(
        F.when(kind < 2, "h").when(kind == 2, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.lit("x").alias("e"), (F.col("id") % 7).alias("v"))
    df.write.parquet(str(tmp_path / "rows"))
    keys = spark.createDataFrame([("h", "x", 1), ("k3", "x", 2), ("k4", "y", 3), (None, "x", 9)], "k string, e string, p int")
    keys.write.parquet(str(tmp_path / "lookup"))
    return spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "lookup"))


def test_salted_equals_broadcast(skewed):
    df, lookup = skewed
    small = left_lookup(df, lookup, ["k", "e"])
    large = left_lookup(df, lookup, ["k", "e"], broadcast_limit=0, sample=1.0)
    assert "_salt#" in plan(large) and "_salt#" not in plan(small)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    assert small.count() == 3000
    assert small.filter("p is not null").count() == df.filter("k in ('h', 'k3') and e = 'x'").count()


@pytest.mark.parametrize("sample", [0.01, 0.2])
def test_rows_do_not_depend_on_the_sample(skewed, sample):
    df, lookup = skewed
    want = rows(left_lookup(df, lookup, ["k", "e"]))
    assert rows(left_lookup(df, lookup, ["k", "e"], broadcast_limit=0, sample=sample)) == want


def test_heavy_key_is_found_and_split(spark, skewed):
    df, lookup = skewed
    # Without adaptive coalescing each reduce task is one shuffle partition.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salts = {r["k"]: r["_salts"] for r in heavy_keys(df, ["k", "e"], sample=1.0).collect()}
        joined = left_lookup(df, lookup, ["k", "e"], broadcast_limit=0, sample=1.0)
        sizes = [n for _, n in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert salts["h"] == 22 and "k3" not in salts, "a third of all rows is 22 pieces of a quarter partition"
    assert sum(sizes) == 3000
    assert max(sizes) < 500, "the key of 1,000 rows should be spread over the tasks"


def test_planned_size_bounds_the_broadcast(spark, sf_dir):
    lookup = valuation.price_effective(shape(spark, sf_dir, "fx_prices"))
    assert 0 < planned_bytes(lookup) < 1 << 20
    df = shape(spark, sf_dir, "fx_positions")
    wide = left_lookup(valuation.position_quantity(df), lookup, valuation.PRICE_KEYS, broadcast_limit=10, sample=1.0)
    assert "_salt#" in plan(wide)


def test_valuation_with_large_lookup(spark, sf_dir):
    positions, prices = shape(spark, sf_dir, "fx_positions"), shape(spark, sf_dir, "fx_prices")
    total = lambda **o: rows(valuation.account_market_value(
        valuation.position_market_value(positions, prices, **o)))
    assert total() == total(broadcast_limit=0, sample=1.0)


def test_key_shapes_hold_the_keys_of_their_shape(spark, sf_dir):
    for keys, whole, names in (("fx_position_keys", "fx_positions", valuation.PRICE_KEYS),
                               ("fx_holding_keys", "fx_offexchange", valuation.NAV_KEYS)):
        got = shape(spark, sf_dir, keys)
        assert rows(got) == rows(shape(spark, sf_dir, whole).select(*names))
        positions = shape(spark, sf_dir, whole)
        lookup = got.distinct().withColumn("p", F.lit(1))
        joined = left_lookup(positions, lookup, names, broadcast_limit=0, sample=1.0, keys_from=lambda: got)
        assert joined.filter("p = 1").count() == positions.count()
