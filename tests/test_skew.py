"""Sliced joins give the rows of plain joins, and no slice holds a whole hot key."""

import pytest
from pyspark.sql import functions as F

from readloom.operators import skew as K


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("l"))
    right = spark.range(60).select((F.col("id") % 40).alias("k"), F.col("id").alias("r"))
    return left, right


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_join(sides, how):
    left, right = sides
    assert rows(K.sliced_join(left, right, ["k"], how, hot_rows=100)) == rows(left.join(right, "k", how))


def test_sliced_pairs_equals_join(sides):
    left, _ = sides
    other = left.withColumnRenamed("l", "r").filter("r % 5 = 0")
    assert rows(K.sliced_pairs(left, other, ["k"], hot_rows=50)) == rows(left.join(other, "k"))


def test_hot_key_is_spread(sides):
    left, _ = sides
    hot = K.hot_keys(left, ["k"], 100)
    sizes = K.slice_rows(left, hot, ["k"]).groupBy("k", "_slot").count().filter("k = 7").collect()
    assert len(sizes) == 11 and max(r["count"] for r in sizes) < 200


def test_lookup_join_beyond_the_broadcast_bound(sides, monkeypatch):
    left, _ = sides
    unique = left.select("k").distinct().filter("k < 30").withColumn("v", F.col("k") * 2)
    monkeypatch.setattr(K, "SMALL_ROWS", 5)
    assert K.small_or_none(unique, 5) is None
    assert rows(K.sliced_join(left, unique, ["k"], "left", 100)) == rows(K.lookup_join(left, unique, ["k"]))


def test_adaptive_plan_splits_skewed_partitions(spark, sides):
    """The read-name join of mate_join leaves skew to the adaptive plan: show that it acts."""
    left = spark.range(200000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.uuid().alias("l"))
    right = spark.range(200000).select(F.col("id").alias("k"), F.uuid().alias("r"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = left.join(right, "k", "left").agg(F.sum(F.length("l")), F.sum(F.length("r")), F.count(F.lit(1)).alias("n"))
        assert out.collect()[0].n == 200000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_rows_with_maps_are_sliced(spark):
    """Maps cannot be hashed; the other columns spread the rows."""
    left = spark.range(400).select(F.lit(1).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("tags"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    for how in ("inner", "left"):
        got = K.sliced_join(left, right, ["k"], how, hot_rows=50).collect()
        assert len(got) == 400 and {r.v for r in got} == {"x"} and all(r.tags["a"] == r.id for r in got)
