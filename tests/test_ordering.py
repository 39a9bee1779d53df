"""Positions, buckets and sort checks."""

import pytest
from pyspark.sql import functions as F

from readloom.operators import ordering as O


@pytest.mark.parametrize("rows, n", [(0, 3), (2, 5), (12, 4), (13, 4), (1000, 7)])
def test_buckets_are_contiguous_and_balanced(spark, rows, n):
    df = spark.range(rows).select((F.col("id") * 7919 % 10007).alias("v"))
    got = O.balance_load(df, n, ["v"]).orderBy("v").collect()
    buckets = [r.bucket for r in got]
    assert buckets == sorted(buckets) and len(buckets) == rows
    want = [i for i in range(n) for _ in range(rows // n + (i < rows % n))]
    assert buckets == want


def test_ordinal_of_equal_rows_is_spread_and_complete(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = spark.range(4000).select(F.lit(1).alias("v"))
        numbered = O.ordinal(same, ["v"])
        assert sorted(r.ord for r in numbered.collect()) == list(range(4000))
        sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("run", [1, 2, 3, 100])
def test_sort_violations(spark, run):
    rows = [(0, 1, 5, "b"), (1, 1, 4, "a"), (2, -1, 0, "c"), (3, 0, 9, "d"), (4, 0, 9, "d"), (5, -1, 7, "a"), (6, -1, 3, "z")]
    df = spark.createDataFrame(rows, "ord long, ref_idx int, pos int, qname string")
    by_place = {(r.ord, r.prev_key, r.key) for r in O.sort_violations(df, "coordinate", run=run).collect()}
    assert by_place == {(1, "1:5", "1:4"), (3, "*", "0:9")}
    assert {r.ord for r in O.sort_violations(df, "queryname", run=run).collect()} == {1, 5}


def test_sorted_output_has_no_violations(spark):
    from readloom.operators.reads import coordinate_order
    from readloom.plans.fixtures import fixture
    rows = O.ordinal(fixture(spark, "/root/testdata/sf0.001", "f_reads"), coordinate_order())
    assert O.sort_violations(rows, "coordinate").isEmpty()


def test_apply_regions_bounds_every_group(spark):
    import pandas as pd

    from readloom.operators.regions import apply_regions

    def size(region):
        assert region.v.is_monotonic_increasing
        return pd.DataFrame({"bucket": [int(region.bucket.iloc[0])], "n": [len(region)]})

    df = spark.range(1001).select((F.col("id") % 3).alias("v"))
    got = {r.bucket: r.n for r in apply_regions(df, ["v"], size, "bucket int, n long", max_rows=100).collect()}
    assert len(got) == 11 and max(got.values()) == 91 and sum(got.values()) == 1001


def test_buckets_of_equal_cost(spark):
    rows = [(i, 1000 if i % 50 == 0 else i % 7) for i in range(2000)] + [(5, 3)] * 700
    df = spark.createDataFrame(rows, "v int, c int")
    got = O.balance_cost(df, 6, ["v", "c"], F.col("c")).orderBy("v", "c", "bucket").collect()
    buckets = [r.bucket for r in got]
    assert buckets == sorted(buckets) and set(buckets) == set(range(6)) and len(got) == 2700
    sums = [sum(r.c for r in got if r.bucket == b) for b in range(6)]
    share = sum(c for _, c in rows) / 6
    assert all(abs(x - share) <= 1000 for x in sums)
    assert {r.bucket for r in O.balance_cost(df, 6, ["v"], F.lit(0)).collect()} == {0}
    assert O.balance_cost(df.limit(0), 3, ["v"], F.col("c")).count() == 0


def test_regions_by_cost_bound_the_bytes_of_a_group(spark):
    """Reads of 100 kB among short ones, most of them with one key: no group above the limit but single longer rows."""
    import pandas as pd

    from readloom.operators.regions import apply_regions_by_cost

    rows = [(1 if i % 3 else i, "A" * (100_000 if i % 40 == 7 else 700_000 if i == 100 else 36), None if i % 5 else "q") for i in range(800)]
    df = spark.createDataFrame(rows, "k int, seq string, qual string").repartition(5)
    limit = 500_000

    def size(region: pd.DataFrame) -> pd.DataFrame:
        assert list(region._row) == list(range(region._row.iloc[0], region._row.iloc[0] + len(region)))
        return pd.DataFrame({"bucket": [region.bucket.iloc[0]], "n": [len(region)], "first": [region._row.iloc[0]],
                             "bytes": [region.seq.str.len().sum()], "ordered": [region.k.is_monotonic_increasing]})

    out = apply_regions_by_cost(df, ["k"], size, "bucket long, n long, first long, bytes long, ordered boolean", limit)
    got = sorted(tuple(r) for r in out.collect())
    assert sum(r[1] for r in got) == 800 and all(r[4] for r in got)
    assert [r[0] for r in got] == list(range(len(got))) and [r[2] for r in got] == sorted(r[2] for r in got)
    assert all(r[3] <= limit or r[1] == 1 for r in got) and max(r[3] for r in got) == 700_000 and len(got) < 30
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_part") >= 1


def test_bytes_of_a_row(spark):
    df = spark.createDataFrame([("é", b"abc", 1, [1, 2], {"k": "v"}, None)], "a string, b binary, c int, d array<int>, e map<string,string>, f string")
    assert df.select(O.row_bytes(df).alias("n")).first().n == 2 + 3 + 8 + len('{"d":[1,2]}') + len('{"e":{"k":"v"}}')


def test_position_of_stored_rows(spark, tmp_path):
    path = str(tmp_path / "sorted")
    spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartitionByRange(13, "v").sortWithinPartitions("v").write.parquet(path)
    rows = O.stored_position(spark.read.parquet(path)).collect()
    assert sorted((r.ord, r.v) for r in rows) == [(i, i) for i in range(5000)]
