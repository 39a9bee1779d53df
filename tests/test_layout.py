"""Region queries on the stored layout against the plain ones, and what they open."""

import random
import re

import pytest
from pyspark.sql import functions as F

from readloom.functions import bins as BN
from readloom.operators import reads as R
from readloom.sources.layout import StoredReads, store_regions

READ = "qname string, flag int, ref_idx int, pos int, cigar string, seq string"


def some_reads(spark):
    """Short and very long alignments, positions on borders of bins, unmapped reads with a position, piles and unplaced reads."""
    rng, rows = random.Random(7), []
    for i in range(3000):
        pos = rng.choice([rng.randint(1, 3 << 20), rng.randint(1, 64) * 16384 + rng.randint(-2, 2), 500_000])
        cigar = rng.choice(["36M", "36M", "10M2000000N26M", "30M5D6M", "*", f"10M{rng.randint(1, 40000)}N5M"])
        rows.append((f"r{i}", rng.choice([0, 0, 16, 4]), rng.choice([1, 1, 2]), pos, cigar, "A"))
    rows += [(f"z{i}", 4, -1, 0, "*", "A") for i in range(500)] + [("n1", 0, 1, 0, "36M", "A"), ("n2", 4, 1, 0, "*", "A")]
    return spark.createDataFrame(rows, READ)


@pytest.fixture(scope="module", params=[14, 17, 20])
def layout(spark, tmp_path_factory, request):
    path = str(tmp_path_factory.mktemp("regions"))
    reads = some_reads(spark)
    store_regions(reads, path, request.param)
    return reads, StoredReads(spark, path, request.param)


def names(df):
    return sorted(r.qname for r in df.collect())


REGIONS = [(1, 500_000, 500_010), (1, 16384, 16384), (1, 16385, 16385), (1, 1, 100), (2, 1_000_000, 1_200_000), (1, 2_900_000, 0),
           (1, 0, 0), (2, 90_000_000, 90_000_100), (7, 1, 1000), (1, 131_072, 131_073)]


def test_stored_queries_equal_the_plain_ones(layout):
    reads, stored = layout
    for ref, start, end in REGIONS:
        assert names(stored.overlapping(ref, start, end)) == names(R.query_overlapping(reads, ref, start, end)), (ref, start, end)
        assert names(stored.contained(ref, start, end)) == names(R.query_contained(reads, ref, start, end)), (ref, start, end)
        assert names(stored.starting_at(ref, start)) == names(R.query_starting_at(reads, ref, start)), (ref, start)
    assert names(stored.unmapped()) == names(R.query_unmapped(reads))
    assert sorted(stored.overlapping(1, 1, 9).columns) == sorted(reads.columns)


def test_many_regions(spark, layout):
    reads, stored = layout
    regions = [(r, s, e or 3 << 20, i) for i, (r, s, e) in enumerate(REGIONS)]
    got = stored.overlapping_each(spark.createDataFrame(regions, "ref_idx int, start_pos int, end_pos int, id int"))
    want = sorted((i, q) for r, s, e, i in regions for q in names(R.query_overlapping(reads, r, s, e)))
    assert sorted((r.id, r.qname) for r in got.collect()) == want


def test_totals_of_many_regions(spark, layout):
    """Counts and sums without a list of pairs; a region given twice counts twice, one that ends before it starts as listed."""
    reads, stored = layout
    regions = [(r, s, e or 3 << 20) for r, s, e in REGIONS] + [(*REGIONS[0][:2], REGIONS[0][2] or 3 << 20), (1, 30, 20), (2, None, 5)]
    targets = spark.createDataFrame(regions, "ref_idx int, start_pos int, end_pos int")
    listed = stored.overlapping_each(targets).groupBy("ref_idx", "start_pos", "end_pos").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum"))
    assert sorted(map(tuple, stored.overlapping_each(targets, total="pos").collect())) == sorted(map(tuple, listed.collect()))


def scan(df):
    """The plan of the scan and the number of files it read."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaf = plan.collectLeaves().head()
    return leaf.toString(), leaf.metrics().get("numFiles").get().value()


def test_a_query_opens_few_files(spark, layout):
    reads, stored = layout
    files = len(stored.table().inputFiles())
    text, opened = scan(stored.overlapping(1, 500_000, 500_010))
    part = text[text.index("PartitionFilters"):text.index("PushedFilters")]
    assert re.search(r"ref_idx#\d+ = 1\)", part) and all(re.search(rf"bin#\d+ = {b}\)", part) for b, _ in
        BN.candidate_ranges(499_999, 500_010, stored.finest))
    assert "GreaterThanOrEqual(pos," in text and "GreaterThanOrEqual(read_end,500000)" in text
    levels = len(BN.candidate_ranges(499_999, 500_010, stored.finest))
    assert opened <= 3 * levels and (opened < files / 8 or stored.finest == 20)
    text, opened = scan(stored.unmapped())
    assert opened <= 10 and "(ref_idx" in text and "= -1)" in text


def test_reach_skips_reads_that_end_before(spark, tmp_path):
    """A long alignment lifts the lower bound of the tiles it spans; elsewhere it is close to the region."""
    rows = [("long", 0, 1, 100, "10M1000000N10M", "A")] + [(f"r{i}", 0, 1, i * 1000 + 1, "36M", "A") for i in range(3000)]
    store_regions(spark.createDataFrame(rows, READ), str(tmp_path), 14)
    stored = StoredReads(spark, str(tmp_path), 14)
    assert stored.first_reaching(1, 900_000) == 0
    assert stored.first_reaching(1, 2_000_010) == 2_000_001 >> 14 << 14
    assert stored.first_reaching(1, 5_000_000) is None and stored.overlapping(1, 5_000_000, 0).count() == 0
    assert names(stored.overlapping(1, 900_000, 901_030)) == ["long", "r900", "r901"]


def test_bins_hold_their_spans(spark):
    rng = random.Random(3)
    spans = [(s, s + rng.choice([1, 2, 100, 20000, 200000, 9 << 20])) for s in (rng.randint(0, 1 << 28) for _ in range(300))]
    df = spark.createDataFrame(spans, "s int, e int")
    for finest in (14, 17, 20, 23, 26):
        got = df.select("s", "e", BN.bin_of(F.col("s"), F.col("e"), finest).alias("b"),
                        BN.candidate_bins(F.col("s"), F.col("e"), finest).alias("c")).collect()
        for r in got:
            ranges = BN.candidate_ranges(r.s, r.e, finest)
            assert r.b in r.c and r.c == [b for low, high in ranges for b in range(low, high + 1)]


def test_the_cigar_is_read_once(spark):
    rows = spark.createDataFrame([(None, "4M", 0), (0, "1M", 0), (1, "*", 0), (7, "2M3D", 16), (7, "9M", 4), (7, None, 0)],
                                 "pos int, cigar string, flag int").select("*", R.touched_end().alias("end"))
    assert [r.end for r in rows.collect()] == [None, 0, 1, 11, 7, 7]
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1
