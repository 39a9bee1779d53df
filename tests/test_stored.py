"""What stored intermediates take of the disk, and the rows they keep."""

import time

from pyspark.sql import functions as F

from readloom.operators import duplicates as DU
from readloom.plans import dna_queries
from readloom.plans.fixtures import distinct_rows
from readloom.session import store

READ = "qname string, flag int, ref_idx int, pos int, cigar string, seq string, qual string, rg string"


def test_shuffles_of_what_was_stored_are_freed(spark):
    """Those of a table go when it or the next one is stored, not when the driver happens to collect garbage."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = manager.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().endswith(".data")}

    before = held()
    stored = store(spark.range(200_000).groupBy((F.col("id") % 1000).alias("k")).count())
    own = held() - before
    store(spark.range(10))
    for _ in range(40):
        if not own & held():
            break
        time.sleep(0.5)
    assert not own & held() and stored.count() == 1000


def test_the_job_packs_its_text(spark, monkeypatch):
    paths = []
    write = dna_queries.S.write_sam
    monkeypatch.setattr(dna_queries.S, "write_sam", lambda rows, header, path, *a, **kw: paths.append(path) or write(rows, header, path, *a, **kw))
    rows = dna_queries.read_back(spark, "/root/testdata/sf0.001")
    files = [r[0] for r in spark.read.format("binaryFile").load(paths[0]).select("path").collect()]
    assert files and all(f.endswith(".gz") for f in files)
    ends = dna_queries.fixture(spark, "/root/testdata/sf0.001", "f_ends")
    columns = ["qname", "flag", "ref_idx", "pos", "mapq", "cigar", "mate_ref_idx", "pnext", "tlen", "seq", "qual", "rg"]
    assert sorted(map(repr, rows.select(*columns).collect())) == sorted(map(repr, ends.select(*columns).collect()))


def test_names_come_back_behind_the_join(spark):
    """Ends carry their name as the key only; names of other records, null ones too, stay as they are."""
    rows = [("a", 0, 0, 10, "4M", "ACGT", "IIII", None), ("b", 0, 0, 10, "4M", "ACGT", "III#", ""), ("b", 256, 0, 10, "4M", "ACGT", "IIII", None),
            (None, 0, 0, 10, "4M", "ACGT", "IIII", "x"), ("c", 4, -1, 0, "*", "ACGT", "IIII", None), (None, 4, -1, 0, "*", "ACGT", "IIII", None)]
    got = DU.mark_duplicates(spark.createDataFrame(rows, READ)).collect()
    assert sorted(map(repr, (tuple(r)[:8] for r in got))) == sorted(map(repr, rows))
    assert [r.qname for r in got if r.is_dup] == ["b"]


def test_distinct_rows_are_those_of_distinct(spark):
    """Equal rows, rows that differ in the place of a null only, and too many of them to be sent."""
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 1), (None, "a", 1), ("b", "c", 2), (None, None, None), (None, None, None)], "x string, y string, z int")
    same = lambda df: sorted(map(repr, distinct_rows(df).collect())) == sorted(map(repr, df.distinct().collect()))
    assert same(rows) and same(rows.filter("z = 2")) and same(rows.limit(0))
    many = spark.range(120_000).selectExpr("id % 110000 x", "'t' y").union(spark.range(110_000).selectExpr("id x", "'t' y"))
    assert distinct_rows(many).count() == 110_000
    wide = distinct_rows(spark.range(1000).selectExpr("id x", "'t' y"))
    assert "x#" not in "".join(line for line in wide._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line and "_hash" in line)
