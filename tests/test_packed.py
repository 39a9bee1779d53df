"""Reads counted in batches give what their bases give one by one."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.functions import bases as B
from readloom.operators import mismatches as M
from readloom.operators import targets as TG

TILE = 50
READ = "read_id string, flag int, ref_idx int, pos int, cigar string, seq string, qual string, rg string"
CIGARS = ["*", "10M", "5S8M", "3M2I4M", "4M3D4M2S", "2H6M", "6M5Q3M", "20=4X", "3M100N5M", "M", "", "7", "1M1M1M", "4P5M", "12M5", None]


def odd_reads(spark, seed):
    """Texts that are null, too short or too long for their CIGAR, odd CIGARs, and reads over every border."""
    pick = random.Random(seed)
    rows = []
    for k in range(300):
        n = pick.choice([0, 1, 5, 10, 12, 13, 24, 30])
        m = n if pick.random() < .8 else pick.choice([0, 1, 4, 40])
        seq = "".join(pick.choice("ACGTNacgt.=R") for _ in range(n)) if pick.random() < .9 else pick.choice(["*", None])
        qual = "".join(chr(33 + pick.choice([0, 2, 10, 40, 93])) for _ in range(m)) if pick.random() < .9 else pick.choice(["*", None])
        rows.append((f"r{k}" if pick.random() < .95 else None, pick.choice([0, 16, 4, 1024, 16, 0, 16, None]), pick.choice([0, 1, 0, 1, 2, -1, None]),
                     pick.choice([None, 0, 1, 5, 47, 95, 99, 100, 101, 240]), pick.choice(CIGARS), seq, qual, pick.choice(["a", "b", None])))
    tiles = [(r, t, "".join(pick.choice("ACGTNacgt") for _ in range(pick.choice([TILE] * 4 + [0, 3, 49, 70]))))
             for r in (0, 1) for t in range(-1, 8) if pick.random() < .9]
    known = [(pick.choice([0, 1]), pick.randrange(1, 300)) for _ in range(60)]
    refbases = spark.createDataFrame([*tiles, (2, 0, None), (2, 1, "A" * TILE)], "ref_idx int, tile int, bases string")
    known = spark.createDataFrame(known, "ref_idx int, pos int")
    return spark.createDataFrame(rows, READ).repartition(3), refbases, M.with_known_sites(refbases, known, TILE)


def same(got, wanted):
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in wanted.schema]
    rows = sorted(map(repr, got.collect()))
    assert rows == sorted(map(repr, wanted.collect())) and rows


@pytest.mark.parametrize("small, twice", [(True, False), (False, False), (True, True)])
def test_pile_is_that_of_the_bases(spark, monkeypatch, small, twice):
    """On a small reference, on a larger one, and where a tile comes twice."""
    reads, refbases, _ = odd_reads(spark, 3)
    if twice:
        refbases = refbases.union(refbases.filter("tile = 1"))
    bases = M.mismatch_join(reads, refbases, (), TILE)
    wrong = F.sum(F.when(~B.same_base("base", "ref_base"), F.col("bq")))
    wanted = bases.groupBy("ref_idx", F.col("ref_pos").alias("pos")).agg(
        F.count(F.lit(1)).alias("depth"), F.sum("bq").alias("qual"), F.coalesce(wrong, F.lit(0)).alias("mm_qual"))
    if not small:
        monkeypatch.setattr(M, "SMALL_TILES", 0)
    same(TG.pile_up(reads, refbases, TILE), wanted)


def test_a_pile_makes_no_row_per_base(spark):
    """5,000 reads over the same 30 positions become at most some rows per position and task."""
    reads = spark.range(5000).selectExpr("cast(id as string) read_id", "0 flag", "0 ref_idx", "11 pos", "'30M' cigar",
                                         "repeat('ACG', 10) seq", "repeat('I', 30) qual")
    refbases = spark.createDataFrame([(0, 0, "A" * TILE)], "ref_idx int, tile int, bases string")
    pile = TG.pile_up(reads, refbases, TILE)
    assert "Generate" not in pile._jdf.queryExecution().executedPlan().toString()
    assert {(r.pos, r.depth, r.qual, r.mm_qual) for r in pile.collect()} == {
        (p, 5000, 200000, 0 if (p - 11) % 3 == 0 else 200000) for p in range(11, 41)}


@pytest.mark.parametrize("small", [True, False])
def test_recalibration_is_that_of_the_bases(spark, monkeypatch, small):
    reads, _, marked = odd_reads(spark, 5)
    bases = M.mismatch_join(reads, marked, ("rg",), TILE)
    table = M.recalibration_table(bases)
    half = table.filter("n_obs > 1")
    wanted = M.recalibrate(bases, half)
    if not small:
        monkeypatch.setattr(M, "SMALL_TILES", 0)
    whole = M.mismatch_join(reads, marked, ("rg",), TILE, apart=False)
    same(M.recalibration_table(whole), table)
    same(M.recalibrate(whole, half), wanted)
    monkeypatch.setattr(M, "TABLE_ROWS", 0)  # a table too large to be sent
    same(M.recalibrate(whole, half), wanted)


def test_no_base_is_joined(spark):
    """Bases are looked up where they are counted; as rows they have their scores only."""
    reads, _, marked = odd_reads(spark, 5)
    whole = M.mismatch_join(reads, marked, ("rg",), TILE, apart=False)
    table = M.recalibration_table(whole)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan(table) and "Join" not in plan(M.recalibrate(whole, table))
