"""Hierarchical recalibration: the levels, the reads, and the bases behind them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import mismatches as M
from readloom.operators import recalibration as RC

COUNTS = "rg string, bq int, cycle int, context string, n_obs long, n_mm long"
READ = "read_id long, flag int, seq string, qual string, rg string"


def table(spark, *rows, **kw):
    return RC.hierarchical_table(spark.createDataFrame(list(rows), COUNTS), **kw)


def scores(df):
    return {(r.rg, r.bq, r.level, r.value): r.score for r in df.collect()}


def test_levels_shrink_towards_the_one_above(spark):
    got = scores(table(spark, ("g", 30, 1, "AC", 10 ** 9, 10 ** 7), ("g", 30, 2, "CC", 10 ** 9, 10 ** 5), ("g", 10, 1, "RG", 1, 0)))
    assert abs(got["g", 30, "quality", None] - -10 * math.log10(1.01e7 / 2e9)) < 1e-3
    assert abs(got["g", 30, "quality", None] + got["g", 30, "cycle", "1"] - 20) < 1e-3
    assert abs(got["g", 30, "quality", None] + got["g", 30, "context", "CC"] - 40) < 1e-3
    # one observation hardly moves a score from what the group is shifted by
    shift = -10 * math.log10(1.01e7 / 2e9) - 30
    assert abs(got["g", 10, "quality", None] - (10 + shift)) < 0.1 and ("g", 10, "context", "NG") in got


def test_no_evidence_leaves_scores_as_they_are(spark):
    """Errors as promised: every score stays what it was."""
    got = scores(table(spark, ("g", 20, 1, "AC", 10 ** 6, 10 ** 4), (None, 20, 1, "AC", 10 ** 6, 10 ** 4)))
    assert all(abs(v - (20 if k[2] == "quality" else 0)) < 1e-6 for k, v in got.items()) and {k[0] for k in got} == {"g", ""}


def plain_quality(found, r):
    n, out = len(r.seq or ""), []
    if r.qual == "*" or r.qual is None or len(r.qual) != n:
        return r.qual
    for i, (base, q) in enumerate(zip(r.seq, r.qual)):
        bq, rg = ord(q) - 33, r.rg or ""
        back = bool(r.flag & 16)
        pair = "ACGT".find
        letter = lambda k: -1 if not 0 <= k < n else pair(r.seq[k].upper())
        name = lambda x: "N" if x < 0 else "ACGT"[3 - x if back else x]
        context = name(letter(i + 1 if back else i - 1)) + name(letter(i))
        cycle = n - i if back else i + 1
        if bq < 6 or (rg, bq, "quality", None) not in found:
            out.append(q)
            continue
        s = found[rg, bq, "quality", None] + found.get((rg, bq, "cycle", str(cycle)), 0) + found.get((rg, bq, "context", context), 0)
        out.append(chr(33 + min(60, max(1, math.floor(s + 0.5)))))
    return "".join(out)


@pytest.mark.parametrize("room", [1, 1_000_000])
def test_reads_equal_a_loop_over_their_bases(spark, monkeypatch, room):
    monkeypatch.setattr(RC, "TABLE_ROWS", room)  # a block of corrections per read group, or one for all
    rng = np.random.default_rng(5)
    counts = [(g, int(q), int(c), x + y, int(rng.integers(1, 5000)), int(rng.integers(0, 50)))
              for g in ("a", "b", None) for q in (2, 10, 20, 30) for c in (1, 2, 5, 9) for x in "ACGTN" for y in "ACG"]
    corrections = table(spark, *counts)
    rows = [(i, int(rng.choice([0, 16, 4])), "".join(rng.choice(list("ACGTNacgR."), n)), "".join(chr(33 + int(q)) for q in rng.choice([2, 10, 20, 30, 41], n)),
             str(rng.choice(["a", "b", "z"]))) for i, n in enumerate(rng.integers(1, 40, 200))]
    rows += [(900, 0, "*", "*", "a"), (901, 0, "ACGT", "*", "a"), (902, 0, "ACGT", "II", "a"), (903, 16, "ACGT", "5555", None), (904, 0, None, None, "a"), (905, 0, "", "", "b")]
    reads = spark.createDataFrame(rows, READ)
    got = {r.read_id: r for r in RC.recalibrate_reads(reads, corrections).collect()}
    found = scores(corrections)
    assert len(got) == len(rows) and sum(got[r.read_id].qual != r.qual for r in reads.collect()) > 100
    for r in reads.collect():
        assert got[r.read_id].qual == plain_quality(found, r) and got[r.read_id].oq == r.qual


def test_original_qualities_become_a_tag_and_no_corrections_change_nothing(spark):
    tag = lambda v: F.struct(F.lit("Z").alias("type"), F.lit(v).alias("value"))
    reads = spark.createDataFrame([(1, 0, "AC", "55", "g"), (2, 0, "AC", "##", "g")], READ).withColumn(
        "tags", F.create_map(F.lit("OQ"), tag("old"), F.lit("XA"), tag("x")))
    corrected = RC.recalibrate_reads(reads, table(spark, ("g", 20, 1, "NA", 10 ** 6, 10 ** 5), ("g", 2, 1, "NA", 10 ** 6, 10 ** 5)))
    got = {r.read_id: r for r in corrected.collect()}
    assert got[1].qual != "55" and got[1].tags["OQ"].value == "55" and got[1].tags["XA"].value == "x"
    assert got[2].qual == "##" and got[2].tags["OQ"].value == "old"
    assert {r.qual for r in RC.recalibrate_reads(reads, table(spark)).collect()} == {"55", "##"}


def test_known_sites_are_a_mask(spark):
    tiles = spark.createDataFrame([(1, 0, "A" * 10), (1, 1, "C" * 10), (2, 0, "G" * 10)], "ref_idx int, tile int, bases string")
    known = spark.createDataFrame([(1, 1), (1, 4), (1, 4), (1, 10), (1, 20)], "ref_idx int, pos int")
    got = {(r.ref_idx, r.tile): r.known for r in M.with_known_sites(tiles, known, 10).collect()}
    assert got == {(1, 0): "1001000001", (1, 1): "0000000001", (2, 0): None}


def test_the_counts_take_one_pass_over_the_bases(spark):
    """The plan of the corrections joins reads and reference once."""
    reads = spark.createDataFrame([(1, 0, 1, 3, "4M", "ACGT", "5555", "g")], "read_id long, flag int, ref_idx int, pos int, cigar string, seq string, qual string, rg string")
    tiles = spark.createDataFrame([(1, 0, "A" * 10)], "ref_idx int, tile int, bases string")
    counts = M.recalibration_table(M.mismatch_join(reads, tiles, ("rg",), 10))
    plan = RC.hierarchical_table(counts)._jdf.queryExecution().optimizedPlan().toString()
    assert "bases" not in plan and "alignment" not in plan  # behind a checkpoint of the counts
