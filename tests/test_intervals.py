"""Interval merging and intersection against brute force, across tile borders."""

import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import intervals as I
from readloom.operators import targets as TG

SCHEMA = "ref_idx int, start_pos int, end_pos int"


def brute_merge(spans, gap):
    out = []
    for ref, s, e in sorted(spans):
        if out and out[-1][0] == ref and s <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], e)
            out[-1][3] += 1
        else:
            out.append([ref, s, e, 1])
    return [tuple(r) for r in out]


def merged(spark, spans, gap, tile_shift):
    rows = I.merge_ranges(spark.createDataFrame(spans, SCHEMA), gap, tile_shift=tile_shift).collect()
    return sorted((r.ref_idx, r.start_pos, r.end_pos, r.n) for r in rows)


EDGES = [(1, 1, 10), (1, 61, 70), (1, 122, 130), (2, 122, 123), (3, 5, 500), (3, 6, 7), (3, 6, 9), (3, 552, 560), (4, 10, 9)]


@pytest.mark.parametrize("tile_shift", [3, 6, 20])
@pytest.mark.parametrize("gap", [50, 51, 0])
def test_merge_edges(spark, gap, tile_shift):
    assert merged(spark, EDGES, gap, tile_shift) == brute_merge(EDGES, gap)


@pytest.mark.parametrize("seed", range(3))
def test_merge_random(spark, seed):
    rng = random.Random(seed)
    spans = []
    for _ in range(600):
        start = rng.randrange(1, 4000)
        spans.append((rng.randrange(3), start, start + rng.choice([0, 3, 10, 400])))
    assert merged(spark, spans, 2, 5) == brute_merge(spans, 2)


def test_islands_are_disjoint_and_apart(spark):
    spans = spark.range(5000).select((F.col("id") % 3).cast("int").alias("ref_idx"), (F.col("id") * 977 % 100000 + 1).cast("int").alias("start_pos"))
    rows = I.merge_ranges(spans.withColumn("end_pos", F.col("start_pos") + 20), 51, tile_shift=12).collect()
    by_ref = sorted((r.ref_idx, r.start_pos, r.end_pos) for r in rows)
    assert all(b[1] > a[2] + 51 for a, b in zip(by_ref, by_ref[1:]) if a[0] == b[0])


def test_padded_merge_ignores_case_and_needs_more_than_touching(spark):
    rows = [("chr1", 3, 10), ("CHR1", 15, 20), ("chr1", 30, 40), ("chr2", 100, 110)]
    df = spark.createDataFrame(rows, "chrom string, start_pos int, end_pos int")
    got = sorted((r.chrom, r.start_pos, r.end_pos, r.n) for r in I.merge_intervals_padded(df, 6, "chrom").collect())
    # 15 - 6 < 10 extends, 30 - 6 < 20 does not
    assert got == [("chr1", 1, 20, 2), ("chr1", 24, 40, 1), ("chr2", 94, 110, 1)]
    touching = spark.createDataFrame([("c", 1, 10), ("c", 16, 20)], "chrom string, start_pos int, end_pos int")
    assert I.merge_intervals_padded(touching, 6, "chrom").count() == 2


@pytest.mark.parametrize("hot_rows", [5, 1 << 21])
def test_intersect_random_lengths(spark, hot_rows):
    rng = random.Random(5)

    def some(n):
        out = []
        for i in range(n):
            start = rng.randrange(1, 3_000_000)
            out.append((rng.randrange(2), start, start + rng.choice([0, 100, 20_000, 2_000_000]), i))
        return out

    a, b = some(150), some(120)
    want = sorted((x[0], max(x[1], y[1]), min(x[2], y[2]), x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    frame = lambda rows, name: spark.createDataFrame(rows, f"{SCHEMA}, {name} int")
    got = I.intersect_intervals(frame(a, "a_id"), frame(b, "b_id"), hot_rows)
    assert sorted((r.ref_idx, r.start_pos, r.end_pos, r.a_id, r.b_id) for r in got.collect()) == want


def test_unmapped_read_with_position_counts_before_its_base(spark):
    reads = spark.createDataFrame([(0, 16385, 4, "*"), (0, 16386, 4, "*"), (0, 16385, 0, "10M"), (0, 16380, 0, "10M"), (-1, 0, 4, "*")],
                                  "ref_idx int, pos int, flag int, cigar string")
    got = {(r.ref_idx, r.win): r.n for r in I.window16k_coverage(reads).collect()}
    assert got == {(0, 0): 2, (0, 1): 3}
    assert {(r.ref_idx, r.bin): r.n for r in I.bin_counts(reads).collect()} == {(0, 4682): 3, (0, 585): 1}


def piled(spark, *rows):
    return spark.createDataFrame(list(rows), "ref_idx int, pos int, depth long, qual long, mm_qual long")


@pytest.mark.parametrize("shift", [1, 3, 12])
def test_noisy_positions_in_windows_across_blocks(spark, shift):
    """Mismatches count for their neighbours too, whatever blocks they lie in; shallow positions are never noisy."""
    rng = random.Random(shift)
    rows = [(r, p, rng.randint(1, 6), 100, rng.choice([0, 0, 0, 100, 60])) for r in (0, 1) for p in rng.sample(range(1, 200), 120)]
    got = {(r.ref_idx, r.pos) for r in TG.noisy_positions(piled(spark, *rows), 8, 4, 0.3, shift).collect()}
    want = set()
    for ref, pos, depth, _, _ in rows:
        near = [x for x in rows if x[0] == ref and abs(x[1] - pos) <= 4]
        bad = sum(x[4] for x in near)
        if depth >= 4 and bad and bad >= 0.3 * sum(x[3] for x in near):
            want.add((ref, pos))
    assert got == want and 10 < len(got) < 200


def test_targets_unite_all_evidence(spark):
    """An indel, mismatches no single one of which is an indel, and a known site far from any read."""
    reads = spark.createDataFrame(
        [(i, 0, 1, 11, 30, "10M", "ACGTACGTAC", "I" * 10) for i in range(5)]
        + [(10, 0, 1, 101, 30, "4M2I4M", "ACGTGGACGT", "I" * 10), (11, 4, -1, 0, 0, "*", "ACGT", "IIII")]
        + [(20 + i, 0, 1, 201, 30, "10M", "ACGTACGTTC", "IIIIIIII#I") for i in range(4)],
        "read_id long, flag int, ref_idx int, pos int, mapq int, cigar string, seq string, qual string")
    genome = "A" * 10 + "ACGTACGTCC" + "A" * 80 + "ACGTACGT" + "A" * 92 + "ACGTACGTAC" + "A" * 90
    tiles = spark.createDataFrame([(1, k, genome[k * 50:k * 50 + 50]) for k in range(6)], "ref_idx int, tile int, bases string")
    pile = {r.pos: (r.depth, r.qual, r.mm_qual) for r in TG.pile_up(reads, tiles, 50).collect()}
    assert pile[19] == (5, 200, 200) and pile[11] == (5, 200, 0) and pile[209] == (4, 8, 8) and 109 not in pile
    known = spark.createDataFrame([(1, 280, 282), (2, 5, 5)], "ref_idx int, start_pos int, end_pos int")
    got = TG.realignment_targets(reads, tiles, known, gap=2, window=2, min_depth=4, fraction=0.3, tile=50)
    # the mismatch at 209 has almost no quality behind it
    assert sorted(tuple(r) for r in got.collect()) == [(1, 18, 20, 3), (1, 104, 105, 1), (1, 280, 282, 1), (2, 5, 5, 1)]
    alone = TG.realignment_targets(reads, tiles, None, 2, 2, 4, 0.3, 50)
    assert sorted(tuple(r) for r in alone.collect()) == [(1, 18, 20, 3), (1, 104, 105, 1)]
