"""Realignment targets: islands of indels, of noisy stretches and of known sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import cigar as C
from readloom.functions import flags as FL
from readloom.operators.intervals import merge_ranges
from readloom.operators.mismatches import TILE, mismatch_join
from readloom.operators.packed import piled
from readloom.operators.skew import union_all

BLOCK_SHIFT = 12  # positions of a window partition, as a power of two


def pile_up(reads: DataFrame, refbases: DataFrame, tile: int = TILE) -> DataFrame:
    """(ref_idx, pos, depth, qual, mm_qual) per covered position: bases, the sum of their scores, and that of the mismatched ones.

    Reads of near places come together and are added up batch by batch, so what becomes rows is positions, not bases.
    """
    aligned = mismatch_join(reads, refbases, (), tile, apart=False)
    return piled(aligned.together()).groupBy("ref_idx", "pos").agg(*[F.sum(c).alias(c) for c in ("depth", "qual", "mm_qual")])


def noisy_positions(pile: DataFrame, window: int = 10, min_depth: int = 4, fraction: float = 0.15,
                    block_shift: int = BLOCK_SHIFT) -> DataFrame:
    """The positions of at least ``min_depth`` bases where mismatches hold a ``fraction`` of all quality within ``window`` / 2 positions.

    Windows run in blocks of positions; those at a border are copied into the block next to it.
    """
    half = window // 2
    home = F.shiftright("pos", block_shift)
    blocks = F.sequence(F.shiftright(F.col("pos") - half, block_shift), F.shiftright(F.col("pos") + half, block_shift))
    spread = pile.withColumn("_block", F.explode(blocks))
    near = Window.partitionBy("ref_idx", "_block").orderBy("pos").rangeBetween(-half, half)
    sums = spread.withColumns({"_q": F.sum("qual").over(near), "_m": F.sum("mm_qual").over(near)})
    noisy = (F.col("depth") >= min_depth) & (F.col("_m") > 0) & (F.col("_m") >= F.col("_q") * fraction)
    return sums.filter((F.col("_block") == home) & noisy).select(*pile.columns)


def realignment_targets(reads: DataFrame, refbases: DataFrame, known: DataFrame | None = None, gap: int = 0, window: int = 10,
                        min_depth: int = 4, fraction: float = 0.15, tile: int = TILE) -> DataFrame:
    """Islands (ref_idx, start_pos, end_pos, n) of all evidence at most ``gap`` apart; n counts its spans.

    Evidence are the places of CIGAR indels of mapped reads, one span each, the positions of ``noisy_positions``, and the spans
    ``known`` (ref_idx, start_pos, end_pos), such as known indels. Reads need a unique ``read_id``.
    """
    mapped = reads.filter(~FL.has(FL.UNMAPPED) & (F.col("ref_idx") >= 0) & F.col("cigar").rlike("[ID]"))
    indels = mapped.select("ref_idx", F.explode(C.gapped_positions()).alias("_s")).select(
        "ref_idx", F.col("_s.start").alias("start_pos"), F.col("_s.end").alias("end_pos"))
    noisy = noisy_positions(pile_up(reads, refbases, tile), window, min_depth, fraction).select(
        "ref_idx", F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"))
    parts = [indels, noisy]
    if known is not None:
        parts.append(known.select("ref_idx", "start_pos", "end_pos"))
    return merge_ranges(union_all(*parts), gap)
