"""Hierarchical recalibration of base qualities, counted once per base and applied once per read.

A quality is corrected from coarse to fine: the read group's overall error against what its qualities promise, the
error at each reported quality, and on top of that what the sequencing cycle and the context (previous base and base) add. Every level is
shrunk towards the one above it: with n observations it moves n / (n + strength) of the way, so rare
combinations stay close to what is known about their like.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions import flags as FL
from readloom.operators.skew import union_all
from readloom.session import cut_lineage

STRENGTH = 64.0
KEPT_BELOW = 6              # scores below this are markers, not estimates
TOP_SCORE = 60
TABLE_ROWS = 1_000_000      # rows of the corrections sent to the tasks at once: 16 MB
CONTEXT = "ACGTN"


def _score(rate: Column) -> Column:
    return -10 * F.log10(rate)


def hierarchical_table(counts: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """(rg, bq, level, value, n_obs, n_mm, score) from counts by (rg, bq, cycle, context).

    ``level`` is ``quality``, whose score replaces the reported one (value is null), or ``cycle`` or ``context``, whose
    scores are added to it. Reads without a group share one, the empty text. A letter other than A, C, G and T counts as N.
    """
    context = F.regexp_replace("context", "[^ACGT]", "N")
    counts = cut_lineage(counts.select(F.coalesce("rg", F.lit("")).alias("rg"), "bq", "cycle", context.alias("context"), "n_obs", "n_mm"))
    sums = [F.sum("n_obs").alias("n_obs"), F.sum("n_mm").alias("n_mm")]
    shrunk = lambda prior: (F.col("n_mm") + strength * prior) / (F.col("n_obs") + strength)
    by_quality = counts.groupBy("rg", "bq").agg(*sums)
    promised = F.sum(F.col("n_obs") * F.pow(F.lit(10.0), -F.col("bq") / 10)) / F.sum("n_obs")
    groups = by_quality.groupBy("rg").agg(*sums, promised.alias("_promised")).select(
        "rg", (_score(shrunk(F.col("_promised"))) - _score(F.col("_promised"))).alias("_shift"))
    prior = F.pow(F.lit(10.0), -(F.col("bq") + F.col("_shift")) / 10)
    quality = by_quality.join(groups, "rg").withColumn("_rate", shrunk(F.least(prior, F.lit(1.0))))
    base = quality.select("rg", "bq", "_rate")
    out = [quality.select("rg", "bq", F.lit("quality").alias("level"), F.lit(None).cast("string").alias("value"), "n_obs", "n_mm",
                          _score(F.col("_rate")).alias("score"))]
    for level in ("cycle", "context"):
        found = counts.groupBy("rg", "bq", F.col(level).cast("string").alias("value")).agg(*sums).join(base, ["rg", "bq"])
        out.append(found.select("rg", "bq", F.lit(level).alias("level"), "value", "n_obs", "n_mm",
                                (_score(shrunk(F.col("_rate"))) - _score(F.col("_rate"))).alias("score")))
    return union_all(*out)


class _Corrections:
    """The corrections of some read groups as sorted keys, looked up for all bases of a batch together."""

    def __init__(self, rows: pd.DataFrame):
        self.groups = {g: k for k, g in enumerate(sorted(rows.rg.unique()))}
        self.levels = {}
        for level in ("quality", "cycle", "context"):
            own = rows[rows.level == level]
            if level == "quality":
                value = 0
            elif level == "cycle":
                value = own.value.astype(np.int64).to_numpy()
            else:
                value = np.array([CONTEXT.index(v[0]) * 5 + CONTEXT.index(v[1]) for v in own.value], np.int64)
            keys = self._key(own.rg.map(self.groups).to_numpy(np.int64), own.bq.to_numpy(np.int64), value)
            order = np.argsort(keys)
            self.levels[level] = keys[order], own.score.to_numpy(float)[order]

    @staticmethod
    def _key(group, bq, value):
        return ((group * 128 + bq) << 32) + value

    def look_up(self, level: str, group: np.ndarray, bq: np.ndarray, value) -> tuple[np.ndarray, np.ndarray]:
        """Scores, 0 where there is none, and whether there is one."""
        keys, scores = self.levels[level]
        if not len(keys):
            return np.zeros(len(bq)), np.zeros(len(bq), bool)
        wanted = self._key(group, bq, value)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return np.where(found, scores[at], 0.0), found


_CODE = np.full(256, 4, np.int64)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i


def _new_qualities(table: _Corrections, rg: pd.Series, seq: pd.Series, qual: pd.Series, reverse: pd.Series) -> pd.Series:
    """All bases of a batch in one array; a read without usable qualities or corrections keeps its own."""
    good = qual.notna() & seq.notna() & (qual != "*") & (qual.str.len() == seq.str.len()) & rg.isin(table.groups.keys()) & (qual.str.len() > 0)
    if not good.any():
        return qual
    own = qual[good]
    length = own.str.len().to_numpy()
    ends = np.cumsum(length)
    start = np.repeat(ends - length, length)
    scores = np.frombuffer("".join(own).encode("latin-1", "replace"), np.uint8).astype(np.int64) - 33
    letters = _CODE[np.frombuffer("".join(seq[good]).encode("latin-1", "replace"), np.uint8)]
    back = np.repeat(reverse[good].to_numpy(bool), length)
    at = np.arange(len(scores)) - start
    size = np.repeat(length, length)
    cycle = np.where(back, size - at, at + 1)
    turned = np.where(back & (letters < 4), 3 - letters, letters)
    beside = np.where(back, np.append(turned[1:], 4), np.insert(turned[:-1], 0, 4))
    beside[np.where(back, at == size - 1, at == 0)] = 4
    group = np.repeat(rg[good].map(table.groups).to_numpy(np.int64), length)
    base, known = table.look_up("quality", group, scores, 0)
    by_cycle, _ = table.look_up("cycle", group, scores, cycle)
    by_context, _ = table.look_up("context", group, scores, beside * 5 + turned)
    new = np.clip(np.floor(base + by_cycle + by_context + 0.5), 1, TOP_SCORE).astype(np.int64)
    new = np.where(known & (scores >= KEPT_BELOW), new, scores) + 33
    text = new.astype(np.uint8).tobytes().decode("latin-1")
    out = qual.copy()
    out[good] = [text[a:b] for a, b in zip(ends - length, ends)]
    return out


def _corrector(corrections):
    @F.pandas_udf("string")
    def corrected(rg: pd.Series, seq: pd.Series, qual: pd.Series, reverse: pd.Series) -> pd.Series:
        return _new_qualities(corrections.value, rg, seq, qual, reverse)

    return corrected


def recalibrate_reads(reads: DataFrame, table: DataFrame) -> DataFrame:
    """``reads`` with corrected ``qual`` and the former one in ``oq``, and as tag OQ where they have ``tags``.

    The corrections depend on read group, quality, cycle and context alone, so no reference is read and no base becomes a row. Scores
    below 6, unknown read groups and ``*`` stay; so does a score the table lacks. The table goes to the tasks in
    blocks of read groups of at most ``TABLE_ROWS`` rows (or one group), one pass over the reads per block.
    """
    table = cut_lineage(table)
    sizes = table.groupBy("rg").agg(F.count(F.lit(1)).alias("n")).orderBy("rg").toLocalIterator()
    blocks, room = [[]], TABLE_ROWS
    for r in sizes:
        if blocks[-1] and r.n > room:
            blocks.append([])
            room = TABLE_ROWS
        blocks[-1].append(r.rg)
        room -= r.n
    own = F.coalesce("rg", F.lit(""))
    parts = []
    for k, groups in enumerate(blocks):
        rows = table.filter(F.col("rg").isin(groups)).select("rg", "bq", "level", "value", "score").toPandas()
        corrected = _corrector(reads.sparkSession.sparkContext.broadcast(_Corrections(rows)))
        here = reads
        if len(blocks) > 1:  # the last block takes the reads of unknown groups along
            others = [g for b in blocks[:-1] for g in b]
            here = reads.filter(own.isin(groups) if k + 1 < len(blocks) else ~own.isin(others))
        parts.append(here.withColumn("oq", F.col("qual")).withColumn("qual", corrected(own, "seq", "qual", FL.has(FL.REVERSE))))
    out = union_all(*parts)
    if "tags" in reads.columns:
        kept = F.create_map(F.lit("OQ"), F.struct(F.lit("Z").alias("type"), F.col("oq").alias("value")))
        rest = F.map_filter("tags", lambda name, _: name != "OQ")
        out = out.withColumn("tags", F.when(F.col("oq") == F.col("qual"), F.col("tags")).otherwise(F.map_concat(rest, kept)))
    return out
