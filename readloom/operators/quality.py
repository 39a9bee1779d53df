"""Base composition and quality encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import bases as B


def gc_profile(df: DataFrame, seq: str, keys: list[str]) -> DataFrame:
    """Per group: sequences, GC fraction of all their characters, no-calls, and other invalid characters."""
    count = lambda chars: F.sum(B.count_chars(seq, chars))
    total = F.sum(F.length(seq))
    return (
        df.groupBy(*keys).agg(
            F.count(seq).alias("n"), count("GCgc").alias("_gc"), total.alias("_total"),
            count("Nn.").alias("no_call"), count("ACGTacgt").alias("_valid"))
        .select(*keys, "n", (F.col("_gc") / F.nullif(F.col("_total"), F.lit(0))).alias("gc"), "no_call",
                (F.col("_total") - F.col("_valid") - F.col("no_call")).alias("invalid"))
    )


def quality_encoding_vote(reads: DataFrame, keys: list[str], first_by: str | None = None) -> DataFrame:
    """Per group: highest score and the encoding it implies (up to 60 is Sanger).

    All reads vote; ``first_by`` lets only the group's first read by that column decide.
    """
    top = B.max_quality("qual")
    vote = F.min_by(top, F.col(first_by)) if first_by else F.max(top)
    encoding = F.when(F.col("max_q") <= B.SANGER_MAX, F.lit("SANGER")).otherwise(F.lit("ILLUMINA"))
    return reads.groupBy(*keys).agg(vote.alias("max_q")).withColumn("encoding", encoding)


def fix_qualities(reads: DataFrame) -> DataFrame:
    """Illumina scores lowered to Sanger; a read this would take below zero keeps its text and is flagged."""
    fixed = B.shift_illumina("qual")
    return reads.withColumn("bad_quality", fixed.isNull()).withColumn("qual", F.coalesce(fixed, F.col("qual")))
