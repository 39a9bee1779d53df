"""Sequence dictionaries and header records (small tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_dictionaries(a: DataFrame, b: DataFrame) -> DataFrame:
    """(ref_idx, reason) of every disagreement; no rows means equal.

    A length of 0 matches any. MD5 decides where both have one, else the names must be equal.
    """
    left = a.select("ref_idx", F.struct("rname", "length", "md5").alias("a"))
    right = b.select("ref_idx", F.struct("rname", "length", "md5").alias("b"))
    # the checksum is a hexadecimal number: case and leading zeros do not count
    digest = lambda c: F.ltrim(F.lower(c), F.lit("0"))
    reason = (
        F.when(F.col("a").isNull(), F.lit("MISSING_IN_A")).when(F.col("b").isNull(), F.lit("MISSING_IN_B"))
        .when((F.col("a.length") != 0) & (F.col("b.length") != 0) & (F.col("a.length") != F.col("b.length")),
              F.lit("LENGTH"))
        .when(F.col("a.md5").isNotNull() & F.col("b.md5").isNotNull(),
              F.when(digest(F.col("a.md5")) != digest(F.col("b.md5")), F.lit("MD5")))
        .when(F.col("a.rname") != F.col("b.rname"), F.lit("NAME"))
    )
    return (left.join(right, "ref_idx", "full").select("ref_idx", reason.alias("reason"))
            .filter(F.col("reason").isNotNull()))


def reference_length(dictionary: DataFrame) -> DataFrame:
    return dictionary.agg(F.sum("length").alias("total"))


def dedup_header_ids(header: DataFrame) -> DataFrame:
    """Read-group, program and sequence ids that occur more than once: (kind, id, n)."""
    return (header.filter(F.col("kind").isin("RG", "PG", "SQ")).groupBy("kind", "id")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def program_chain_head(programs: DataFrame) -> DataFrame:
    """Programs (id, pp) no other program names as its predecessor."""
    named = programs.select(F.col("pp").alias("id")).filter(F.col("id").isNotNull()).distinct()
    return programs.join(named, "id", "left_anti")
