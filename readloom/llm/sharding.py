"""A reproducible shuffle into shards: a Feistel permutation of the global row numbers.

The permutation works on a grid of a x b cells with a * b just above the number of rows; a round adds a hash of
one coordinate to the other. A result beyond the last row is permuted again (cycle walking). Less than a square
root of the rows lies beyond, and how often a walk can be repeated at most is found by following these points alone.
Shard and slot of a row number can thus be computed without looking at any other row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import text_of
from readloom.operators.ordering import number_rows

ROUNDS = 6
SEED = 20


def _grid(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def _permute_once(df: DataFrame, name: str, rows: int, seed: int) -> DataFrame:
    """One pass of the Feistel rounds over ``name``, for the rows where ``__go`` holds."""
    a, b = _grid(rows)
    out = df.withColumns({"__l": F.floor(F.col(name) / b), "__r": F.col(name) % b})
    for turn in range(ROUNDS):
        to, of, size = ("__l", "__r", a) if turn % 2 == 0 else ("__r", "__l", b)
        noise = F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), F.col(of)), F.lit(size))
        out = out.withColumn(to, (F.col(to) + noise) % size)
    moved = F.col("__l") * b + F.col("__r")
    return out.withColumn(name, F.when(F.col("__go"), moved).otherwise(F.col(name))).drop("__l", "__r")


def longest_walk(spark, rows: int, seed: int = SEED) -> int:
    """How many more passes a point beyond the last row can need; points that never come back are never reached."""
    a, b = _grid(rows)
    beyond, steps = a * b - rows, 0
    points = spark.range(rows, a * b).withColumn("__go", F.col("id") >= 0)
    while beyond:
        points = _permute_once(points, "id", rows, seed).filter(F.col("id") >= rows)
        steps, before, beyond = steps + 1, beyond, points.count()
        if beyond == before:
            return steps - 1
    return steps


def permute(df: DataFrame, name: str, rows: int, seed: int = SEED) -> DataFrame:
    """Replaces the row number ``name`` (0 to ``rows`` - 1) by its place in the shuffle."""
    out = _permute_once(df.withColumn("__go", F.lit(True)), name, rows, seed)
    for _ in range(longest_walk(df.sparkSession, rows, seed)):
        out = _permute_once(out.withColumn("__go", F.col(name) >= rows), name, rows, seed)
    return out.drop("__go")


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = SEED, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Every row with its shard and slot: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    Law ``rows``: the numbers of rows of two shards differ by one at most. Rows are numbered by id, then
    checksum and size; rows alike in all three are interchangeable. Null ids come first; a null text is empty;
    groups of equal texts need no care, since only row numbers decide. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text_of(text_col)) + 8).cast("long").alias("size"),
        F.crc32(text_of(text_col).cast("binary")).alias("text_crc32"))
    numbered = number_rows(rows, ["doc_id", "text_crc32", "size"], "row_number").drop("_total")
    placed = permute(numbered.withColumn("__place", F.col("row_number")), "__place", docs.count(), seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("__place") % shards).cast("int").alias("shard"),
        F.floor(F.col("__place") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "row_number")
