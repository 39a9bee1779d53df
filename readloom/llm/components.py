"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.skew import copy_rows, heavy_keys, slice_rows
from readloom.session import cut_lineage, scratch_dir

HOT_LINKS = 1 << 17  # links of one node after which its star is built in slices


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again. With a checkpoint rounds took ever longer to start, most likely since it hands on the constraints of the columns,
    which grow with each renaming of u and v (inferred, not profiled)."""
    path = scratch_dir(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _star(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the least number among u and its partners; one table of nodes serves the minimum and the slices."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
                            .select("u", F.least("u", "m").alias("m"), "_n"))
    hot = heavy_keys(least, ["u"], HOT_LINKS)
    return (slice_rows(edges, hot, ["u"]).join(copy_rows(least.drop("_n"), hot, ["u"]), ["u", "_slot"]).drop("_slot"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    starred = _star(edges)
    pairs = starred.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pairs.unionByName(starred.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root, the least node of its component, for every linked node but the roots themselves.

    Links may repeat, run either way or join a node with itself. Every round is written out, and a round
    moves one row per link; the rounds grow with the logarithm of the largest component.
    """
    edges = _stored(links.filter(F.col(a) != F.col(b))
                        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = _stored(_small(cut_lineage(_large(edges))))
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
