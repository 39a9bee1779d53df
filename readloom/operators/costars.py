"""Co-star sets without a list of pairs: membership along the edges, sizes from classes of performers.

Performers who are in the same crowded titles have the same co-stars there, so they are one class with a weight. How many performers
meet both of two classes is counted with bitmaps over classes: each task holds the crowded titles of one bucket of classes as sets, and a
slice of the pairs asked for. No set of a performer is ever stored or sent. Titles of at most ``SMALL_CAST`` performers are cheaper as
pairs, of which a member has no more than that; only those that share no crowded title count besides.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.ordering import number_rows
from readloom.operators.skew import HOT_ROWS, heavy_keys, sliced_join, sliced_pairs, union_all
from readloom.session import cut_lineage

SMALL_CAST = 512
CLASSES = 1 << 17       # classes of a bucket at most, and so bits of a set
BUCKET_EDGES = 1 << 22  # titles of all classes of a bucket, about
ASKED = 1 << 16         # pairs of classes asked for in a slice, about


@dataclasses.dataclass
class CostarSets:
    """Crowded edges (actor, title), classes (class, titles, weight) and their members, and the pairs (x, y) of small casts besides."""

    crowded: DataFrame
    classes: DataFrame
    members: DataFrame
    others: DataFrame
    hot_rows: int


def costar_bitmaps(bip: DataFrame, small_cast: int = SMALL_CAST, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, CostarSets]:
    """The different edges (actor, title), and what the sizes of co-star sets are counted from."""
    edges = cut_lineage(bip.select("actor", "title").dropna().distinct())
    sizes = edges.groupBy("title").agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(number_rows(sizes.filter(F.col("_n") > small_cast), ["title"], "_t").select("title", "_t", "_n"))
    hot = heavy_keys(large, ["title"], hot_rows)
    crowded = cut_lineage(sliced_join(edges, large.drop("_n"), ["title"], hot=hot))
    small = edges.join(sizes.filter(F.col("_n") <= small_cast).select("title"), "title")
    held = crowded.groupBy("actor").agg(F.sort_array(F.collect_list("_t")).alias("titles"))
    held = cut_lineage(held)
    kinds = held.groupBy("titles").agg(F.count(F.lit(1)).alias("weight"))
    classes = cut_lineage(number_rows(kinds, ["titles"], "class").select("class", "titles", "weight"))
    members = cut_lineage(sliced_join(held, classes.select("class", "titles"), ["titles"], hot_rows=hot_rows).select("actor", "class"))
    edges_small = cut_lineage(small.select("actor", "title"))
    pairs = cut_lineage(edges_small.select("title", F.col("actor").alias("a")).join(
        edges_small.select("title", F.col("actor").alias("b")), "title").select("a", "b").distinct())
    crowded = crowded.select("actor", "title")
    others = cut_lineage(pairs.join(_sharing(pairs, crowded, hot_rows), ["a", "b"], "left_anti"))
    return edges, CostarSets(crowded, classes, members, others, hot_rows)


def _sharing(pairs: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Those of the different ``pairs`` (a, b) with a title in common, a performer with any title shares it with itself."""
    first = sliced_pairs(pairs.select("a", "b"), edges.select(F.col("actor").alias("a"), "title"), ["a"], hot_rows)
    second = edges.select(F.col("actor").alias("b"), "title")
    return sliced_join(first, second, ["b", "title"], "left_semi", hot_rows).select("a", "b").distinct()


def costar_degrees(edges: DataFrame, sets: CostarSets) -> DataFrame:
    """(actor, degree): how many others a performer shares a title with, 0 included."""
    own = _common_of_classes(sets.classes.select(F.col("class").alias("ca"), F.col("class").alias("cb")), sets.classes)
    own = cut_lineage(own.select(F.col("ca").alias("class"), "n"))
    among = sliced_join(sets.members, own, ["class"], hot_rows=sets.hot_rows).select("actor", "n")
    besides = sets.others.groupBy(F.col("a").alias("actor")).agg(F.count(F.lit(1)).alias("n"))
    return union_all(among, besides).groupBy("actor").agg((F.sum("n") - 1).alias("degree"))


def are_costars(pairs: DataFrame, edges: DataFrame, sets: CostarSets) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: whether two different performers share a title; unknown ones do not."""
    asked = cut_lineage(pairs.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    found = cut_lineage(_sharing(asked, edges, sets.hot_rows)).withColumn("linked", F.lit(True))
    return sliced_join(pairs, found, ["a", "b"], "left", sets.hot_rows).select(
        *pairs.columns, F.coalesce("linked", F.lit(False)).alias("linked"))


def common_costars(pairs: DataFrame, edges: DataFrame, sets: CostarSets) -> DataFrame:
    """``pairs`` (a, b) with ``common``: how many performers share a title with both, neither of the two counted.

    Counted by class are those met in crowded titles by both; then those that one of the two meets in small casts only.
    """
    asked = cut_lineage(pairs.select("a", "b").distinct())
    class_of = lambda c: sets.members.select(F.col("actor").alias(c), F.col("class").alias(f"c{c}"))
    known = sliced_join(sliced_join(asked, class_of("a"), ["a"], hot_rows=sets.hot_rows), class_of("b"), ["b"], hot_rows=sets.hot_rows)
    known = cut_lineage(known)
    met = cut_lineage(_common_of_classes(known.select("ca", "cb").distinct(), sets.classes))
    among = sliced_join(known, met, ["ca", "cb"], hot_rows=sets.hot_rows).select("a", "b", "n")
    besides = sets.others.select(F.col("a").alias("one"), F.col("b").alias("x"))
    reach = lambda c: sliced_pairs(asked, besides.withColumnRenamed("one", c), [c], sets.hot_rows).select("a", "b", "x")
    of_a, of_b = cut_lineage(reach("a")), cut_lineage(reach("b"))

    def also(rows: DataFrame, other: str, own: DataFrame) -> DataFrame:
        """Rows (a, b, x) whose x shares one of the titles in ``own`` with the other of the pair."""
        checked = cut_lineage(rows.select(F.col("x").alias("a"), F.col(other).alias("b")).distinct())
        found = _sharing(checked, own, sets.hot_rows).select(F.col("a").alias("x"), F.col("b").alias(other))
        return sliced_join(rows, found, ["x", other], hot_rows=sets.hot_rows).select("a", "b", F.lit(1).cast("long").alias("n"))

    counted = union_all(among, also(of_a, "b", edges), also(of_b, "a", sets.crowded)).groupBy("a", "b").agg(F.sum("n").alias("_n"))
    linked = are_costars(asked, edges, sets)
    # a pair that shares a title has both of its own in both sets; a performer with itself has all of its set
    own = F.when(F.col("a") == F.col("b"), 1).when(F.col("linked"), 2).otherwise(0)
    found = linked.join(counted, ["a", "b"], "left").select("a", "b", (F.coalesce("_n", own.cast("long")) - own).cast("long").alias("common"))
    return sliced_join(pairs, cut_lineage(found), ["a", "b"], "left", sets.hot_rows)


def _common_of_classes(asked: DataFrame, classes: DataFrame) -> DataFrame:
    """(ca, cb, n) for different pairs of classes: how many performers share a crowded title with both.

    Each of the slices of ``asked`` meets each bucket of classes in one task; every sum is over buckets.
    """
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("titles")).alias("edges")).first()
    pairs = asked.count()
    if not size.n or not pairs:
        return asked.withColumn("n", F.lit(0).cast("long"))
    buckets = max(-(-size.n // CLASSES), -(-size.edges // BUCKET_EDGES))
    slices = max(-(-pairs // ASKED), min(asked.sparkSession.sparkContext.defaultParallelism, -(-pairs // 1024)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda c: classes.select(F.col("class").alias(f"c{c}"), F.col("titles").alias(f"t{c}"))
    named = sliced_join(sliced_join(asked, own("a"), ["ca"]), own("b"), ["cb"])
    left = named.withColumn("slice", F.pmod(F.xxhash64("ca"), F.lit(slices)).cast("int")).withColumn("bucket", every(buckets))
    right = classes.select(F.pmod("class", F.lit(buckets)).cast("int").alias("bucket"), F.floor(F.col("class") / buckets).cast("int").alias("at"),
                           "titles", "weight").withColumn("slice", every(slices))
    met = left.groupBy("slice", "bucket").cogroup(right.groupBy("slice", "bucket")).applyInArrow(_meeting(), "ca long, cb long, n long")
    return met.groupBy("ca", "cb").agg(F.sum("n").alias("n"))


def _meeting():
    """What a task does, as a closure: workers need not have this package."""
    def lists_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all lists and where each begins, with the end."""
        lists = column.combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        return lists.flatten().to_numpy(zero_copy_only=False), ends

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        """Pairs of classes against one bucket: the weight of all its classes that share a title with both."""
        ca, cb = (asked[c].to_numpy() for c in ("ca", "cb"))
        if not len(ca) or not held.num_rows:
            return pa.table({"ca": ca, "cb": cb, "n": np.zeros(len(ca), dtype=np.int64)})
        at, weight = held["at"].to_numpy(), held["weight"].to_numpy()
        bits = -(-(int(at.max()) + 1) // 64) * 64
        titles, ends = lists_of(held["titles"])
        order = np.argsort(titles, kind="stable")
        where = np.repeat(at, np.diff(ends))[order]
        names, starts = np.unique(titles[order], return_index=True)
        stops = np.append(starts[1:], len(where))

        def packed(flags: np.ndarray) -> np.ndarray:
            return np.packbits(flags, bitorder="little").view(np.uint64)

        full = np.zeros(bits, dtype=np.int64)
        full[at] = weight
        digits = [packed((full >> k & 1).astype(bool)) for k in range(int(weight.max()).bit_length())]  # a weight is a sum of powers of two

        @functools.lru_cache(None)  # only of titles that fill a part of the bucket, of which there are few
        def dense(k: int) -> np.ndarray:
            flags = np.zeros(bits, dtype=bool)
            flags[where[starts[k]:stops[k]]] = True
            return packed(flags)

        def reached(own: np.ndarray) -> np.ndarray:
            found = np.minimum(np.searchsorted(names, own), len(names) - 1)
            found = found[names[found] == own]
            many = stops[found] - starts[found] > bits // 32
            out = np.zeros(bits // 64, dtype=np.uint64)
            for k in found[many].tolist():
                out |= dense(k)
            if not many.all():
                flags = np.zeros(bits, dtype=bool)
                for k in found[~many].tolist():
                    flags[where[starts[k]:stops[k]]] = True
                out |= packed(flags)
            return out

        (ta, ea), (tb, eb) = lists_of(asked["ta"]), lists_of(asked["tb"])
        n, last = np.zeros(len(ca), dtype=np.int64), None
        second = functools.lru_cache(2048)(lambda c, i: reached(tb[eb[i]:eb[i + 1]]))
        first_row = dict(zip(cb.tolist(), range(len(cb)), strict=True))
        for i in np.argsort(ca, kind="stable").tolist():
            if ca[i] != last:
                last, mine = ca[i], reached(ta[ea[i]:ea[i + 1]])
            both = mine if ca[i] == cb[i] else mine & second(int(cb[i]), first_row[int(cb[i])])
            n[i] = sum(int(np.bitwise_count(both & d).sum(dtype=np.int64)) << k for k, d in enumerate(digits))
        return pa.table({"ca": ca, "cb": cb, "n": n})

    return meet
