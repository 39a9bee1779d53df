"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1 << 21      # a key with more rows than this is spread over several tasks
SPREAD = 1 << 16        # slices for rows whose key is null
SMALL_ROWS = 100_000    # a lookup side counted to be no larger than this is broadcast


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, fan: str = "_fan") -> DataFrame:
    """Keys heavier than ``hot_rows`` with the number of slices each needs.

    Counting combines map-side, so a hot key costs one row per task. There are
    fewer hot keys than rows / ``hot_rows``: 10^11 rows have 47,000 of them at most at the default, 1 MB to broadcast.
    """
    return heavy_keys(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, hot_rows, fan)


def heavy_keys(counts: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, fan: str = "_fan") -> DataFrame:
    """``hot_keys`` from a table of keys with their rows in ``_n``."""
    return (counts.filter(F.col("_n") > hot_rows)
            .select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias(fan)))


def _with_fan(df: DataFrame, hot: DataFrame, keys: list[str], fan: str) -> DataFrame:
    return df.join(F.broadcast(hot), keys, "left").withColumn(fan, F.coalesce(F.col(fan), F.lit(1)))


def _row_hash(df: DataFrame, keys: list[str]) -> Column:
    """A hash of all columns but ``keys``; maps have none and are left out."""
    own = [F.col(f"`{f.name}`") for f in df.schema if f.name not in keys and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*own or [F.lit(0)])


def slice_rows(df: DataFrame, hot: DataFrame, keys: list[str], fan: str = "_fan", slot: str = "_slot") -> DataFrame:
    """Give every row one slice number; rows of a hot key spread by the hash of the whole row."""
    return _with_fan(df, hot, keys, fan).withColumn(slot, F.pmod(_row_hash(df, keys), F.col(fan)).cast("int")).drop(fan)


def copy_rows(df: DataFrame, hot: DataFrame, keys: list[str], fan: str = "_fan", slot: str = "_slot") -> DataFrame:
    """Give every row all slice numbers of its key (one, unless the key is hot)."""
    slots = F.sequence(F.lit(0), F.col(fan) - 1)
    return _with_fan(df, hot, keys, fan).withColumn(slot, F.explode(slots)).drop(fan)


def sliced_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join whose hot keys are sliced on the left and copied on the right.

    ``right`` should hold few rows per key; ``how`` may be inner, left, left_semi or left_anti. ``hot`` spares the count of keys
    where they are known.
    """
    hot = hot_keys(left, keys, hot_rows) if hot is None else hot
    sliced = slice_rows(left, hot, keys)
    if how in ("left", "left_anti"):  # rows with a null key find nothing wherever they go, so they are spread
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        sliced = sliced.withColumn("_slot", F.when(missing, F.pmod(_row_hash(left, keys), F.lit(SPREAD)).cast("int")).otherwise(F.col("_slot")))
    out = sliced.join(copy_rows(right, hot, keys), [*keys, "_slot"], how)
    return out.drop("_slot")


def sliced_pairs(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner equi-join where both sides may be hot on the same key: a grid of left × right slices."""
    hot_l = hot_keys(left, keys, hot_rows, "_fan_l")
    hot_r = hot_keys(right, keys, hot_rows, "_fan_r")
    gridded_l = copy_rows(slice_rows(left, hot_l, keys, "_fan_l", "_slot_l"), hot_r, keys, "_fan_r", "_slot_r")
    gridded_r = copy_rows(slice_rows(right, hot_r, keys, "_fan_r", "_slot_r"), hot_l, keys, "_fan_l", "_slot_l")
    return gridded_l.join(gridded_r, [*keys, "_slot_l", "_slot_r"]).drop("_slot_l", "_slot_r")


def small_or_none(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame | None:
    """``df`` marked for broadcast if counting (up to the bound) shows it is small, else None."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else None


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to a table with unique keys: broadcast if it is counted small, sliced join otherwise."""
    small = small_or_none(right)
    if small is not None:
        return left.join(small, keys, how)
    return sliced_join(left, right, keys, how)


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
