"""User functions per chunk and per sorted region."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.ordering import bucket_of, number_rows, row_bytes, with_running_cost


def map_chunks(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema) -> DataFrame:
    """Run ``fn`` over the batches of every partition."""
    return df.mapInPandas(fn, schema)


def apply_regions(df: DataFrame, order: list, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                  max_rows: int = 1 << 20, stored: bool = False) -> DataFrame:
    """Run ``fn`` on contiguous regions of at most ``max_rows`` rows in the given order.

    Regions have equal counts, whatever the keys; ``fn`` gets the rows with their ``bucket`` and ``_row`` number, sorted.
    Where rows differ much in size, ``apply_regions_by_cost`` bounds the bytes of a region instead.
    """
    rows = number_rows(df, order, "_row", stored)
    regions = F.greatest(F.ceil(F.col("_total") / F.lit(max_rows)), F.lit(1))
    bucketed = rows.withColumn("bucket", bucket_of(F.col("_row"), F.col("_total"), regions)).drop("_total")

    def run(region: pd.DataFrame) -> pd.DataFrame:
        return fn(region.sort_values("_row", ignore_index=True))

    return bucketed.groupBy("bucket").applyInPandas(run, schema)


def apply_regions_by_cost(df: DataFrame, order: list, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                          max_bytes: int = 64 << 20, cost: Column | None = None, stored: bool = False) -> DataFrame:
    """Run ``fn`` on contiguous regions of at most ``max_bytes`` in the given order; a row above that is a region of its own.

    ``cost`` is what a row counts for, by default its bytes and 64 more, which bounds the rows of a region too. Regions are cut at every
    half of ``max_bytes``, so the row that crosses a cut fits into the other half, and a row above half stands alone.
    They lie inside range partitions, whose rows are moved once, by partition, for both the sums and ``fn``, which gets
    its rows with their ``bucket`` (numbered in order) and ``_row`` number, sorted.
    """
    half = max_bytes // 2
    rows = with_running_cost(df, order, row_bytes(df) + 64 if cost is None else cost, stored).drop("_before", "_all")
    cut = F.floor(F.col("_local") / half) * 2 + F.when(F.col("_cost") > half, 1).otherwise(0)
    rows = rows.withColumn("_cut", cut).drop("_local", "_cost")

    # numbered inside each partition, then by the regions of the partitions before: one row per partition
    parts = rows.groupBy("_part").agg(F.count_distinct("_cut").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy("_cut")
    rows = rows.withColumn("bucket", F.dense_rank().over(inside) - 1).join(F.broadcast(offsets), "_part")
    rows = rows.withColumn("bucket", F.col("bucket") + F.col("_offset")).drop("_offset")

    def run(region: pd.DataFrame) -> pd.DataFrame:
        return fn(region.drop(columns=["_part", "_cut"]).sort_values("_row", ignore_index=True))

    return rows.groupBy("_part", "_cut").applyInPandas(run, schema)
