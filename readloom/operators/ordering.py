"""Global positions, equal-count buckets and sort checks without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.operators.skew import lookup_join, union_all
from readloom.session import cut_lineage

RUN = 1 << 18   # rows per window when a neighbour row is needed
_LOCAL_BITS = 33  # monotonically_increasing_id() keeps the partition above this bit


def _placed(df: DataFrame, order: list, stored: bool) -> tuple[DataFrame, DataFrame]:
    """Sorted and checkpointed rows with (_part, _local), and (_part, _start, _total) per partition.

    The input position is the last sort key, so even a third of all rows being equal splits
    over several range partitions. A scan of files gives every row the same position when a lost task runs
    again, shuffled rows may not: unless ``stored`` says the input is such a scan, it is checkpointed first.
    The offsets table has one row per partition.
    """
    df = df if stored else cut_lineage(df)
    placed = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .orderBy(*order, "_tie").drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed).withColumn("_part", F.shiftright("_at", _LOCAL_BITS))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                            F.sum("_n").over(everything).alias("_total"))
    local = F.col("_at").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return placed.withColumn("_local", local), offsets


def number_rows(df: DataFrame, order: list, name: str, stored: bool = False) -> DataFrame:
    """Adds the position of every row in the given order, and ``_total``, the number of rows."""
    rows, offsets = _placed(df, order, stored)
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_start") + F.col("_local"))
            .drop("_part", "_at", "_local", "_start"))


def stored_position(stored: DataFrame, name: str = "ord") -> DataFrame:
    """Adds the 0-based position of every row in a table read from parquet, whose part files follow their numbers.

    A row knows its place in its file; only the table of files (one row each) is ranked.
    """
    rows = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    part = F.regexp_extract("_file", "^part-([0-9]+)", 1).try_cast("long")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return lookup_join(rows, starts, ["_file"], "inner").withColumn(name, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")


def ordinal(df: DataFrame, order: list, name: str = "ord", stored: bool = False) -> DataFrame:
    """Contiguous 0-based position of every row in the given order; ``stored``: see ``_placed``."""
    return number_rows(df, order, name, stored).drop("_total")


def bucket_of(position: Column, total: Column, n: int | Column) -> Column:
    """Bucket of a position when ``total`` rows are cut into n runs, the first total % n one longer."""
    short = F.floor(total / F.lit(n))
    long_runs = total % n
    in_long = F.floor(position / (short + 1))
    in_short = long_runs + F.floor((position - long_runs * (short + 1)) / F.greatest(short, F.lit(1)))
    return F.when(position < long_runs * (short + 1), in_long).otherwise(in_short).cast("int")


def balance_load(df: DataFrame, n: int, order: list, name: str = "bucket", stored: bool = False) -> DataFrame:
    """Contiguous buckets 0..n-1 in the given order whose sizes differ by at most one."""
    rows = number_rows(df, order, "_ord", stored)
    return rows.withColumn(name, bucket_of(F.col("_ord"), F.col("_total"), n)).drop("_ord", "_total")


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: the length of texts and binaries, of anything nested as JSON, and 8 for other columns."""
    size = F.lit(0).cast("long")
    for field in df.schema:
        kind, own = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(own), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(own))), F.lit(0))
        else:
            size = size + 8
    return size


def with_running_cost(df: DataFrame, order: list, cost: Column, stored: bool = False) -> DataFrame:
    """Adds, in the given order: ``_row``, ``_cost``, ``_before`` (the cost of all rows before), ``_all`` (of all rows), ``_part`` and
    ``_local`` (the cost of the rows before in the same range partition).

    Costs are added up inside range partitions; what earlier ones cost comes in as one row per partition.
    """
    placed, offsets = _placed(df.withColumn("_cost", cost.cast("long")), order, stored)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    costs = placed.groupBy("_part").agg(F.sum("_cost").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_earlier"), F.sum("_sum").over(everything).alias("_all"))
    upto = Window.partitionBy("_part").orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("_inside", F.coalesce(F.sum("_cost").over(upto), F.lit(0)))
    return (rows.join(F.broadcast(offsets.drop("_total")), "_part").join(F.broadcast(costs), "_part")
            .withColumns({"_row": F.col("_start") + F.col("_local"), "_before": F.col("_earlier") + F.col("_inside"), "_local": F.col("_inside")})
            .drop("_at", "_start", "_earlier", "_inside"))


def balance_cost(df: DataFrame, n: int, order: list, cost: Column, name: str = "bucket", stored: bool = False) -> DataFrame:
    """Contiguous buckets 0..n-1 in the given order of about equal cost; a key of many rows is cut like any other.

    A row belongs to the bucket in which its cost begins, so a bucket outweighs its share by less than one row. Costs must not
    be negative; where all are 0, everything is in bucket 0.
    """
    rows = with_running_cost(df, order, cost, stored)
    share = F.least(F.floor(F.col("_before") * n / F.greatest(F.col("_all"), F.lit(1))), F.lit(n - 1)).cast("int")
    return rows.withColumn(name, share).drop("_row", "_cost", "_before", "_all", "_part", "_local")


def order_key(order: str) -> Column:
    """What consecutive rows of a sorted file are compared by."""
    if order == "coordinate":
        return F.struct(F.when(F.col("ref_idx") == -1, 1).otherwise(0).alias("unplaced"),
                        F.when(F.col("ref_idx") == -1, 0).otherwise(F.col("ref_idx")).alias("ref"),
                        F.when(F.col("ref_idx") == -1, 0).otherwise(F.col("pos")).alias("pos"))
    if order == "queryname":
        return F.struct(F.col("qname"))
    raise ValueError(f"unknown order {order!r}")


def _key_text(key: Column, order: str) -> Column:
    if order == "queryname":
        return key["qname"]
    return F.when(key["unplaced"] == 1, F.lit("*")).otherwise(
        F.concat_ws(":", key["ref"].cast("string"), key["pos"].cast("string")))


def sort_violations(df: DataFrame, order: str = "coordinate", position: str = "ord", run: int = RUN) -> DataFrame:
    """Rows whose predecessor in file order sorts after them: (ord, prev_key, key).

    The file is cut into runs of ``run`` rows; the last row of each run is copied into the next.
    """
    ord_ = F.col("ord")
    home = F.floor(ord_ / F.lit(run))
    runs = F.when((ord_ + 1) % run == 0, F.array(home, home + 1)).otherwise(F.array(home))
    keyed = df.select(F.col(position).alias("ord"), order_key(order).alias("_key"))
    spread = keyed.withColumn("_run", F.explode(runs))
    prev = F.lag("_key").over(Window.partitionBy("_run").orderBy("ord"))
    return (
        spread.withColumn("_prev", prev)
        .filter((F.col("_prev") > F.col("_key")) & (home == F.col("_run")))
        .select("ord", _key_text(F.col("_prev"), order).alias("prev_key"), _key_text(F.col("_key"), order).alias("key"))
    )


def zip_by_position(a: DataFrame, b: DataFrame, lines: int = 4) -> DataFrame:
    """Interleave two files of (ord, value) lines record by record: (rec_id, source, line_no, value).

    Sort the result by its first three columns to get the interleaved file.
    """
    part = lambda df, source: df.select(
        F.floor(F.col("ord") / F.lit(lines)).alias("rec_id"), F.lit(source).alias("source"),
        (F.col("ord") % lines).cast("int").alias("line_no"), "value")
    return union_all(part(a, 1), part(b, 2))


def fastq_order(lines: DataFrame) -> DataFrame:
    return lines.orderBy("rec_id", "source", "line_no")
