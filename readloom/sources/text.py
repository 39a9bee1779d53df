"""Delimited blocks, positioned lines, FASTQ records and chunk files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.operators.skew import lookup_join
from readloom.session import cut_lineage

CHUNK_LINES = 1 << 21


def read_blocks(spark: SparkSession, path: str, sep: str = "\n\n", encoding: str = "UTF-8") -> DataFrame:
    """Records split on ``sep``: (value). Other encodings than UTF-8 are decoded from the raw bytes."""
    blocks = spark.read.option("lineSep", sep).text(path)
    if encoding.upper() != "UTF-8":
        blocks = blocks.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))
    return blocks


def positioned_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value): every line with its 0-based position; part files follow their numbers, others their paths.

    A file split is read in order by one task, so a line's position is its rank in the split plus the
    lines of the splits before it. Only the table of splits (one row per 128 MB or so) is ranked; the
    lines are neither sorted nor shuffled.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"))
    splits = cut_lineage(lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")))
    folder, part = F.regexp_replace("_file", "[^/]*$", ""), F.regexp_extract("_file", "/part-([0-9]+)[^/]*$", 1).try_cast("long")
    before = Window.orderBy(folder, part, "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (lookup_join(lines, starts, ["_file", "_block"], "inner")
            .select((F.col("_start") + F.col("_at") - F.col("_first")).alias("ord"), "value"))


def read_fastq(spark: SparkSession, path: str, mode: str = "STRICT") -> DataFrame:
    """Four lines per read: (rec_id, name, seq, plus, qual).

    The lines of a record nearly always share a task, which combines them before the shuffle. STRICT fails on a record that lacks
    lines or their marks, LENIENT adds the names of its faults as ``_errors``, SILENT does not look.
    """
    if mode not in ("STRICT", "LENIENT", "SILENT"):
        raise ValueError("mode must be STRICT, LENIENT or SILENT")
    lines = positioned_lines(spark, path)
    line = lambda n: F.max(F.when(F.col("ord") % 4 == n, F.col("value")))
    records = lines.groupBy(F.floor(F.col("ord") / 4).alias("rec_id")).agg(
        line(0).alias("_name"), line(1).alias("seq"), line(2).alias("plus"), line(3).alias("qual"), F.count(F.lit(1)).alias("_n"))
    columns = ["rec_id", F.regexp_replace("_name", "^@", "").alias("name"), "seq", "plus", "qual"]
    if mode == "SILENT":
        return records.select(*columns)
    faults = F.concat_ws(
        ",", F.when(F.col("_n") < 4, F.lit("TRUNCATED_RECORD")), F.when(~F.col("_name").startswith("@"), F.lit("NAME_WITHOUT_AT")),
        F.when(~F.col("plus").startswith("+"), F.lit("PLUS_MISSING")),
        F.when(F.length("qual") != F.length("seq"), F.lit("QUAL_LENGTH")))
    if mode == "LENIENT":
        errors = F.when(faults == "", F.array().cast("array<string>")).otherwise(F.split(faults, ","))
        return records.select(*columns, errors.alias("_errors"))
    stop = F.raise_error(F.concat(F.lit("bad FASTQ record "), F.col("rec_id").cast("string"), F.lit(" ("), faults, F.lit("): "), F.col("_name")))
    return records.filter(F.when(faults == "", F.lit(True)).otherwise(stop.cast("boolean"))).select(*columns)


def read_chunks(spark: SparkSession, glob: str) -> DataFrame:
    """(chunk, value): lines with the name of the chunk they come from, a file or the folder ``chunk=`` around it."""
    parts = F.split("_metadata.file_path", "/")
    folder = F.element_at(parts, -2)
    return spark.read.text(glob).select(
        F.when(folder.startswith("chunk="), folder).otherwise(F.element_at(parts, -1)).alias("chunk"), "value")


def write_chunks(lines: DataFrame, n: int, path: str) -> None:
    """``n`` chunks of (rec_id, source, line_no, value) lines in record order; no record is split.

    A chunk is a folder ``chunk=00000`` whose compressed part files follow each other, so that a task sorts ``CHUNK_LINES`` or so however
    long the chunk is.
    """
    fine = max(1, -(-lines.count() // (n * CHUNK_LINES)))
    chunk = F.lpad(F.floor(F.spark_partition_id() / fine).cast("string"), 5, "0")
    (lines.repartitionByRange(n * fine, "rec_id").withColumn("chunk", chunk)
     .sortWithinPartitions("chunk", "rec_id", "source", "line_no")
     .select("chunk", "value").write.partitionBy("chunk").option("compression", "gzip").text(path))


def write_report(report: DataFrame, path: str) -> None:
    """The (ord, label, value) report as ordered ``(label,value)`` lines."""
    ordered = report.orderBy("ord", "value")
    ordered.select(F.concat(F.lit("("), "label", F.lit(","), "value", F.lit(")")).alias("value")).write.text(path)
