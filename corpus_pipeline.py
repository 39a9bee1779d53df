"""The corpus pipeline: each stage reads what the one before it kept and returns the columns of ``documents``.

The driver of a run writes every stage's rows as Parquet and reads them again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from readloom.llm import bpe, decontam, exact_dedup, langid, simhash
from readloom.llm.common import fold_of, table, without_rows
from readloom.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A letter filter: documents without a letter (``und``) go, or all where there is nothing to learn from.

    The predictions and scores of the machines decide nothing.
    """
    model = langid.train(docs.filter(fold_of("doc_id", 3) != 1))
    return without_rows(docs, lambda rows: langid.predict(rows, model).filter(~langid.accepted()))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash (three words, two bits) the document with the smallest id stays."""
    return simhash.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go; all others stay as they are."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with the digests of ids and decoded bytes."""
    return bpe.round_trip(docs, kept=KEPT_PIECES)


BATCH_ROWS = 400       # rows a worker is sent at once: a batch of documents is held several times, by JVM and worker
KEPT_PIECES = 1 << 16  # pieces a worker of the last stage knows: fewer than on its own, beside what earlier stages left


def _steady(stage):
    """``stage`` with batches of bounded rows, so that the memory of an executor does not follow the size of documents."""
    def steady(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return steady


STAGES = [(name, _steady(stage)) for name, stage in (
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("decontamination", clean_of_benchmark),
    ("byte_bpe", encode),
)]

# The language model and the merges of BPE are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
