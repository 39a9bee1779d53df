"""Small helpers the text operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIEVE_WORD_BITS = 17  # a sieve has at most 2^17 rows of one 64-bit word: 2 MB, whatever the data


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold_of(name: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def _word(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << SIEVE_WORD_BITS) - 1)


def _bit(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), SIEVE_WORD_BITS).bitwiseAND(63).cast("int")


def _shift(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)


def sieve(keys: DataFrame, name: str) -> DataFrame:
    """A bitmap of hashed keys, of fixed size. It lets every key of ``keys`` pass and few others."""
    return (keys.select(_word(F.col(name)).alias("__word"), _shift(_bit(F.col(name))).alias("__bits"))
            .groupBy("__word").agg(F.bit_or("__bits").alias("__bits")))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def sieved(rows: DataFrame, bitmap: DataFrame, name: str, flag: str = "__hit") -> DataFrame:
    """Marks the rows whose key may be in the sieve. The broadcast is bounded by the sieve's fixed size."""
    word, bits = fresh(rows, "__sieve_word"), fresh(rows, "__sieve_bits")
    hit = F.coalesce(F.col(bits).bitwiseAND(_shift(_bit(F.col(name)))) != 0, F.lit(False))
    bitmap = bitmap.select(F.col("__word").alias(word), F.col("__bits").alias(bits))
    return (rows.withColumn(word, _word(F.col(name))).join(F.broadcast(bitmap), word, "left")
            .withColumn(flag, hit).drop(word, bits))


def without_ids(docs: DataFrame, dropped: DataFrame, name: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped``; texts that the sieve lets pass are never shuffled.

    The sieve only decides which rows take the exact anti join, so the result does not depend on its
    size. Rows with a null id stay; columns of any name pass through.
    """
    flag, own = fresh(docs, "__hit"), fresh(docs, "__id")
    ids = dropped.select(F.col(name).alias(own)).distinct()
    marked = sieved(docs, sieve(ids, own), name, flag)
    suspects = marked.filter(flag).drop(flag)
    return (marked.filter(~F.col(flag)).drop(flag)
            .unionByName(suspects.join(ids, F.col(name) == F.col(own), "left_anti")))


def row_key(ident: Column, digest: Column) -> Column:
    """A key of the rows alike in id and text; it is never null and sorts by id, null ids last."""
    return F.struct(ident.isNull().alias("none"), ident.alias("id"), digest.alias("digest"))


def without_rows(docs: DataFrame, rejected: Callable[[DataFrame], DataFrame], name: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``rejected`` picks from doc_id and text, where doc_id is the key of a row.

    Rows that repeat an id or have none are judged by their own text.
    """
    key = fresh(docs, "__key")
    keyed = docs.withColumn(key, row_key(F.col(name), F.sha2(text_of(text), 256)))
    dropped = rejected(keyed.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    return without_ids(keyed, dropped.select(F.col("doc_id").alias(key)), key).drop(key)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which freed memory goes back to the system.

    Workers stay for later tasks and stages; what allocators keep of the memory of earlier ones adds up beside the JVM.
    """
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass
    return tidied
