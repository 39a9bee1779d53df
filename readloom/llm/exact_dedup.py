"""Exact duplicates by a compressed fingerprint exchange with byte verification.

1. Every partition of the documents hashes its normalised texts. The fingerprints are just wide enough for the
   number of rows, so that few differ by chance only.
2. It sorts its distinct fingerprints, cuts them by owner (ranges of the fingerprint) and sends each owner
   the gaps between them, Golomb-Rice coded.
3. An owner merges what it gets and answers each sender with a bitmap: fingerprint seen elsewhere or not.
4. Only rows whose fingerprint is marked, or repeats inside their own partition, shuffle their texts; these are
   grouped by the bytes of the text.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fresh, row_key, sieve, sieved, text_of, tidy, without_ids
from readloom.operators.skew import sliced_join
from readloom.session import cut_lineage

SPARE_BITS = 12         # a text without a copy is verified in vain with a chance of about 2^-12
OWNER_HASHES = 1 << 22  # fingerprints per owner, 32 MB when decoded
HOT_COPIES = 1 << 17    # copies of one text after which the look-up of their group is split

_MESSAGE = "owner long, sender long, n long, shift int, quotients binary, remainders binary, repeated binary"
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null is empty; each run of blanks, tabs and line ends becomes one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")


def golomb_encode(ordered: np.ndarray, base: int, span: int) -> tuple[int, bytes, bytes]:
    """Gaps of ascending distinct numbers from ``base``: unary quotients and fixed-width remainders."""
    gaps = np.diff(ordered, prepend=np.uint64(base)).astype(np.uint64)
    shift = max(0, int(math.log2(max(1.0, span / max(1, len(ordered))))))
    ends = np.cumsum((gaps >> np.uint64(shift)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    places = np.arange(shift, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return shift, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, base: int, shift: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(shift)
    rest = np.unpackbits(np.frombuffer(remainders, np.uint8))[:n * shift].reshape(n, shift).astype(np.uint64)
    gaps |= (rest << np.arange(shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(base)


def _messages(owners: int, bits: int):
    """Per partition: one message to every owner that it has fingerprints for."""
    width = -(-(1 << bits) // owners)

    def send(batches):
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        sender = int(got[0][0][0])
        prints, copies = np.unique(np.concatenate([x[1] for x in got]).astype(np.uint64), return_counts=True)
        cuts = np.searchsorted(prints, np.arange(1, owners, dtype=np.uint64) * np.uint64(width))
        out = []
        for owner, (own, many) in enumerate(zip(np.split(prints, cuts), np.split(copies > 1, cuts))):
            if len(own):
                coded = golomb_encode(own, owner * width, width)
                out.append((owner, sender, len(own), *coded, np.packbits(many).tobytes()))
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(out, columns=["owner", "sender", "n", "shift", "quotients", "remainders", "repeated"]),
            schema=pa.schema([("owner", pa.int64()), ("sender", pa.int64()), ("n", pa.int64()), ("shift", pa.int32()),
                              ("quotients", pa.binary()), ("remainders", pa.binary()), ("repeated", pa.binary())]))
    return send


def _answers(owners: int, bits: int):
    """Per owner: a bitmap for every message, set where the fingerprint has more than one row."""
    width = -(-(1 << bits) // owners)

    def answer(messages: pd.DataFrame) -> pd.DataFrame:
        base = int(messages["owner"].iloc[0]) * width
        sent = [golomb_decode(m.n, base, m.shift, m.quotients, m.remainders) for m in messages.itertuples()]
        alone = [np.unpackbits(np.frombuffer(m.repeated, np.uint8))[:m.n] for m in messages.itertuples()]
        found, at, n = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        marked = ((n[at] > 1) | (np.concatenate(alone) > 0)).astype(np.uint8)
        parts = np.split(marked, np.cumsum([len(x) for x in sent])[:-1])
        return pd.DataFrame({"owner": messages["owner"], "sender": messages["sender"],
                             "bitmap": [np.packbits(x).tobytes() for x in parts]})
    return answer


def _suspects(owners: int, bits: int):
    """Per sender: the rows whose fingerprint the bitmaps mark; their order is that of the messages."""
    width = -(-(1 << bits) // owners)

    def pick(prints: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        own, at = np.unique(prints["print"].to_numpy().astype(np.uint64), return_inverse=True)
        edges = np.searchsorted(own, np.arange(owners + 1, dtype=np.uint64) * np.uint64(width))
        marked = np.zeros(len(own), bool)
        for owner, bitmap in zip(bitmaps["owner"], bitmaps["bitmap"]):
            low, high = edges[owner], edges[owner + 1] if owner + 1 < owners else len(own)
            marked[low:high] = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:high - low] > 0
        return prints.loc[marked[at], ["id"]]
    return pick


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; the smallest id of a group stays. A null text is
    empty, and all empty texts are one group. Null ids are no smaller than any other: a group of them alone
    has a null keep_id and keeps all its rows. Rows that repeat an id are counted each and share its verdict.
    No rows give no rows; other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    rows = docs.count()
    bits = min(62, max(16, math.ceil(math.log2(rows + 1)) + SPARE_BITS))
    owners = max(docs.sparkSession.sparkContext.defaultParallelism, -(-rows // OWNER_HASHES))
    prints = cut_lineage(docs.select(
        "id", F.spark_partition_id().cast("long").alias("sender"),
        F.shiftrightunsigned(F.xxhash64("norm"), 64 - bits).alias("print"), F.sha2("norm", 256).alias("sha")))

    messages = prints.select("sender", "print").mapInArrow(tidy(_messages(owners, bits)), _MESSAGE)
    bitmaps = messages.groupBy("owner").applyInPandas(_answers(owners, bits), "owner long, sender long, bitmap binary")
    suspects = cut_lineage(
        prints.select("id", "sender", "print").groupBy("sender")
        .cogroup(bitmaps.groupBy("sender"))
        .applyInPandas(_suspects(owners, bits), docs.select("id").schema).distinct())

    texts = (sieved(docs, sieve(suspects, "id"), "id").filter("__hit")
             .join(suspects.select(F.col("id").alias("__s")), F.col("id").eqNullSafe(F.col("__s")), "left_semi"))
    groups = (texts.groupBy("norm").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .filter("group_size > 1")
              .select(F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    out = sliced_join(prints.select("id", "sha"), cut_lineage(groups), ["sha"], "left", HOT_COPIES)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return (out.withColumn("keep_id", keep)
            .select(F.col("id").alias("doc_id"), "keep_id", F.coalesce("group_size", F.lit(1)).alias("group_size"),
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of equal texts, all columns as they were.

    Rows that repeat an id or have none are judged by their own text; of rows alike in id and text one stays.
    """
    own, key = docs.columns, fresh(docs, "__key")
    verdict = cut_lineage(exact_duplicates(docs, id_col, text_col).filter("group_size > 1")
                          .select(row_key(F.col("doc_id"), F.col("text_sha256")).alias(key), "kept"))
    alike = verdict.filter("kept").groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    keyed = docs.withColumn(key, row_key(F.col(id_col), F.sha2(normalised(F.col(text_col)), 256)))
    flag = fresh(keyed, "__hit")
    one = (sieved(keyed, sieve(alike, key), key, flag).filter(flag).join(alike, key, "left_semi").groupBy(key)
           .agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row")).select("row.*"))
    gone = verdict.filter(~F.col("kept")).select(key).unionByName(alike)
    return without_ids(keyed, gone, key).drop(key).unionByName(one)
