"""Removes every byte covered by a long string that also starts elsewhere, by suffix arrays of shards.

1. Of the hashes of all 32-byte grams inside a window of the wanted length, the least marks the window's anchor. Equal
   windows have equal anchors, and every window has one, so windows fall into contexts: runs of
   starts with the same anchor, with the bytes they reach over.
2. Anchor hashes that occur once only are left out: hashes are counted, and a bitmap of fixed size lets pass
   those that occur again, and a few others.
3. Contexts go to the shard of their anchor hash, each different one once. A shard sorts their suffixes by induced
   sorting: suffixes are classified, leftmost-smaller (LMS) substrings are sorted and named, the string of names is
   sorted in turn, and all others are induced from left to right and right to left, bucket by bucket. Common
   prefixes with the predecessor, listed in text order, mark the windows that occur again.
4. Spans go back to the texts that hold the context. Equal texts are one text throughout.

An anchor hash with very many different contexts would make one shard large; its windows are
compared by 128-bit digests instead, counted map-side.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import sieve, sieved, text_of, tidy
from readloom.operators.skew import hot_keys, sliced_join
from readloom.session import cut_lineage, scratch_dir

LENGTH = 200                # bytes of a string that counts
GRAM = 32
BITMAP_BITS = 26            # 8 MB, sent to every executor
SHARD_BYTES = 4 << 20
HOT_CONTEXTS = 1 << 15      # different contexts of one anchor hash after which it leaves the shards
HOT_ROWS = 1 << 17          # rows of one text or context after which a look-up is split
_SLICE = 1 << 22            # windows of a text handled at once
_PLACE = np.uint64((1 << 23) - 1)
_MULTIPLIERS = [np.uint64(x | 1) for x in np.random.default_rng(7).integers(1 << 63, size=6, dtype=np.uint64).tolist()]
_BYTE = np.random.default_rng(8).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchors(data: np.ndarray, length: int = LENGTH):
    """(first start, last start, hash) of the contexts of a text: every start of a window is in exactly one."""
    out = []
    for at in range(0, len(data) - length + 1, _SLICE):
        part = data[at:at + _SLICE + length - 1]
        hashes, k = _BYTE[part], 1
        for multiplier in _MULTIPLIERS[:GRAM.bit_length() - 1]:
            hashes = hashes[:-k] * multiplier + hashes[k:]
            k *= 2
        hashes ^= hashes >> np.uint64(31)
        hashes *= _MULTIPLIERS[5]
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)  # the leftmost of equal ones
        span, k = length - GRAM + 1, 1
        while 2 * k <= span:
            least = np.minimum(least[:-k], least[k:])
            k *= 2
        if k < span:
            least = np.minimum(least[:k - span], least[span - k:])
        place = least & _PLACE
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        out.append((first + at, last + at, hashes[place[first]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _types(symbols: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the smallest and unique."""
    change = np.flatnonzero(symbols[:-1] != symbols[1:])
    smaller = symbols[change] < symbols[change + 1]
    return np.append(np.repeat(smaller, np.diff(np.concatenate([[-1], change]))), True)


def _deal(buckets: list[list[np.ndarray]], places: np.ndarray, symbols: np.ndarray) -> None:
    """Appends places to the buckets of their symbols, in the order given."""
    if len(places):
        order = np.argsort(symbols, kind="stable")
        places, symbols = places[order], symbols[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        for c, own in zip(symbols[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
            buckets[c].append(own)


def _induce(symbols: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order; a bucket is handled in waves of whole arrays."""
    size, none = int(symbols.max()) + 1, np.zeros(0, np.int64)
    left: list[list[np.ndarray]] = [[] for _ in range(size)]
    right: list[list[np.ndarray]] = [[] for _ in range(size)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(seeds, lms, symbols[lms])

    def step(wave: np.ndarray, want_small: bool) -> tuple[np.ndarray, np.ndarray]:
        before = wave[wave > 0] - 1
        before = before[small[before] == want_small]
        return before, symbols[before]

    for c in range(size):
        waves, wave = [], np.concatenate(left[c]) if left[c] else none
        while len(wave):
            waves.append(wave)
            before, key = step(wave, False)
            _deal(left, before[key > c], key[key > c])
            wave = before[key == c]
        left[c] = waves
        if seeds[c]:
            _deal(left, *step(np.concatenate(seeds[c]), False))
    right[0] = [np.array([len(symbols) - 1])]
    for c in reversed(range(size)):
        waves, wave = [], np.concatenate(right[c]) if right[c] else none
        while len(wave):
            waves.append(wave)
            before, key = step(wave, True)
            _deal(right, before[key < c], key[key < c])
            wave = before[key == c]
        right[c] = waves
        if left[c]:
            _deal(right, *step(np.concatenate(left[c])[::-1], True))
    parts = []
    for c in range(size):
        parts += left[c]
        if right[c]:
            parts.append(np.concatenate(right[c])[::-1])
    return np.concatenate(parts)


def _names(symbols: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of LMS substrings given in order; equal ones share a rank."""
    a, b = order[:-1], order[1:]
    same = ends[a] - a == ends[b] - b
    live, k = np.flatnonzero(same), 0
    while len(live):
        equal = symbols[a[live] + k] == symbols[b[live] + k]
        same[live[~equal]] = False
        live = live[equal]
        k += 1
        live = live[a[live] + k <= ends[a[live]]]
    return np.concatenate([[0], np.cumsum(~same)])


def suffix_array(symbols: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes sorted by at least ``depth`` symbols; ``symbols`` ends in a 0 that occurs nowhere else.

    The string of LMS names has too many symbols for bucket-wise passes, so it is sorted by doubling: each
    round names pairs of neighbouring names and so sorts twice as many LMS substrings.
    """
    small = _types(symbols)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sorted_once = _induce(symbols, small, lms)
    is_lms = np.zeros(len(symbols), bool)
    is_lms[lms] = True
    order = sorted_once[is_lms[sorted_once]]
    ends = np.zeros(len(symbols), np.int64)
    ends[lms] = np.append(lms[1:], len(symbols) - 1)
    rank = np.zeros(len(symbols), np.int64)
    rank[order] = _names(symbols, order, ends)
    rank, covered = rank[lms], 1  # now in the order of the text
    while len(lms) > 1 and rank.max() < len(lms) - 1 and 2 * covered < 2 * depth:
        later = np.zeros(len(rank), np.int64)
        later[:max(0, len(rank) - covered)] = rank[covered:] + 1
        pair = rank * (len(rank) + 1) + later
        at = np.argsort(pair, kind="stable")
        rank[at] = np.concatenate([[0], np.cumsum(np.diff(pair[at]) != 0)])
        covered *= 2
    return _induce(symbols, small, lms[np.argsort(rank, kind="stable")])


def repeated_starts(data: np.ndarray, valid: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the valid starts of ``data`` have the ``length`` bytes of another valid start."""
    order = suffix_array(np.append(data.astype(np.uint16) + 1, np.uint16(0)), length)
    order = order[np.append(valid, False)[order]]
    prefix = np.zeros(len(data), np.int32)  # common with the predecessor, up to ``length``, in the order of the text
    words = np.ndarray(max(0, len(data) - 7), np.uint64, np.ascontiguousarray(data).data, strides=(1,))
    a, b = order[:-1], order[1:]
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        equal = words[a + k] == words[b + k]
        a, b = a[equal], b[equal]
        prefix[b] = k + 8
    found = prefix >= length
    found[order[:-1][found[order[1:]]]] = True
    return found


def _spans(hit: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows whose starts are hit."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    return [(int(a), int(b) - 1 + length) for a, b in edges.reshape(-1, 2)]


_SPAN_TYPE = "array<struct<a:bigint,b:bigint>>"


def _shard(length: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part[part.duplicated("anchor", keep=False)]
        if part.empty:
            return pd.DataFrame({"ctx": [], "spans": []}, dtype=object)
        part = part.sort_values("ctx")
        data = np.frombuffer(b"".join(part["bytes"]), np.uint8)
        sizes = part["bytes"].str.len().to_numpy()
        starts = np.cumsum(sizes) - sizes
        offset = np.arange(len(data)) - np.repeat(starts, sizes)
        hit = repeated_starts(data, offset <= np.repeat(sizes - length, sizes), length)
        some = np.add.reduceat(hit, starts) > 0
        return pd.DataFrame([(c, [{"a": a, "b": b} for a, b in _spans(hit[s:s + n - length + 1], length)])
                             for c, s, n in zip(part["ctx"][some], starts[some], sizes[some])], columns=["ctx", "spans"])
    return run


def _windows_of_hot(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of contexts whose anchor hash has left the shards: windows are compared by digests, counted map-side."""
    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                data, ctx = batch.column(1)[k].as_py(), batch.column(0)[k].as_py()
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([ctx] * n, pa.binary()), pa.array(range(n), pa.int64()),
                    pa.array([hashlib.blake2b(data[i:i + length], digest_size=16).digest() for i in range(n)], pa.binary())],
                    ["ctx", "at", "window"])

    windows = contexts.select("ctx", "bytes").mapInArrow(cut, "ctx binary, at long, window binary")
    again = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window")
    found = sliced_join(windows, cut_lineage(again), ["window"], "left_semi", HOT_ROWS)
    return found.groupBy("ctx").agg(F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + length).alias("b"))).alias("spans"))


def _strip(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                mark = np.zeros(len(data) + 1, np.int64)
                for span in spans.as_py():
                    mark[span["a"]] += 1
                    mark[span["b"]] -= 1
                hit = np.cumsum(mark)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~hit].tobytes()
                runs = np.count_nonzero(np.diff(np.concatenate([[False], hit]).astype(np.int8)) == 1)
                out.append((int(hit.sum()), int(runs), kept))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.binary())], ["sha", "n_removed", "n_spans", "kept"])
    return run


def _digest(sha):
    return F.substring(F.unhex(sha), 1, 16)


def _anchor_counts(texts: DataFrame, length: int) -> DataFrame:
    """Anchor hashes with more than one place; a place in copies of one text counts once."""
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                found, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
                for text in batch.column(0).slice(k, 256):
                    data = text.as_py().encode()
                    if len(data) >= length:
                        first, _, hashes = anchors(np.frombuffer(data, np.uint8), length)
                        own = np.uint64(int.from_bytes(hashlib.sha256(data).digest()[:8], "little"))
                        found.append(hashes)
                        places.append((own + first.astype(np.uint64)) * _MULTIPLIERS[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (found, places)],
                                                 ["anchor", "place"])

    return (texts.select("text").mapInArrow(tidy(run), "anchor long, place long")
            .groupBy("anchor").agg(F.min("place").alias("p"), F.max("place").alias("q")).filter("p <> q").select("anchor"))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes' low places; at most 2^20 words come to the driver, whatever the data."""
    low = F.col("anchor").bitwiseAND((1 << BITMAP_BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), low.bitwiseAND(63).cast("int"))
    words = hashes.groupBy(F.shiftright(low, 6).alias("w")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _contexts(texts: DataFrame, bitmap: np.ndarray, length: int) -> DataFrame:
    """Places of contexts whose hash passes the bitmap: ctx, anchor, digest, at; a task gives the bytes of each ctx once."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits, given = sent.value, set()
        for batch in batches:
            rows = []
            for text in batch.column(0):
                data = text.as_py().encode()
                if len(data) < length:
                    continue
                first, last, hashes = anchors(np.frombuffer(data, np.uint8), length)
                low = hashes & np.uint64((1 << BITMAP_BITS) - 1)
                digest = hashlib.sha256(data).digest()[:16]
                for k in np.flatnonzero(bits[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).tolist():
                    own = data[first[k]:last[k] + length]
                    ctx = hashlib.blake2b(own, digest_size=16).digest()
                    new = ctx not in given
                    if new:
                        if len(given) >= 1 << 18:
                            given.clear()
                        given.add(ctx)
                    rows.append((ctx, int(hashes[k].view(np.int64)), digest, int(first[k]), own if new else None))
                if len(rows) >= 1 << 14:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return texts.select("text").mapInArrow(tidy(run), "ctx binary, anchor long, digest binary, at long, bytes binary")


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                                      ["ctx", "anchor", "digest", "at", "bytes"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """digest (16 bytes of the text's SHA-256) and spans of bytes covered by repeated strings, per different text.

    Copies of a whole text are not looked at here: they repeat all of it.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of(text_col).alias("text"))
    bitmap = _bitmap(_anchor_counts(texts, length))
    path = scratch_dir(spark, "contexts")
    _contexts(texts, bitmap, length).write.parquet(path)
    placed = spark.read.parquet(path)
    members = placed.select("ctx", "digest", "at").distinct()
    many = (placed.groupBy("ctx").agg(F.min(F.xxhash64("digest", "at")).alias("p"), F.max(F.xxhash64("digest", "at")).alias("q"))
            .filter("p <> q").select("ctx"))
    given = placed.filter("bytes is not null").select("ctx", "anchor", "bytes")
    sizes = cut_lineage(given.select("ctx", "anchor", F.octet_length("bytes").cast("long").alias("size")).distinct())
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // SHARD_BYTES))
    hot = cut_lineage(hot_keys(sizes, ["anchor"], HOT_CONTEXTS))
    marked = given.join(F.broadcast(hot), "anchor", "left")
    # Contexts that several tasks gave meet again in their shard, so that their bytes are shuffled once only.
    dealt = (marked.filter("_fan is null").withColumn("shard", F.pmod("anchor", F.lit(shards))).repartition(shards, "shard")
             .groupBy("shard", "ctx").agg(F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes")))
    found = dealt.groupBy("shard").applyInPandas(_shard(length), f"ctx binary, spans {_SPAN_TYPE}")
    leavers = marked.filter("_fan is not null").groupBy("ctx").agg(F.first("bytes").alias("bytes"))
    found = found.unionByName(_windows_of_hot(leavers, length))
    whole = sizes.join(many, "ctx").select("ctx", F.array(F.struct(
        F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))).alias("spans"))
    ctx_spans = cut_lineage(found.unionByName(whole).groupBy("ctx").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    placed_spans = sliced_join(members, ctx_spans, ["ctx"], "inner", HOT_ROWS)
    moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("at")).alias("a"), (s["b"] + F.col("at")).alias("b")))
    return placed_spans.select("digest", moved.alias("spans")).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def strip_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes).

    ``kept`` is null where it equals the text (nothing removed). Strings are judged on the input and never cross
    texts. A null text is empty. Of equal texts of ``length`` bytes or more nothing remains, repeated ids
    included; shorter texts stay whole. No rows give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    base = cut_lineage(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                   F.sha2("text", 256).alias("sha")))
    copies = base.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.first("n_bytes").alias("n_bytes"))
    copied = cut_lineage(copies.filter((F.col("n") > 1) & (F.col("n_bytes") >= length)).select("sha"))
    spans = cut_lineage(repeated_spans(rows, length))
    spans = spans.join(copied.select(_digest("sha").alias("digest")), "digest", "left_anti")
    touched = (sieved(rows.select("text").withColumn("sha", F.sha2("text", 256)).withColumn("digest", _digest("sha")),
                      sieve(spans, "digest"), "digest").filter("__hit")
               .join(spans, "digest").select("sha", "text", "spans"))
    stripped = touched.mapInArrow(tidy(_strip(length)), "sha string, n_removed long, n_spans long, kept binary")
    empty = F.lit("").cast("binary")
    gone = copied.select("sha", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         empty.alias("kept"))
    verdicts = cut_lineage(stripped.unionByName(gone))
    out = sliced_join(base, verdicts, ["sha"], "left", HOT_ROWS)
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes",
        F.when(F.col("n_spans").isNull(), none).otherwise(F.coalesce("n_removed", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256)).alias("kept_sha256"), "kept")
