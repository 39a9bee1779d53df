"""Sliding-window trend counts. Each function takes a batch or a streaming DataFrame alike.

Windows are in event time. On a stream a row later than ``delay`` behind the newest one may be
dropped, if its window is already closed; ``ts`` must be a timestamp (see ``event_time``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

CHUNK = 4096  # slides per window partition in rolling_counts


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Timestamps without a zone cannot carry a watermark: read them in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_messages(spark: SparkSession, path: str, schema, files_per_trigger: int = 1, name_filter: str = "*") -> DataFrame:
    """Message stream from the parquet files of a folder as they appear."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return event_time(reader.option("pathGlobFilter", name_filter).parquet(path))


def filter_reshares(messages: DataFrame) -> DataFrame:
    return messages.filter("is_retweet").select("ts", "text")


def extract_hashtags(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per word starting with ``#``; words are separated by single spaces."""
    words = df.withColumn("tag", F.explode(F.split(text, " ")))
    return words.filter(F.col("tag").startswith("#")).drop(text)


def _flat(counts: DataFrame, key: str) -> DataFrame:
    return counts.select(F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"), key, "cnt")


def sliding_counts(df: DataFrame, width: str, slide: str, key: str = "text", delay: str = "0 seconds") -> DataFrame:
    """Rows per key in every window of ``width`` that starts on a multiple of ``slide``."""
    counted = (event_time(df).withWatermark("ts", delay).groupBy(F.window("ts", width, slide).alias("w"), key)
               .agg(F.count(F.lit(1)).alias("cnt")))
    return _flat(counted, key)


def sliding_reduce(df: DataFrame, width: str, slide: str, key: str = "text", delay: str = "0 seconds") -> DataFrame:
    """As ``sliding_counts`` for widths of many slides: count per slide first, then add the slides up.

    A row is counted once instead of once per window it falls in. ``width`` must be a multiple of ``slide``.
    """
    slides = (event_time(df).withWatermark("ts", delay).groupBy(F.window("ts", slide).alias("s"), key)
              .agg(F.count(F.lit(1)).alias("_n")))
    counted = (slides.groupBy(F.window(F.window_time("s"), width, slide).alias("w"), key)
               .agg(F.sum("_n").alias("cnt")))
    return _flat(counted, key)


def rolling_counts(df: DataFrame, slide: int, width: int, key: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Batch only: (win_end, key, n) at the end of every slide a key is active in; seconds.

    Rows are counted per slide; a frame then covers the last width / slide slides. Frames run in chunks of
    ``chunk`` slides per key, each with a copy of the slides that reach into it from before.
    """
    span = width // slide
    index = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(slide * 1_000_000))
    slides = df.groupBy(key, index.alias("_slide")).agg(F.count(F.lit(1)).alias("_n"))
    home = F.floor(F.col("_slide") / F.lit(chunk))
    copies = F.sequence(home, F.floor((F.col("_slide") + span - 1) / F.lit(chunk)))
    spread = slides.withColumn("_chunk", F.explode(copies))
    frame = Window.partitionBy(key, "_chunk").orderBy("_slide").rangeBetween(-(span - 1), 0)
    return (spread.withColumn("n", F.sum("_n").over(frame)).filter(F.col("_chunk") == home)
            .select(F.timestamp_seconds((F.col("_slide") + 1) * slide).alias("win_end"), key, "n"))


def topk_per_window(counts: DataFrame, k: int = 5, key: str = "text") -> DataFrame:
    """Batch only: the k most frequent keys of each window, ties by key.

    The rank limit is applied in every task before the shuffle, so a window ships k rows per task.
    """
    rank = F.row_number().over(Window.partitionBy("win_start").orderBy(F.desc("cnt"), F.asc(key)))
    return counts.withColumn("rnk", rank).filter(F.col("rnk") <= k).select("win_start", key, "cnt", "rnk")


def hashtag_trends(df: DataFrame, width: str = "5 minutes", slide: str = "1 second", k: int = 10) -> DataFrame:
    """Batch only: the k most frequent hashtags of each window."""
    return topk_per_window(sliding_reduce(extract_hashtags(df), width, slide, "tag"), k, "tag")


RING = "ring array<struct<slide:bigint,n:bigint>>, total bigint"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # the store that user state needs


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).first()[0]


class _Ring(StatefulProcessor):
    """One count per slide and their sum for a key: new rows are added, and a timer takes off the slide that leaves.

    The state of a key is one row of at most width / slide counts, with one timer for its oldest slide.
    """

    def __init__(self, slides: int, slide_us: int):
        self.slides, self.slide_us = slides, slide_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", "slides array<long>, counts array<long>, total long")

    def _read(self) -> tuple[dict[int, int], int]:
        known = self.state.get()
        return ({}, 0) if known is None else (dict(zip(known[0], known[1])), known[2])

    def _save(self, key, ring: dict[int, int], total: int):
        if ring:
            own = sorted(ring)
            self.state.update((own, [ring[s] for s in own], total))
            self.handle.registerTimer(self._leaves(own[0]))
        else:
            self.state.clear()
        return Row(key=key[0], ring=[Row(slide=s, n=ring[s]) for s in sorted(ring)], total=total)

    def _leaves(self, slide: int) -> int:
        """The watermark, in ms, is the newest time less the width: a slide has left once the watermark reaches its start."""
        return slide * self.slide_us // 1000

    def handleInputRows(self, key, rows, timerValues):
        ring, total = self._read()
        for row in rows:
            ring[row.slide] = ring.get(row.slide, 0) + row.n
            total += row.n
        newest = max(ring)
        for slide in [s for s in ring if s <= newest - self.slides]:
            total -= ring.pop(slide)
        yield self._save(key, ring, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ring, total = self._read()
        for slide in [s for s in ring if self._leaves(s) <= expiredTimerInfo.getExpiryTimeInMs()]:
            total -= ring.pop(slide)
        yield self._save(key, ring, total)

    def close(self) -> None:
        pass


def stream_rings(df: DataFrame, width: str, slide: str, key: str = "text") -> DataFrame:
    """Streams only: (key, ring, total) of every key a trigger changes, for the ``width`` / ``slide`` slides up to its newest.

    The invertible form of a sliding count: a row is added once and taken off once with its slide, whatever the
    width. Rows of a key and slide are added up per Arrow batch before they are shuffled, so a hot key costs its task a few rows a batch.
    Rows older than ``width`` behind the newest one of earlier triggers are dropped; they are in no window to come.
    A key whose last slide has left comes out once more with an empty ring, and its state is gone.
    """
    spark = df.sparkSession
    width_us, slide_us = _micros(spark, width), _micros(spark, slide)
    if width_us % slide_us or slide_us % 1000:
        raise ValueError("the width must be a multiple of the slide, and the slide of a millisecond")

    def add_up(frames):
        for frame in frames:
            yield frame.groupby(["key", "slide"], dropna=False, as_index=False, sort=False).agg(
                n=("ts", "size"), ts=("ts", "max"))

    rows = event_time(df).filter(F.col("ts").isNotNull()).select(
        F.col(key).alias("key"), F.floor(F.unix_micros("ts") / F.lit(slide_us)).alias("slide"), "ts")
    kind = rows.schema["key"].dataType.simpleString()
    added = rows.mapInPandas(add_up, f"key {kind}, slide long, n long, ts timestamp")
    ring = _Ring(width_us // slide_us, slide_us)
    out = added.withWatermark("ts", f"{width_us // 1000} milliseconds").groupBy("key").transformWithState(
        ring, f"key {kind}, {RING}", "Update", "EventTime")
    return out.withColumnRenamed("key", key)


def current_window(rings: DataFrame, width_us: int, slide_us: int, key: str = "text") -> DataFrame:
    """(win_start, win_end, key, cnt) of the window that ends with the newest slide of any key.

    Slides that have left by then, but whose timers are still to come, are taken off here.
    """
    newest = rings.agg(F.max(F.array_max(F.transform("ring", lambda r: r["slide"])))).first()[0] or 0
    gone = F.filter("ring", lambda r: r["slide"] <= newest - width_us // slide_us)
    cnt = F.col("total") - F.aggregate(gone, F.lit(0).cast("long"), lambda n, r: n + r["n"])
    end = F.lit((newest + 1) * slide_us)
    return rings.select(F.timestamp_micros(end - width_us).alias("win_start"), F.timestamp_micros(end).alias("win_end"),
                        key, cnt.alias("cnt")).filter("cnt > 0")


def stream_topk_sink(rings: DataFrame, k: int | None, path: str, checkpoint: str, width: str, slide: str,
                     key: str = "text") -> StreamingQuery:
    """Per trigger: the k most frequent keys (all, if None) of the window just past, as parquet under batch_id=...

    ``rings`` is a stream of ``stream_rings``. The window has ``width`` and ends with the slide of the newest row so
    far. A trigger hands over the rings that changed only; those of the other keys are kept beside ``path``, in two folders that take
    turns, so every trigger reads what the one before it left. What is kept are the keys of one window. A replayed
    trigger overwrites itself.
    """
    spark, kept = rings.sparkSession, f"{path.rstrip('/')}-rings"
    width_us, slide_us = _micros(spark, width), _micros(spark, slide)

    def top(batch: DataFrame, batch_id: int) -> None:
        read = batch.sparkSession.read.schema(batch.schema).parquet
        batch.write.mode("overwrite").parquet(f"{kept}/changed")  # one pass over the stateful query
        changed = read(f"{kept}/changed")
        # a key can change twice in a trigger, by new rows and then by its timer, which leaves the lesser sum
        last = changed.groupBy(key).agg(F.min_by(F.struct("ring", "total"), F.size("ring")).alias("_r")).select(key, "_r.ring", "_r.total")
        known = last
        if batch_id:
            before = read(f"{kept}/{(batch_id - 1) % 2}")
            known = last.unionByName(before.join(last.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti"))
        known.filter(F.size("ring") > 0).write.mode("overwrite").parquet(f"{kept}/{batch_id % 2}")
        if not changed.isEmpty():
            window = current_window(read(f"{kept}/{batch_id % 2}"), width_us, slide_us, key)
            end = F.timestamp_micros(F.unix_micros("win_start") + width_us)
            ranked = window if k is None else topk_per_window(window, k, key).withColumn("win_end", end)
            ranked.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)  # the query keeps what holds at its start
    try:
        return (rings.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).foreachBatch(top).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def stream_hashtag_trends(df: DataFrame, path: str, checkpoint: str, width: str = "5 minutes", slide: str = "1 second",
                          k: int = 10) -> StreamingQuery:
    """On a stream: per trigger the k most frequent hashtags of the window just past."""
    return stream_topk_sink(stream_rings(extract_hashtags(df), width, slide, "tag"), k, path, checkpoint, width, slide, "tag")


def stream_counts_sink(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Per trigger: the counts that changed, as parquet under batch_id=... A replayed batch overwrites itself."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(save).start())


def latest_counts(spark: SparkSession, path: str, key: str = "text") -> DataFrame:
    """The last value of every (window, key) written by ``stream_counts_sink``."""
    return (spark.read.parquet(path).groupBy("win_start", "win_end", key)
            .agg(F.max_by("cnt", "batch_id").alias("cnt")))
