"""Sliding-window trends on the event stream, as batch queries and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.plans.fixtures import fixture, table
from readloom.plans.registry import query
from readloom.session import scratch_dir
from readloom.streaming import trends as S

WIDTH, SLIDE = "6 hours", "3 hours"
TRIGGERS = 4
WHOLE_RANGE = "400 days"  # a delay under which no row of the table counts as late


def windows_sql(source: str, key: str, width: str = "6 HOUR", slide_s: int = 10800, n: int = 2) -> str:
    """Each row falls in the ``n`` windows starting at its slide and the slides before."""
    slide_us = slide_s * 1_000_000
    return f"""w AS (SELECT {key}, make_timestamp((epoch_us(ts) // {slide_us}::BIGINT - k) * {slide_us}::BIGINT) AS win_start
 FROM {source}, range(0, {n}) r(k)),
counts AS (SELECT win_start, win_start + INTERVAL {width} AS win_end, {key}, count(*) AS cnt FROM w GROUP BY ALL)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_messages")


RESHARES = "reshares AS (SELECT ts, text FROM f_messages WHERE is_retweet)"
TAGS = "tags AS (SELECT ts, user_id, tag FROM (SELECT ts, user_id, unnest(string_split(text, ' ')) AS tag FROM f_tagged) WHERE tag LIKE '#%')"


@query("pf1_filter_reshares", f"WITH {RESHARES} SELECT ts, text FROM reshares")
def filter_reshares(spark, sf_dir):
    return S.filter_reshares(messages(spark, sf_dir))


@query("pf2_extract_hashtags", f"WITH {TAGS} SELECT ts, user_id, tag FROM tags")
def extract_hashtags(spark, sf_dir):
    return S.extract_hashtags(fixture(spark, sf_dir, "f_tagged"))


@query("ss1_sliding_counts", f"WITH {RESHARES}, {windows_sql('reshares', 'text')} SELECT * FROM counts")
def sliding_counts(spark, sf_dir):
    return S.sliding_counts(S.filter_reshares(messages(spark, sf_dir)), WIDTH, SLIDE)


@query("ss2_sliding_reduce", f"WITH {windows_sql('f_messages', 'text', '1 HOUR', 60, 60)} SELECT * FROM counts")
def sliding_reduce(spark, sf_dir):
    return S.sliding_reduce(messages(spark, sf_dir), "1 hour", "1 minute")


@query("ss3_hashtag_trends", f"""
WITH {TAGS}, {windows_sql('tags', 'tag')},
r AS (SELECT win_start, tag, cnt, CAST(row_number() OVER (PARTITION BY win_start ORDER BY cnt DESC, tag) AS INT) AS rnk FROM counts)
SELECT * FROM r WHERE rnk <= 10""")
def hashtag_trends(spark, sf_dir):
    return S.hashtag_trends(fixture(spark, sf_dir, "f_tagged"), WIDTH, SLIDE, 10)


@query("sr1_topk_per_window", f"""
WITH {RESHARES}, {windows_sql('reshares', 'text')},
r AS (SELECT win_start, text, cnt, CAST(row_number() OVER (PARTITION BY win_start ORDER BY cnt DESC, text) AS INT) AS rnk FROM counts)
SELECT * FROM r WHERE rnk <= 3""")
def topk_per_window(spark, sf_dir):
    return S.topk_per_window(sliding_counts(spark, sf_dir), 3)


@query("wn5_rolling_counts", """
WITH s AS (SELECT text, epoch_us(ts) // 600000000 AS sl, count(*) AS c FROM f_messages GROUP BY ALL)
SELECT make_timestamp((sl + 1) * 600000000) AS win_end, text,
 CAST(sum(c) OVER (PARTITION BY text ORDER BY sl RANGE BETWEEN 17 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM s""")
def rolling_counts(spark, sf_dir):
    return S.rolling_counts(messages(spark, sf_dir), 600, 10800, chunk=500)


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.stream_messages(spark, sf_dir, table(spark, sf_dir, "events").schema, name_filter="events.parquet")
    return raw.select("ts", F.col("event_type").alias("text"), (F.col("value") >= 10).alias("is_retweet"))


def _finish(spark: SparkSession, counts: DataFrame) -> DataFrame:
    out = scratch_dir(spark, "counts")
    S.stream_counts_sink(counts, out, scratch_dir(spark, "offsets")).awaitTermination()
    return S.latest_counts(spark, out)


@query("io8_stream_messages", "SELECT event_type AS text, count(*) AS n FROM events GROUP BY 1")
def stream_messages(spark, sf_dir):
    out = scratch_dir(spark, "messages")
    stream = (_stream(spark, sf_dir).writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", scratch_dir(spark, "offsets")).trigger(availableNow=True).start())
    stream.awaitTermination()
    return spark.read.parquet(out).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query("ss1_sliding_counts_stream", f"WITH {RESHARES}, {windows_sql('reshares', 'text')} SELECT * FROM counts")
def sliding_counts_stream(spark, sf_dir):
    source = S.filter_reshares(_stream(spark, sf_dir))
    return _finish(spark, S.sliding_counts(source, WIDTH, SLIDE, delay=WHOLE_RANGE))


@query("ss2_sliding_reduce_stream", f"""
WITH {windows_sql('f_messages', 'text')}, last AS (SELECT max(ts) AS top FROM f_messages)
SELECT counts.* FROM counts, last WHERE win_end <= to_timestamp(floor(epoch(top) / 10800) * 10800)::TIMESTAMP""")
def sliding_reduce_stream(spark, sf_dir):
    """Two chained counts in append mode: exactly the windows the watermark has closed come out."""
    out = scratch_dir(spark, "counts")
    counts = S.sliding_reduce(_stream(spark, sf_dir), WIDTH, SLIDE)
    stream = (counts.writeStream.outputMode("append").format("parquet").option("path", out)
              .option("checkpointLocation", scratch_dir(spark, "offsets")).trigger(availableNow=True).start())
    stream.awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


def _newest(spark: SparkSession, out: str) -> DataFrame:
    """What the last trigger of a top-k sink wrote."""
    rows = spark.read.parquet(out)
    return rows.filter(F.col("batch_id") == rows.agg(F.max("batch_id")).first()[0]).drop("batch_id")


def _in_triggers(spark: SparkSession, sf_dir: str, start) -> None:
    """The events in time order, a quarter of their ids per trigger; the stream restarts in between."""
    events, path = table(spark, sf_dir, "events"), scratch_dir(spark, "events")
    ids = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    for k in range(TRIGGERS):
        quarter = F.floor(F.col("event_id") * TRIGGERS / F.lit(ids)) == k
        events.filter(quarter).write.mode("append").parquet(path)
        start(S.stream_messages(spark, path, events.schema, 1 << 20)).awaitTermination()


def _last_sql(source: str, key: str, n: int = 2, slide_s: int = 10800) -> str:
    """Counts of the window of ``n`` slides whose end is the end of the newest row's slide."""
    slide_us = slide_s * 1_000_000
    return f"""e AS (SELECT (max(epoch_us(ts)) // {slide_us} + 1) * {slide_us}::BIGINT AS win_end FROM {source}),
last AS (SELECT make_timestamp(e.win_end - {n * slide_us}::BIGINT) AS win_start, make_timestamp(e.win_end) AS win_end, {key}, count(*) AS cnt
 FROM {source}, e WHERE epoch_us(ts) >= e.win_end - {n * slide_us}::BIGINT GROUP BY ALL)"""


def _top_sql(source: str, key: str, k: int) -> str:
    return f"""{_last_sql(source, key)}
SELECT *, CAST(row_number() OVER (ORDER BY cnt DESC, {key}) AS INT) AS rnk FROM last ORDER BY rnk LIMIT {k}"""


@query("ss2_invertible_window_stream", f"WITH {_last_sql('f_messages', 'text', 60, 60)} SELECT * FROM last")
def invertible_window_stream(spark, sf_dir):
    """All counts of the last hour at the end of the stream: slides of a minute are added as they come and taken off as they leave."""
    out, offsets = scratch_dir(spark, "window"), scratch_dir(spark, "offsets")

    def start(events):
        rings = S.stream_rings(events.select("ts", F.col("event_type").alias("text")), "1 hour", "1 minute")
        return S.stream_topk_sink(rings, None, out, offsets, "1 hour", "1 minute")

    _in_triggers(spark, sf_dir, start)
    return _newest(spark, out)


@query("ss4_topk_stream", f"WITH {RESHARES}, {_top_sql('reshares', 'text', 5)}")
def topk_stream(spark, sf_dir):
    """The five largest counts of the window just past, over several triggers."""
    out, offsets = scratch_dir(spark, "top"), scratch_dir(spark, "offsets")

    def start(events):
        messages = events.select("ts", F.col("event_type").alias("text"), (F.col("value") >= 10).alias("is_retweet"))
        return S.stream_topk_sink(S.stream_rings(S.filter_reshares(messages), WIDTH, SLIDE), 5, out, offsets, WIDTH, SLIDE)

    _in_triggers(spark, sf_dir, start)
    return _newest(spark, out)


@query("ss3_hashtag_trends_stream", f"WITH {TAGS}, {_top_sql('tags', 'tag', 10)}")
def hashtag_trends_stream(spark, sf_dir):
    """Hashtags of the window just past, over several triggers."""
    out, offsets = scratch_dir(spark, "trends"), scratch_dir(spark, "offsets")

    def start(events):
        text = F.concat(F.lit("seen "), "event_type", F.lit(" #"), "event_type", F.lit(" by #k"),
                        (F.col("user_id") % 20).cast("string"), F.lit(" a#b"))
        return S.stream_hashtag_trends(events.select("ts", text.alias("text")), out, offsets, WIDTH, SLIDE, 10)

    _in_triggers(spark, sf_dir, start)
    return _newest(spark, out)


@query("io14_stream_topk_sink", f"WITH {RESHARES}, {_top_sql('reshares', 'text', 5)}")
def stream_topk_sink(spark, sf_dir):
    out = scratch_dir(spark, "top")
    rings = S.stream_rings(S.filter_reshares(_stream(spark, sf_dir)), WIDTH, SLIDE)
    S.stream_topk_sink(rings, 5, out, scratch_dir(spark, "offsets"), WIDTH, SLIDE).awaitTermination()
    return _newest(spark, out)
