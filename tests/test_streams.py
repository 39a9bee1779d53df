"""Streams against batch, late rows, and the chained count."""

import datetime as dt
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from readloom.streaming import trends as S

T0 = dt.datetime(2024, 1, 1)


def write(spark, folder, name, seconds):
    rows = [(T0 + dt.timedelta(seconds=s), "x") for s in seconds]
    spark.createDataFrame(rows, "ts timestamp, text string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def run_batches(spark, tmp_path, build, batches):
    """One micro-batch per list of seconds; the stream restarts from its checkpoint in between."""
    schema = "ts timestamp, text string"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for i, seconds in enumerate(batches):
        write(spark, str(tmp_path / "in"), f"b{i}", seconds)
        source = S.event_time(spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*")))
        query = (build(source).writeStream.outputMode("append").format("parquet").option("path", out)
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
        query.awaitTermination()
    return {int((r.win_start - T0).total_seconds()): r.cnt for r in spark.read.parquet(out).collect()}


def test_late_row_is_dropped_and_row_within_delay_kept(spark, tmp_path):
    got = run_batches(spark, tmp_path, lambda s: S.sliding_counts(s, "60 seconds", "60 seconds", delay="30 seconds"),
                      [[10, 200], [20, 180, 400], [900]])
    assert got == {0: 1, 180: 2, 360: 1}


def test_chained_count_equals_batch(spark, tmp_path):
    seconds = [[3 * i for i in range(100)], [300 + 2 * i for i in range(100)], [5000]]
    got = run_batches(spark, tmp_path, lambda s: S.sliding_reduce(s, "60 seconds", "10 seconds"), seconds)
    rows = [(T0 + dt.timedelta(seconds=s), "x") for batch in seconds for s in batch]
    batch = S.sliding_counts(spark.createDataFrame(rows, "ts timestamp, text string"), "60 seconds", "10 seconds")
    want = {int((r.win_start - T0).total_seconds()): r.cnt for r in batch.filter(F.col("win_end") <= T0 + dt.timedelta(seconds=4990)).collect()}
    assert {k: v for k, v in got.items() if k < 4000} == {k: v for k, v in want.items() if k < 4000} and got


@pytest.mark.parametrize("chunk", [1, 2, 7, 4096])
def test_rolling_counts_across_chunks(spark, chunk):
    seconds = [0, 5, 11, 12, 35, 36, 61, 62, 63, 140]
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), "x") for s in seconds], "ts timestamp, text string")
    got = {int((r.win_end - T0).total_seconds()): r.n for r in S.rolling_counts(df, 10, 40, chunk=chunk).collect()}
    want = {}
    for end in sorted({s // 10 * 10 + 10 for s in seconds}):
        want[end] = sum(end - 40 <= s < end for s in seconds)
    assert got == want


def test_topk_ties_break_by_text_and_rank_limit_runs_before_the_shuffle(spark):
    counts = spark.createDataFrame([(1, "b", 3), (1, "a", 3), (1, "c", 9), (2, "z", 1)], "win_start int, text string, cnt long")
    top = S.topk_per_window(counts, 2)
    assert sorted((r.win_start, r.text, r.rnk) for r in top.collect()) == [(1, "a", 2), (1, "c", 1), (2, "z", 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_hashtags(spark):
    df = spark.createDataFrame([("#a b#c  #d",), ("none",)], "text string")
    assert sorted(r.tag for r in S.extract_hashtags(df).collect()) == ["#a", "#d"]


def top_per_trigger(spark, tmp_path, triggers, width, slide, k):
    """(batch, rank) -> (text, count, end of the window) of a stream that takes one list of (second, texts) per trigger."""
    for batch in triggers:
        rows = [(T0 + dt.timedelta(seconds=second), w) for second, words in batch for w in words]
        spark.createDataFrame(rows, "ts timestamp, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken in the order of their times
    stream = S.stream_messages(spark, str(tmp_path / "in"), "ts timestamp, text string", name_filter="*.parquet")
    rings = S.stream_rings(stream, width, slide)
    S.stream_topk_sink(rings, k, str(tmp_path / "top"), str(tmp_path / "offsets"), width, slide).awaitTermination()
    got = {}
    for r in spark.read.parquet(str(tmp_path / "top")).collect():
        got.setdefault(r.batch_id, {})[r.rnk] = (r.text, r.cnt, int((r.win_end - T0).total_seconds()))
    return [got[b] for b in sorted(got)], spark.read.parquet(str(tmp_path / f"top-rings/{max(got) % 2}")).collect()


def plain_top(rows, width, slide, k):
    """The k most frequent texts of the window that ends with the slide of the newest row."""
    end = max(s for s, _ in rows) // slide * slide + slide
    counts = Counter(w for s, words in rows if end - width <= s < end for w in words)
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    return {i + 1: (w, n, end) for i, (w, n) in enumerate(best)}


def test_window_just_past_holds_its_older_slides(spark, tmp_path):
    """A key of many seconds ago is in the window still, and leaves it with its slides."""
    rows = [(s, "aaa") for s in range(50)] + [(55, "z")]
    got, _ = top_per_trigger(spark, tmp_path, [rows, [(80, "y")], [(115, "y")]], "60 seconds", "1 second", 5)
    assert got[0] == {1: ("a", 150, 56), 2: ("z", 1, 56)}
    assert {1: ("a", 87, 81), 2: ("y", 1, 81), 3: ("z", 1, 81)} in got
    assert got[-1] == {1: ("y", 2, 116)}


def test_every_trigger_lists_its_window(spark, tmp_path):
    """Keys a trigger does not touch keep their place, late rows within the window count, older ones do not, and state goes."""
    triggers = [[(0, "aaaaabbb")], [(1, "c")], [(2, "ccccccd"), (9, "b")], [(65, "zz")], [(3, "a"), (30, "bb")], [(64, "c"), (7, "q")],
                [(200, "x")], [(201, "x"), (100, "a"), (150, "w")]]
    got, kept = top_per_trigger(spark, tmp_path, triggers, "60 seconds", "10 seconds", 2)
    seen, want = [], []
    for batch in triggers:
        seen += batch
        want.append(plain_top(seen, 60, 10, 2))
    lists = [got[0]] + [b for a, b in zip(got, got[1:]) if b != a]  # a trigger without rows repeats the list
    assert lists == [want[0]] + [b for a, b in zip(want, want[1:]) if b != a]
    first = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 10
    assert sorted((r.text, [(x.slide - first, x.n) for x in r.ring], r.total) for r in kept) == [
        ("w", [(15, 1)], 1), ("x", [(20, 2)], 2)]


def test_rings_over_restarts(spark, tmp_path):
    """A stream that starts again takes up rings and kept keys; null keys are a key."""
    rows, out = [], str(tmp_path / "top")
    for k, batch in enumerate([[(0, "a"), (1, None), (2, None)], [(5, "a"), (6, "a")], [(70, "b")]]):
        frame = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), w) for s, w in batch], "ts timestamp, text string")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = S.stream_messages(spark, str(tmp_path / "in"), "ts timestamp, text string", name_filter="*.parquet")
        S.stream_topk_sink(S.stream_rings(stream, "1 minute", "1 second"), None, out, str(tmp_path / "offsets"),
                           "1 minute", "1 second").awaitTermination()
        found = spark.read.parquet(out)
        last = found.filter(F.col("batch_id") == found.agg(F.max("batch_id")).first()[0])
        rows.append({(r.text, r.cnt) for r in last.collect()})
    assert rows == [{("a", 1), (None, 2)}, {("a", 3), (None, 2)}, {("b", 1)}]


def test_width_must_hold_whole_slides(spark):
    with pytest.raises(ValueError):
        S.stream_rings(spark.createDataFrame([(T0, "a")], "ts timestamp, text string"), "10 seconds", "3 seconds")
