"""Closed windows, open windows and late mails together are all mails, in any number and order of batches."""

from __future__ import annotations

import datetime as dt
import os
import shutil
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from mailgauge.operators import averages as A
from mailgauge.plans.live import start_live_analyses
from mailgauge.schema import READ_SCHEMA
from mailgauge.streaming import rankings, sinks, windows
from mailgauge.streaming.sources import NO_AGE_LIMIT

ONCE = {"availableNow": True}
START = dt.datetime(2001, 1, 1, tzinfo=dt.timezone.utc)


def mail(i):
    """A mail every ten seconds, words w0..w<i mod 3>; every eleventh has no date."""
    when = None if i % 11 == 10 else START + dt.timedelta(seconds=10 * i)
    return (f"<{i}>", when, "s@x", ["b@x"], None, " ".join(f"w{k}" for k in range(i % 3 + 1)))


def stream_in(spark, tmp_path, batches, start):
    """One micro-batch for each list of numbers."""
    for numbers in batches:
        spark.createDataFrame([mail(i) for i in numbers], READ_SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(READ_SCHEMA).options(**NO_AGE_LIMIT).parquet(f"{tmp_path}/in")
        query = start(stream)
        query.awaitTermination(120)
        assert query.exception() is None


def counted(df):
    """Occurrences by window start and word."""
    found = Counter()
    for r in df.select(F.unix_seconds("window.start").alias("start"), "word", "count").collect():
        found[(r.start, r.word)] += r["count"]
    return found


def cut(n, parts, order):
    numbers = [order(i) for i in range(n)]
    size = -(-n // parts)
    return [numbers[k : k + size] for k in range(0, n, size)]


@pytest.mark.parametrize(
    ("parts", "order", "slide"),
    [
        (1, "mixed", None),
        (4, "by date", None),
        (4, "mixed", None),
        (16, "by date", None),
        (16, "mixed", None),
        (4, "backwards", "30 seconds"),
    ],
)
def test_closed_open_and_late_are_all_mails(spark, tmp_path, parts, slide, order):
    n = 64
    places = {"by date": lambda i: i, "mixed": lambda i: i * 37 % n, "backwards": lambda i: n - 1 - i}
    out = f"{tmp_path}/out"

    def start(mails):
        return windows.start_top_words_keeping_late(
            mails, out, f"{tmp_path}/check", n=99, event_time="Date", slide=slide, trigger=ONCE
        )

    stream_in(spark, tmp_path, cut(n, parts, places[order]), start)
    every = A.windowed_words(spark.createDataFrame([mail(i) for i in range(n)], READ_SCHEMA), "Date", slide=slide)
    late = windows.late_mails(spark, out)
    late_words = A.body_words(late, "window").groupBy("window", "word").agg(F.count("*").alias("count"))
    closed, still_open = windows.closed_windows(spark, out), windows.open_windows(spark, out)
    assert counted(closed) + counted(still_open) + counted(late_words) == counted(every)
    # A window is closed once, and not open then.
    assert not {k[0] for k in counted(closed)} & {k[0] for k in counted(still_open)}
    assert closed.groupBy("window", "word").count().filter("count > 1").isEmpty()
    if order == "by date" or parts == 1:
        assert late.isEmpty()
    else:
        assert not late.isEmpty()


def test_windows_are_those_of_the_streaming_aggregation(spark, tmp_path):
    batches = cut(60, 4, lambda i: i)

    def keeping(mails):
        return windows.start_top_words_keeping_late(
            mails, f"{tmp_path}/a", f"{tmp_path}/check-a", n=2, event_time="Date", trigger=ONCE
        )

    def dropping(mails):
        return rankings.start_top_words(
            mails, f"{tmp_path}/b", f"{tmp_path}/check-b", n=2, event_time="Date", trigger=ONCE
        )

    stream_in(spark, tmp_path, batches, lambda mails: (dropping(mails).awaitTermination(120), keeping(mails))[1])
    columns = ["window", "rank", "word", "count"]
    found = sorted(map(tuple, windows.closed_windows(spark, f"{tmp_path}/a").select(columns).collect()))
    assert found and found == sorted(map(tuple, sinks.read_results(spark, f"{tmp_path}/b").select(columns).collect()))


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"

    def start(mails, checkpoint=check):
        return windows.start_top_words_keeping_late(mails, out, checkpoint, event_time="Date", trigger=ONCE)

    def state():
        frames = windows.closed_windows(spark, out), windows.late_mails(spark, out), windows.open_windows(spark, out)
        return [sorted(map(str, f.collect())) for f in frames]

    stream_in(spark, tmp_path, [range(20, 40), range(10)], start)
    first = state()
    assert first[1]
    # A stream that fails before it has noted its last batch as done runs it again.
    shutil.copytree(check, f"{check}-before")
    for name in ("1", ".1.crc"):
        os.remove(f"{check}-before/commits/{name}")
    stream = spark.readStream.schema(READ_SCHEMA).options(**NO_AGE_LIMIT).parquet(f"{tmp_path}/in")
    query = start(stream, f"{check}-before")
    query.awaitTermination(120)
    assert query.exception() is None and state() == first


def test_what_is_late(spark, tmp_path):
    def start(mails):
        return windows.start_top_words_keeping_late(
            mails, f"{tmp_path}/out", f"{tmp_path}/check", event_time="Date", trigger=ONCE, fan_in=2
        )

    stream_in(spark, tmp_path, [range(30, 42), [0, 41, 29, 10], [10]], start)
    late = windows.late_mails(spark, f"{tmp_path}/out")
    assert late.columns[:2] == ["window", "watermark"] and "batch_id" in late.columns
    # The latest mail is at 410 seconds, so windows that end at 350 seconds or before are closed.
    assert sorted(r.ID for r in late.collect()) == ["<0>", "<29>"]
    assert {r.s for r in late.selectExpr("unix_seconds(watermark) AS s").collect()} == {int(START.timestamp()) + 350}


def test_no_mail_has_a_time(spark, tmp_path):
    def start(mails):
        return windows.start_top_words_keeping_late(
            mails, f"{tmp_path}/out", f"{tmp_path}/check", event_time="Date", trigger=ONCE
        )

    stream_in(spark, tmp_path, [[10], [21]], start)
    for found in (windows.closed_windows, windows.late_mails, windows.open_windows):
        assert found(spark, f"{tmp_path}/out").isEmpty()
    stream_in(spark, tmp_path, [range(30)], start)
    assert not windows.closed_windows(spark, f"{tmp_path}/out").isEmpty()


def test_live_analyses_that_keep_late_mails(spark, tmp_path):
    def start(mails):
        senders, words = start_live_analyses(
            mails, f"{tmp_path}/out", f"{tmp_path}/check", trigger=ONCE, event_time="Date", keep_late=True, fan_in=2
        )
        senders.awaitTermination(120)
        return words

    stream_in(spark, tmp_path, [range(30, 42), [0, 41]], start)
    assert [r.ID for r in windows.late_mails(spark, f"{tmp_path}/out/words").collect()] == ["<0>"]
    assert not windows.open_windows(spark, f"{tmp_path}/out/words").isEmpty()
    latest = sinks.latest_batch(spark, f"{tmp_path}/out/senders").filter("measure = 'mails'").collect()
    # Twelve mails, then two more.
    assert [(r.sender, r.total) for r in latest] == [("s@x", 14)]


def naive(rows):
    found = Counter()
    for window, body in rows:
        found.update((window, word) for word in (body or "").split(" ") if word)
    return sorted((*key, n) for key, n in found.items())


@pytest.mark.parametrize("crowd_bytes", [1 << 20, 40, 0])
def test_words_of_large_and_small_windows(spark, crowd_bytes):
    """Counted alike where a window is too large for a task, and with what is known of other mails."""
    rows = [(i % 4, f"a b{i % 3}  c" * (1 + 5 * (i % 4 == 0))) for i in range(20)] + [(1, None), (None, "a"), (5, ""), (6, " ")]
    placed = spark.createDataFrame(rows, "window int, Body string")
    options = {"task_bytes": 8, "crowd_bytes": crowd_bytes}
    counts = A.count_placed_words(placed, **options)
    expected = naive((w, b) for w, b in rows if w is not None)
    assert counts.columns == ["window", "word", "count"] and counts.schema["count"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, counts.filter("window IS NOT NULL").collect())) == expected
    half = placed.filter("window < 2"), A.count_placed_words(placed.filter("window IS NULL OR window >= 1"))
    twice = sorted(map(tuple, A.count_placed_words(half[0], half[1].filter("window IS NOT NULL"), **options).collect()))
    assert twice == naive([r for r in rows if r[0] is not None and r[0] < 2] + [r for r in rows if r[0] is not None and r[0] >= 1])
    assert A.count_placed_words(placed.filter("false")).count() == 0


@pytest.mark.parametrize("slide", [None, "30 seconds"])
def test_mails_are_shuffled_and_not_their_words(spark, slide):
    """Between cutting the bodies and counting the words nothing is exchanged."""
    mails = spark.createDataFrame([(START + dt.timedelta(seconds=7 * i), "a b a") for i in range(50)], "Date timestamp, Body string")
    counts = A.windowed_words(mails, "Date", slide=slide)
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    planned = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and planned.count("Exchange") == 1
    assert planned.index("HashAggregate") < planned.index("Generate explode") < planned.index("Exchange")


def test_top_words_need_no_state_in_memory(spark, tmp_path):
    """Counts of open windows are tables; a window that is open between batches is counted in both."""

    def start(mails):
        started.append(rankings.start_top_words(
            mails, f"{tmp_path}/out", f"{tmp_path}/check", n=2, event_time="Date", delay="2 minutes", trigger=ONCE
        ))
        return started[-1]

    started = []
    stream_in(spark, tmp_path, [range(0, 45), range(45, 60), [0, 59]], start)
    assert all(not p["stateOperators"] for q in started for p in q.recentProgress)
    written = spark.read.parquet(f"{tmp_path}/out").select("window", "rank", "word", "count")
    mails = spark.read.schema(READ_SCHEMA).parquet(f"{tmp_path}/in")
    counts = A.windowed_words(mails.dropDuplicates(["ID"]), "Date")
    latest = mails.agg(F.max("Date")).head()[0]
    closed = counts.filter(F.col("window.end") <= F.lit(latest - dt.timedelta(minutes=2)))
    expected = A.top_words_by_window(closed, 2).select("window", "rank", "word", "count")
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, expected.collect())) and written.count() > 4
    # Only the last two versions are there.
    assert sorted(os.listdir(f"{tmp_path}/out/_open")) == ["1", "2"]


def test_batches_of_another_kind_of_checkpoint(spark, tmp_path):
    """What was known is gone: an error, and no counts without it."""

    def start(mails):
        return rankings.start_top_words(mails, f"{tmp_path}/out", f"{tmp_path}/check", event_time="Date", trigger=ONCE)

    stream_in(spark, tmp_path, [range(30)], start)
    shutil.rmtree(f"{tmp_path}/out/_clock")
    with pytest.raises(StreamingQueryException, match="open windows of batch 0"):
        stream_in(spark, tmp_path, [range(30, 40)], start)
