"""Top words per window, without a state in memory; mails that come too late may have an output of their own.

A streaming aggregation holds a row for every word of a window, for all windows that a micro-batch brings, until the batch after
it.  Here a micro-batch is told apart by the watermark before it: late rows are dropped or go to one table, the others are
added to the counts of the open windows, and the windows that the watermark has passed after the batch are closed.  What a batch
knows of those before it (the latest event time and the counts of the open windows) are tables too, one version
for each batch, so a batch that is run again starts from the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailgauge.operators.averages import count_placed_words, top_words_by_window
from mailgauge.schema import MAIL_COLUMNS
from mailgauge.sources import committed
from mailgauge.sources.scratch import delete, exists, land, remove
from mailgauge.streaming.sources import with_event_time

WORDS, LATE = "words", "late"
# Versions of what batches know of those before them.
OPEN, CLOCK = "_open", "_clock"


def _version(path: str, name: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{name}/{batch_id}"


def _microseconds(spark: SparkSession, interval: str) -> int:
    start = F.timestamp_micros(F.lit(0))
    return spark.range(1).select(F.unix_micros(start + F.expr(f"INTERVAL {interval}"))).head()[0]


def start_top_words_keeping_late(
    mails: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    event_time: str = "arrived",
    window: str = "1 minute",
    slide: str | None = None,
    delay: str = "1 minute",
    lines_kept: bool = False,
    trigger: dict | None = None,
    fan_in: int | None = None,
) -> StreamingQuery:
    """As ``start_top_words``, and the late mails.

    ``path/words`` gets window, rank, word, count of every window when it is closed: its end is ``delay`` or more before the latest
    event time seen, which the batch itself may bring.  ``path/late`` gets the rows that came when their window had been closed:
    window, watermark (what it was then) and the mail; with overlapping windows a mail is late for those of its windows that
    are closed.  Both are tables of batches (see ``start_appending``, also for ``fan_in``).
    ``open_windows`` gives the counts so far of the others, so closed, open and late together are all mails with an
    event time.  Mails without one are in no window.

    The counts of the open windows are written anew for every batch; no large window gathers in a task (see
    ``count_placed_words``).
    """
    options = {"lines_kept": lines_kept, "trigger": trigger, "fan_in": fan_in}
    path = path.rstrip("/")
    return start_counting(
        mails, path, f"{path}/{WORDS}", f"{path}/{LATE}", checkpoint, n, event_time, window, slide, delay, **options
    )


def start_counting(
    mails: DataFrame,
    path: str,
    words: str,
    late: str | None,
    checkpoint: str,
    n: int,
    event_time: str,
    window: str,
    slide: str | None,
    delay: str,
    lines_kept: bool = False,
    trigger: dict | None = None,
    fan_in: int | None = None,
) -> StreamingQuery:
    """The stream behind ``start_top_words`` and ``start_top_words_keeping_late``.

    The table ``words`` gets the top words of closed windows, the table ``late`` the late mails, which are dropped if it is None; what
    the next batch has to know lies below ``path``.
    """
    spark = mails.sparkSession
    if exists(spark, path) and not exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise ValueError(f"{path} holds the batches of another checkpoint than {checkpoint}")
    lag = _microseconds(spark, delay)
    mails = with_event_time(mails, event_time)
    kept = list(dict.fromkeys([*(MAIL_COLUMNS if late else ["Body"]), event_time]))

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The mails are parsed once, and looked at several times.
        placed = land(batch.select(F.window(event_time, window, slide).alias("window"), *kept).filter("window IS NOT NULL"))
        before, known = None, None
        if batch_id:
            if not exists(session, _version(path, CLOCK, batch_id - 1)):
                raise ValueError(f"{path} does not hold the open windows of batch {batch_id - 1}: start with a new checkpoint")
            before = session.read.parquet(_version(path, CLOCK, batch_id - 1)).head().latest
            known = session.read.parquet(_version(path, OPEN, batch_id - 1))
        newest = placed.agg(F.max(F.unix_micros(event_time))).head()[0]
        latest = max((t for t in (before, newest) if t is not None), default=None)

        closed_before = F.lit(False) if before is None else F.unix_micros("window.end") <= before - lag
        if late:
            watermark = F.lit(None if before is None else before - lag).cast("long")
            rows = placed.filter(closed_before).select("window", F.timestamp_micros(watermark).alias("watermark"), *kept)
            committed.commit(rows, late, batch_id, fan_in)

        closes = F.lit(False) if latest is None else F.unix_micros("window.end") <= latest - lag

        def counts(which: Column) -> DataFrame:
            before_batch = None if known is None else known.filter(which)
            return count_placed_words(placed.filter(~closed_before & which), before_batch, lines_kept)

        best = top_words_by_window(counts(closes), n).select("window", "rank", "word", "count")
        committed.commit(best, words, batch_id, fan_in)
        counts(~closes).write.mode("overwrite").parquet(_version(path, OPEN, batch_id))
        clock = session.createDataFrame([(latest,)], "latest long")
        clock.write.mode("overwrite").parquet(_version(path, CLOCK, batch_id))
        remove(placed)
        # Only the batch that follows, or this one if it is run again, reads a version.
        for name in (OPEN, CLOCK):
            delete(session, _version(path, name, batch_id - 2))

    writer = mails.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def closed_windows(spark: SparkSession, path: str) -> DataFrame:
    """window, rank, word, count (and batch_id) of the windows closed so far."""
    return committed.load(spark, f"{path.rstrip('/')}/{WORDS}")


def late_mails(spark: SparkSession, path: str) -> DataFrame:
    """The mails that were late, with window, watermark and batch_id."""
    return committed.load(spark, f"{path.rstrip('/')}/{LATE}")


def open_windows(spark: SparkSession, path: str) -> DataFrame:
    """window, word, count of the windows not closed yet."""
    last = committed.entries(spark, f"{path.rstrip('/')}/{WORDS}")[-1].last
    return spark.read.parquet(_version(path, OPEN, last))
