"""Averages, totals and word frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.functions.tokens import word_count, words
from mailgauge.operators.relational import with_features

# Bytes of mails that a task counts the words of, and those of a window that more than one task counts.
TASK_BYTES = 16 << 20
CROWD_BYTES = 64 << 20


def mail_lengths(df: DataFrame, lines_kept: bool = False) -> DataFrame:
    """ID, From, WordCount and RecipientsCount: all the averages need, without bodies."""
    return with_features(df, lines_kept).select("ID", "From", "WordCount", "RecipientsCount")


def averages(lengths: DataFrame) -> DataFrame:
    """One row: mean words and mean recipients per mail, null for no mails."""
    return lengths.sparkSession.sql(
        """
        SELECT avg(WordCount) AS avgLength, avg(RecipientsCount) AS avgNoOfRecipients
        FROM {lengths}
        """,
        lengths=lengths,
    )


def averages_by_sender(lengths: DataFrame) -> DataFrame:
    """One row per sender: mean words and mean recipients per mail.

    Sums and counts are formed before the shuffle, so what a busy sender
    ships is one row per task.
    """
    return lengths.sparkSession.sql(
        """
        SELECT `From` AS sender, avg(WordCount) AS avgLength, avg(RecipientsCount) AS avgNoOfRecipients
        FROM {lengths}
        GROUP BY `From`
        """,
        lengths=lengths,
    )


def sender_totals(df: DataFrame, lines_kept: bool = False) -> DataFrame:
    """Mails and words per sender, in one pass.  A mail without a sender, null or empty, counts for nobody."""
    return (
        df.filter(F.col("From") != "")
        .select(F.col("From").alias("sender"), word_count(F.col("Body"), lines_kept).alias("n"))
        .groupBy("sender")
        .agg(F.count("*").alias("mails"), F.sum("n").alias("words"))
    )


def body_words(df: DataFrame, *keep: str | Column, lines_kept: bool = False) -> DataFrame:
    """One row per word occurrence, with the kept columns."""
    return df.select(*keep, F.explode(words(F.col("Body"), lines_kept)).alias("word"))


def word_frequency(df: DataFrame, lines_kept: bool = False) -> DataFrame:
    return body_words(df, lines_kept=lines_kept).groupBy("word").agg(F.count("*").alias("count"))


def windowed_words(
    df: DataFrame,
    event_time: str,
    window: str = "1 minute",
    slide: str | None = None,
    lines_kept: bool = False,
) -> DataFrame:
    """Occurrences per time window and word.  Works on streams too.

    A mail gets its windows before it is cut into words.  Mails without an
    event time are in no window.
    """
    placed = df.select(F.window(event_time, window, slide).alias("window"), "Body")
    if df.isStreaming:
        return body_words(placed, "window", lines_kept=lines_kept).groupBy("window", "word").agg(F.count("*").alias("count"))
    return count_placed_words(placed, lines_kept=lines_kept)


def count_placed_words(
    placed: DataFrame,
    known: DataFrame | None = None,
    lines_kept: bool = False,
    task_bytes: int = TASK_BYTES,
    crowd_bytes: int = CROWD_BYTES,
) -> DataFrame:
    """window, word, count of mails that have their ``window``, with counts known of other mails added.

    Words take far more room than the mails they are in, so mails are brought together by window before they are
    cut, and what is counted then is shuffled no more.  A window with more than ``crowd_bytes`` of mails is left out
    of that: its words are counted where its mails are and brought together by window and word, so it does not
    gather in a task.  The sizes of the windows are summed first, which reads the mails once more: give a table.
    """
    rows = placed.select("window", "Body", F.lit(None).cast("string").alias("word"), F.lit(1).cast("long").alias("count"))
    if known is not None:
        rows = rows.unionByName(known.select("window", "word", "count"), allowMissingColumns=True)
    size = F.coalesce(F.octet_length("Body"), F.octet_length("word"), F.lit(0))
    sizes = rows.groupBy("window").agg(F.sum(size).alias("size"))
    total, crowds = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count_if(F.col("size") > crowd_bytes)).head()
    tasks = max(-(-total // task_bytes), placed.sparkSession.sparkContext.defaultParallelism)

    def counted(some: DataFrame) -> DataFrame:
        cut = F.when(F.col("word").isNull(), words(F.col("Body"), lines_kept)).otherwise(F.array("word"))
        each = some.select("window", "count", F.explode(cut).alias("word"))
        return each.groupBy("window", "word").agg(F.sum("count").alias("count"))

    def gathered(some: DataFrame) -> DataFrame:
        # Keyed by a struct, as counts of crowded windows lie elsewhere: who ranks the words of a window limits them per task first.
        keyed = some.select(F.struct("window").alias("window"), "Body", "word", "count").repartition(tasks, "window")
        return counted(keyed).select("window.window", "word", "count")

    if not crowds:
        return gathered(rows)
    crowded = F.broadcast(sizes.filter(F.col("size") > crowd_bytes).select("window"))
    others = gathered(rows.join(crowded, "window", "left_anti"))
    return others.unionAll(counted(rows.join(crowded, "window", "left_semi")))


def top_words_by_window(counts: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent words of each window, ties broken by the word.

    The rank limit is applied per task before the shuffle by window as well,
    so at most n rows per window and task are shipped.
    """
    best = Window.partitionBy("window").orderBy(F.desc("count"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def totals_by_measure(totals: DataFrame) -> DataFrame:
    """sender, measure (mails, words), total from ``sender_totals``."""
    return totals.select("sender", F.expr("stack(2, 'mails', mails, 'words', words) AS (measure, total)"))


def rank_by_measure(rows: DataFrame, n: int = 5) -> DataFrame:
    """measure, rank, sender, total: the n largest totals of each measure, ties broken by sender.

    Again only n rows per measure and task are shipped.
    """
    best = Window.partitionBy("measure").orderBy(F.desc("total"), F.asc("sender"))
    return (
        rows.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= n)
        .select("measure", "rank", "sender", "total")
    )


def top_senders(totals: DataFrame, n: int = 5) -> DataFrame:
    """Both rankings of ``sender_totals`` in one pass over the totals."""
    return rank_by_measure(totals_by_measure(totals), n)


def updated_top_senders(changed: DataFrame, previous: DataFrame | None, n: int = 5) -> DataFrame:
    """The rankings after some senders' totals have grown, from those senders and the rankings before.

    Totals never fall, so nobody else can enter.  A sender may stand in both,
    with an old total: among the 2 n largest are the n largest senders.
    """
    rows = totals_by_measure(changed)
    if previous is None:
        return rank_by_measure(rows, n)
    both = rank_by_measure(rows.unionByName(previous.select("sender", "measure", "total")), 2 * n)
    return rank_by_measure(both.groupBy("measure", "sender").agg(F.max("total").alias("total")), n)
