"""Mail tables laid out by sender and month, for reports by sender that need no shuffle.

Mails of a sender lie in one bucket, so sums by sender are formed where the mails are read, and an interval
reads the months it touches.  A sender with more mails than a bucket should hold would make its bucket, and the one
task that reads it, as large as that.  Such senders (fewer than there are buckets, whatever the table) are kept in a
second table without buckets, whose sums are formed in all tasks and then shuffled, one row for each sender and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from mailgauge.operators.rollup import DAY, span
from mailgauge.schema import MAIL_COLUMNS

MONTH = "month"
HOT = "_hot"


def _month(micros: Column) -> Column:
    """Year * 100 + month, of UTC."""
    day = F.date_from_unix_date(F.floor(micros / F.lit(DAY)).cast("int"))
    return F.year(day) * 100 + F.month(day)


def store_by_sender(mails: DataFrame, table: str, path: str, buckets: int = 200) -> None:
    """Write mails as the tables ``table`` and ``<table>_hot`` of the catalog, with their files below ``path``.

    Tables of that name must not exist.  A sender is hot if it has more than a ``buckets``-th of all mails; a null
    sender is one like others.  The mails are counted by sender and shuffled once.
    """
    counts = mails.groupBy("From").agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    # Fewer than ``buckets`` rows, as each has more than that share.
    hot = [r[0] for r in counts.filter(F.col("n") * buckets > total).select("From").collect()]
    named = [h for h in hot if h is not None]
    is_hot = F.col("From").isin(named) if named else F.lit(False)
    is_hot = F.coalesce(is_hot, F.lit(None in hot))
    rows = mails.select(*MAIL_COLUMNS, _month(F.unix_micros("Date")).alias(MONTH))

    def writer(part: DataFrame, below: str) -> DataFrameWriter:
        return part.write.format("parquet").mode("errorifexists").partitionBy(MONTH).option("path", f"{path}/{below}")

    # Dealt as the buckets are, so that a task writes one file for each of its months.
    cold = rows.filter(~is_hot).repartition(buckets, "From").sortWithinPartitions(MONTH, "From", "Date")
    writer(cold, "by_sender").bucketBy(buckets, "From").sortBy("From", "Date").saveAsTable(table)
    writer(rows.filter(is_hot).repartitionByRange(MONTH, "Date", "ID"), "hot").saveAsTable(table + HOT)


def _read(spark: SparkSession, table: str, low: str | None, high: str | None, inclusive: str) -> DataFrame:
    rows = spark.table(table)
    if low is None or high is None:
        return rows
    cut = span(spark, low, high, inclusive)

    def instant(micros: int) -> Column:
        return F.timestamp_micros(F.lit(micros))

    first, last = spark.range(1).select(*[_month(F.lit(m)) for m in (cut.first, cut.last)]).head()
    inside = (F.col("Date") >= instant(cut.first)) & (F.col("Date") <= instant(cut.last))
    # The months choose the directories that are read.
    return rows.filter(F.col(MONTH).between(first, last) & inside)


def load_by_sender(
    spark: SparkSession, table: str, low: str | None = None, high: str | None = None, inclusive: str = "neither"
) -> tuple[DataFrame, DataFrame]:
    """(bucketed, hot): the mails of the two tables, all or those of an interval (see ``in_interval``).

    No sender is in both, so results by sender are those of the two, one after the other.
    """
    return _read(spark, table, low, high, inclusive), _read(spark, table + HOT, low, high, inclusive)
