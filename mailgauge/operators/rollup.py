"""Partial results that can be added up: what the averages and totals need of each sender and day.

A day is one of UTC, whatever the session's time zone, so that rows of different runs can be added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.functions.tokens import recipient_count, word_count

DAY = 86_400_000_000  # microseconds
KEYS = ("sender", "day")
SUMS = ("mails", "words", "recipients")


def daily_sums(mails: DataFrame, lines_kept: bool = False) -> DataFrame:
    """sender, day (number since 1970, null without a date), mails, words, recipients.

    Sums are formed before the shuffle: a task ships one row for each sender and day it has met.
    """
    measured = mails.select(
        F.col("From").alias("sender"),
        F.floor(F.expr("unix_micros(Date)") / F.lit(DAY)).alias("day"),
        word_count(F.col("Body"), lines_kept).cast("long").alias("words"),
        recipient_count(F.col("Recipients")).cast("long").alias("recipients"),
    )
    return measured.groupBy(*KEYS).agg(
        F.count("*").alias("mails"), F.sum("words").alias("words"), F.sum("recipients").alias("recipients")
    )


def added(sums: DataFrame) -> DataFrame:
    """Rows of ``daily_sums`` added up: one for each sender and day."""
    return sums.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def averages_of_sums(sums: DataFrame) -> DataFrame:
    """The one row of ``averages``, from rows of ``daily_sums``."""
    return sums.agg(F.sum("mails").alias("n"), F.sum("words").alias("w"), F.sum("recipients").alias("r")).select(*_means())


def averages_by_sender_of_sums(sums: DataFrame) -> DataFrame:
    """``averages_by_sender`` from rows of ``daily_sums``."""
    by_sender = sums.groupBy("sender").agg(
        F.sum("mails").alias("n"), F.sum("words").alias("w"), F.sum("recipients").alias("r")
    )
    return by_sender.select("sender", *_means())


def _means() -> list[Column]:
    n = F.col("n").cast("double")
    return [
        F.when(n > 0, F.col("w").cast("double") / n).alias("avgLength"),
        F.when(n > 0, F.col("r").cast("double") / n).alias("avgNoOfRecipients"),
    ]


def totals_of_sums(sums: DataFrame) -> DataFrame:
    """``sender_totals`` from rows of ``daily_sums``."""
    named = sums.filter(F.col("sender") != "")
    return named.groupBy("sender").agg(F.sum("mails").alias("mails"), F.sum("words").alias("words"))


@dataclass(frozen=True)
class Span:
    """An interval of instants (microseconds, both ends inside), cut into whole days and what is left at its ends."""

    first: int
    last: int

    @property
    def days(self) -> tuple[int, int]:
        """The first and the last whole day; the last is before the first if there is none."""
        return -(-self.first // DAY), (self.last + 1) // DAY - 1

    def in_whole_days(self) -> Column:
        """For rows of ``daily_sums``: whether their day lies in the interval wholly."""
        first, last = self.days
        return F.col("day").between(first, last) if first <= last else F.lit(False)

    def at_ends(self, date: str = "Date") -> Column:
        """For mails: whether they are in the interval, but on a day that is not."""
        first, last = self.days

        def instant(micros: int) -> Column:
            return F.timestamp_micros(F.lit(micros))

        inside = (F.col(date) >= instant(self.first)) & (F.col(date) <= instant(self.last))
        if first > last:
            return inside
        return inside & ((F.col(date) < instant(first * DAY)) | (F.col(date) >= instant((last + 1) * DAY)))


def span(spark: SparkSession, low: str, high: str, inclusive: str = "neither") -> Span:
    """The interval of ``in_interval``: bounds as text in the session time zone."""
    if inclusive not in ("neither", "low", "high", "both"):
        raise ValueError(f"inclusive must be neither, low, high or both, not {inclusive!r}")
    micros = [F.expr("unix_micros(CAST(b AS TIMESTAMP))").alias("m")]
    a, b = (r.m for r in spark.createDataFrame([(low,), (high,)], "b string").select(*micros).collect())
    return Span(a if inclusive in ("low", "both") else a + 1, b if inclusive in ("high", "both") else b - 1)
