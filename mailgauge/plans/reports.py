"""Average length and recipients, from stored mail tables to JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from mailgauge.operators.averages import averages, averages_by_sender, mail_lengths, sender_totals
from mailgauge.operators.relational import in_interval
from mailgauge.sources.bysender import load_by_sender
from mailgauge.sources.documents import store_json_document
from mailgauge.sources.tables import load_parquet


def interval_averages(spark: SparkSession, tables: Sequence[str], low: str, high: str) -> DataFrame:
    """avgLength and avgNoOfRecipients of the mails dated between low and high."""
    return averages(mail_lengths(in_interval(load_parquet(spark, *tables), low, high)))


def interval_averages_by_sender(
    spark: SparkSession, tables: Sequence[str], low: str, high: str
) -> DataFrame:
    """sender, avgLength and avgNoOfRecipients of the mails dated between low and high."""
    return averages_by_sender(mail_lengths(in_interval(load_parquet(spark, *tables), low, high)))


def averages_by_sender_where_stored(
    spark: SparkSession, table: str, low: str | None = None, high: str | None = None, inclusive: str = "neither"
) -> DataFrame:
    """``interval_averages_by_sender`` of a table that ``store_by_sender`` has laid out.

    Only the sums of the few hot senders are shuffled.
    """
    parts = [averages_by_sender(mail_lengths(mails)) for mails in load_by_sender(spark, table, low, high, inclusive)]
    return parts[0].unionAll(parts[1])


def sender_totals_where_stored(spark: SparkSession, table: str) -> DataFrame:
    """``sender_totals`` of all mails of such a table."""
    bucketed, hot = load_by_sender(spark, table)
    return sender_totals(bucketed).unionAll(sender_totals(hot))


def report_averages(spark: SparkSession, tables: Sequence[str], low: str, high: str, path: str) -> str:
    return store_json_document(interval_averages(spark, tables, low, high), path)


def report_averages_by_sender(
    spark: SparkSession, tables: Sequence[str], low: str, high: str, path: str
) -> str:
    return store_json_document(
        interval_averages_by_sender(spark, tables, low, high), path, order_by=["sender"]
    )
