"""Reports from sums by sender and day that are kept beside the stored tables.

A table that is added is read once.  A report reads the sums of the whole days in its interval and, of the tables, only the
mails of the two days at its ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailgauge.operators.rollup import (
    added,
    averages_by_sender_of_sums,
    averages_of_sums,
    daily_sums,
    span,
    totals_of_sums,
)
from mailgauge.sources import committed
from mailgauge.sources.tables import load_parquet

# Batches of sums that are added up into one at a time.
FAN_IN = 16


def _paths(rollup: str) -> tuple[str, str]:
    """Where the names of the tables and their sums are: batch n of one belongs to batch n of the other."""
    return f"{rollup.rstrip('/')}/tables", f"{rollup.rstrip('/')}/sums"


def rollup_tables(spark: SparkSession, rollup: str) -> list[str]:
    """The tables that have been added."""
    names, _ = _paths(rollup)
    return [r.name for r in committed.load(spark, names).orderBy(committed.BATCH).collect()]


def add_to_rollup(spark: SparkSession, rollup: str, *tables: str, lines_kept: bool = False, fan_in: int = FAN_IN) -> None:
    """Add stored mail tables to a rollup; one that is in it already, by its path, is left out.

    A table's name is noted first.  Its sums become part of the rollup as one batch, wholly or not at all; one
    that was noted and not added, as the writer died, is added by the next call.  Sums of several tables are added up as
    ``fan_in`` of them come together, so that the rollup has about as many rows as there are pairs of sender and day.
    """
    names, sums = _paths(rollup)
    held = committed.entries(spark, names)
    known = set(rollup_tables(spark, rollup)) if held else set()
    for table in dict.fromkeys(t.rstrip("/") for t in tables):
        if table not in known:
            number = held[-1].last + 1 if held else 0
            committed.commit(spark.createDataFrame([(table,)], "name string"), names, number, fan_in)
            held = committed.entries(spark, names)
    done = committed.entries(spark, sums)
    for number in range(done[-1].last + 1 if done else 0, held[-1].last + 1 if held else 0):
        name = committed.load_batch(spark, names, number).head().name
        committed.commit(daily_sums(load_parquet(spark, name), lines_kept), sums, number, fan_in, added)


def _in_span(
    spark: SparkSession, rollup: str, low: str, high: str, inclusive: str, lines_kept: bool
) -> DataFrame:
    cut = span(spark, low, high, inclusive)
    whole = committed.load(spark, _paths(rollup)[1]).filter(cut.in_whole_days()).drop(committed.BATCH)
    ends = load_parquet(spark, *rollup_tables(spark, rollup)).filter(cut.at_ends())
    return whole.unionByName(daily_sums(ends, lines_kept))


def rollup_averages(
    spark: SparkSession, rollup: str, low: str, high: str, inclusive: str = "neither", lines_kept: bool = False
) -> DataFrame:
    """``interval_averages`` of the tables of a rollup."""
    return averages_of_sums(_in_span(spark, rollup, low, high, inclusive, lines_kept))


def rollup_averages_by_sender(
    spark: SparkSession, rollup: str, low: str, high: str, inclusive: str = "neither", lines_kept: bool = False
) -> DataFrame:
    """``interval_averages_by_sender`` of the tables of a rollup."""
    return averages_by_sender_of_sums(_in_span(spark, rollup, low, high, inclusive, lines_kept))


def rollup_sender_totals(spark: SparkSession, rollup: str) -> DataFrame:
    """``sender_totals`` of all mails in the tables of a rollup, dated or not; no table is read."""
    return totals_of_sums(committed.load(spark, _paths(rollup)[1]))
