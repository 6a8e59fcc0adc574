"""Reports from daily sums equal those from the mails, for any bounds and however tables were added."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from mailgauge.operators import averages as A
from mailgauge.operators.relational import in_interval
from mailgauge.plans import rollups
from mailgauge.schema import READ_SCHEMA
from mailgauge.sources import committed
from mailgauge.sources.tables import load_parquet

UTC = dt.timezone.utc
START = dt.datetime(1969, 12, 30, tzinfo=UTC)  # days before 1970 have negative numbers


def mails(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        when = START + dt.timedelta(days=rng.randrange(6), seconds=rng.choice([0, 1, 43_200, 86_399]), microseconds=rng.choice([0, 1, 999_999]))
        rows.append(
            (
                f"{seed}.{i}",
                None if rng.random() < 0.1 else when,
                rng.choice(["a@x", "b@x", "", None]),
                rng.choice([None, [], ["x"], ["x", "y", "z"]]),
                None,
                rng.choice([None, "", "one", "two  words", "a b c d"]),
            )
        )
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    paths = []
    for seed in range(5):
        path = str(tmp_path_factory.mktemp("tables") / f"t{seed}")
        spark.createDataFrame(mails(seed), READ_SCHEMA).write.parquet(path)
        paths.append(path)
    return paths


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


BOUNDS = [
    ("1969-12-31", "1970-01-03"),
    ("1969-12-30 00:00:00", "1970-01-04 23:59:59.999999"),
    ("1969-12-31 00:00:00.000001", "1970-01-01 12:00:00"),
    ("1970-01-01 12:00:00", "1970-01-01 12:00:00.000002"),
    ("1970-01-01 23:59:59.999999", "1970-01-03 00:00:00"),
    ("1970-01-02", "1970-01-01"),
    ("1900-01-01", "2100-01-01"),
]


@pytest.fixture(scope="module")
def rollup(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rollup") / "r")
    rollups.add_to_rollup(spark, path, tables[0], fan_in=2)
    rollups.add_to_rollup(spark, path, *tables[1:4], fan_in=2)
    rollups.add_to_rollup(spark, path, *tables, fan_in=2)
    return path


@pytest.mark.parametrize(
    "low, high, inclusive",
    [(*b, i) for b in BOUNDS for i in ("neither", "both")] + [(*BOUNDS[0], "low"), (*BOUNDS[0], "high")],
)
def test_equal_to_the_mails_for_any_bounds(spark, tables, rollup, low, high, inclusive):
    direct = A.mail_lengths(in_interval(load_parquet(spark, *tables), low, high, inclusive=inclusive))
    assert rows(rollups.rollup_averages(spark, rollup, low, high, inclusive)) == rows(A.averages(direct))
    assert rows(rollups.rollup_averages_by_sender(spark, rollup, low, high, inclusive)) == rows(
        A.averages_by_sender(direct)
    )


def test_bounds_in_another_time_zone(spark, tables, rollup):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        direct = A.mail_lengths(in_interval(load_parquet(spark, *tables), "1969-12-31", "1970-01-02"))
        found = rollups.rollup_averages_by_sender(spark, rollup, "1969-12-31", "1970-01-02")
        assert rows(found) == rows(A.averages_by_sender(direct))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_totals_of_all_mails(spark, tables, rollup):
    assert rows(rollups.rollup_sender_totals(spark, rollup)) == rows(A.sender_totals(load_parquet(spark, *tables)))
    assert sorted(rollups.rollup_tables(spark, rollup)) == sorted(tables)


def test_sums_are_merged(spark, rollup):
    """Four of the five tables are in one batch of sums with one row for each sender and day."""
    assert [(e.first, e.last) for e in committed.entries(spark, f"{rollup}/sums")] == [(0, 3), (4, 4)]
    merged = committed.load_batch(spark, f"{rollup}/sums", 3)
    assert merged.groupBy("sender", "day").count().filter("count > 1").isEmpty()


def test_a_table_is_read_when_it_is_added_and_then_at_the_ends_only(spark, tables, tmp_path):
    path = f"{tmp_path}/r"
    rollups.add_to_rollup(spark, path, *tables)
    plan = rollups.rollup_averages_by_sender(spark, path, "1969-12-30", "1970-01-03 06:00:00")
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "Date" in line]
    assert pushed and all("Or(" in line or "GreaterThan" in line for line in pushed)


def test_a_writer_that_dies_after_the_name_is_noted(spark, tables, tmp_path, monkeypatch):
    path = f"{tmp_path}/r"
    rollups.add_to_rollup(spark, path, tables[0])

    def dying(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(rollups, "daily_sums", dying)
    with pytest.raises(RuntimeError):
        rollups.add_to_rollup(spark, path, tables[1])
    monkeypatch.undo()
    rollups.add_to_rollup(spark, path)
    assert rows(rollups.rollup_sender_totals(spark, path)) == rows(A.sender_totals(load_parquet(spark, *tables[:2])))
