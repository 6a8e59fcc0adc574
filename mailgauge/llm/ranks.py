"""Positions of rows in a total order, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.sources.scratch import land


def _placed(table: DataFrame) -> DataFrame:
    return table.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` and rank (from 0 in each group, by the columns of ``order``), size (rows of the group).

    Ascending, nulls first; a null in ``group`` is a value like others.  Rows equal in all of it follow one another
    in any order.  No column may be called _file, _at, rank or size.

    The rows are stored twice: as they come, so that a row's place tells equal rows apart and a crowded value is cut
    over tasks, and sorted by range.  A file then holds consecutive ranks of each of its groups, so all that has to be
    summed up is one row for each file and group in it.
    """
    keys = [*group, *order, "_file", "_at"]
    # The range partitioner sends a sample of the keys to the driver, so the file is a number there.
    stored = _placed(land(rows)).withColumn("_file", F.xxhash64("_file"))
    runs = _placed(land(stored.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_file", "_at")))
    spans = runs.groupBy(*group, "_file").agg(
        F.min("_at").alias("_from"),
        F.count("*").alias("_n"),
        # Files of one group overlap in their edges only: the first by its least and then its greatest row is first.
        F.min(F.struct(*order)).alias("_least"),
        F.max(F.struct(*order)).alias("_greatest"),
    )
    in_group = Window.partitionBy(*group)
    before = in_group.orderBy("_least", "_greatest").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_file").alias("_span"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")).alias("_shift"),
        F.sum("_n").over(in_group).alias("size"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    met = runs.join(spans, reduce(lambda a, b: a & b, same, F.col("_file") == F.col("_span")))
    return met.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "size")
