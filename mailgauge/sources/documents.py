"""Results as JSON."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.sources.scratch import land, remove
from mailgauge.sources.tables import output_dir


def store_json_lines(df: DataFrame, path: str, now: datetime | None = None) -> str:
    """One JSON object per line; a small result is one file, a large one several.

    The rebalance hint leaves the number of files to adaptive execution.
    Returns the directory written.
    """
    target = output_dir(path, "json", now)
    df.hint("rebalance").write.mode("errorifexists").json(target)
    return target


def store_json_document(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    now: datetime | None = None,
    files: int | None = None,
) -> str:
    """One JSON array with an object per row, as lines of text.

    ``[{...}``, then ``,{...}`` per further row, then ``]``.  Null fields are
    left out.  The directory is the document: its files, in name order, make
    up the array.  There are up to ``files`` of them, by default as many as
    adaptive execution finds useful.  Returns the directory.
    """
    target = output_dir(path, "json", now)
    columns = df.columns
    # Landed once: searched for its first row, sampled for the ranges, then written.
    landed = land(df)
    rows = landed.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    keys = [*order_by, "_file", "_row"]
    first = rows.orderBy(*keys).select("_file", "_row").head()

    end = rows.sparkSession.range(1).select(F.lit(1).alias("_part"))
    if first is None:
        lines = end.select(F.lit("[]").alias("_line"))
    else:
        is_first = (F.col("_file") == first._file) & (F.col("_row") == first._row)
        records = rows.select(
            F.lit(0).alias("_part"),
            *keys,
            F.concat(F.when(is_first, "[").otherwise(","), F.to_json(F.struct(*columns))).alias("_line"),
        )
        lines = (
            records.unionByName(end.withColumn("_line", F.lit("]")), allowMissingColumns=True)
            .repartitionByRange(*([files] if files else []), "_part", *keys)
            .sortWithinPartitions("_part", *keys)
            .select("_line")
        )
    lines.write.mode("errorifexists").text(target)
    remove(landed)
    return target


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a stored JSON array, read line by line on all tasks."""
    return (
        spark.read.text(path)
        .filter(F.col("value").rlike(r"\A[\[,]\{"))
        .select(F.from_json(F.substr("value", F.lit(2)), schema, {"mode": "FAILFAST"}).alias("row"))
        .select("row.*")
    )
