"""The stored mail table."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from mailgauge.operators.parse import ERROR_COLUMN, has_error
from mailgauge.operators.relational import POSITION
from mailgauge.schema import READ_SCHEMA

# Tells copies of a mail apart while a table is written.
PLACE = "_place"

# Fixed value: output directories are named after the local time they were made.
OUTPUT_STAMP = "%Y-%m-%d_%H-%M-%S"


def output_dir(path: str, kind: str, now: datetime | None = None) -> str:
    """``path/<local time>_output_<kind>``."""
    stamp = (now or datetime.now()).strftime(OUTPUT_STAMP)
    return f"{path.rstrip('/')}/{stamp}_output_{kind}"


def load_parquet(spark: SparkSession, *paths: str, positions: bool = False) -> DataFrame:
    """One mail table from any number of Parquet files or directories.

    The schema is given, not inferred: no file footer is read for planning,
    and a column a file lacks is null.  ``positions=True`` adds the POSITION
    columns, file and row, which tell copies of a mail apart.
    """
    if not paths:
        empty = spark.createDataFrame([], READ_SCHEMA)
        return empty.selectExpr("*", *[f"CAST(NULL AS {t}) AS {c}" for c, t in POSITION.items()]) if positions else empty
    return _with_position(spark.read.schema(READ_SCHEMA).parquet(*paths), positions)


def _with_position(rows: DataFrame, positions: bool) -> DataFrame:
    if not positions:
        return rows
    file, row = POSITION
    return rows.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))


def store_parquet(
    df: DataFrame, path: str, clustered: bool = False, now: datetime | None = None, files: int | None = None
) -> str:
    """Write a mail table to a new directory below ``path`` and return that directory.

    An existing directory is an error.  ``clustered=True`` pays one shuffle to
    write files that each cover a short span of dates, so that later interval
    filters skip most row groups: ``files`` of them, or as many as the session
    has shuffle partitions.  A crowded instant is split by ID, and copies of
    one mail by the POSITION columns or, where the table has none, by their
    place in it; none of these is stored.  The range partitioner reads its
    input twice, so give it a stored table rather than one still to be parsed.
    """
    target = output_dir(path, "parquet", now)
    if clustered:
        places = [c for c in POSITION if c in df.columns]
        if len(places) < len(POSITION):
            # It need not be the same in both readings: any place of a copy is right.
            df, places = df.withColumn(PLACE, F.monotonically_increasing_id()), [PLACE]
        keys = ["Date", "ID", *places]
        df = df.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)
    df.drop(*POSITION, PLACE).write.mode("errorifexists").parquet(target)
    return target


def mark_valid(parsed: DataFrame) -> DataFrame:
    """Adds ``valid``, which the stored form is partitioned by."""
    return parsed.withColumn("valid", ~has_error())


def store_parsed(parsed: DataFrame, path: str, now: datetime | None = None) -> str:
    """Write parsed mails and their quarantine, one run of the parser for both.

    Rows go to ``valid=true`` or ``valid=false`` below a new directory, which
    is returned; read it with ``load_parsed``.
    """
    target = output_dir(path, "parquet", now)
    mark_valid(parsed).write.mode("errorifexists").partitionBy("valid").parquet(target)
    return target


def load_parsed(spark: SparkSession, *paths: str, positions: bool = False) -> tuple[DataFrame, DataFrame]:
    """(mails, quarantine) of ``store_parsed``; each reads its own files only.

    ``positions=True`` adds the POSITION columns to the mails.  The quarantine has ``_error`` and, if it was stored, the mail's ``path``.
    """
    schema = StructType(
        [
            *READ_SCHEMA,
            StructField(ERROR_COLUMN, ArrayType(StringType())),
            StructField("path", StringType()),
            StructField("valid", BooleanType()),
        ]
    )
    stored = [_with_position(spark.read.schema(schema).parquet(path), positions) for path in paths]
    rows = reduce(DataFrame.unionAll, stored)
    mails = rows.filter("valid").select(*READ_SCHEMA.fieldNames(), *(POSITION if positions else ()))
    return mails, rows.filter("NOT valid").drop("valid", *POSITION)
