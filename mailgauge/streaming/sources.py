"""Streams over a directory that a mail producer keeps filling."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.conf import RuntimeConfig
from pyspark.sql.streaming import DataStreamReader

from mailgauge.operators.parse import ERROR_COLUMN, parse_mail
from mailgauge.sources import committed
from mailgauge.sources.listing import FILES, TASK_BYTES, TASK_FILES, Opened, open_path, read_listed, tasks_for
from mailgauge.sources.mailfiles import OPEN_COST, directly_matching

# By default a stream ignores files a week older than the newest it has seen, such as an archive copied with its
# file times.  No file is that old.
NO_AGE_LIMIT = {"maxFileAge": "100000d"}

# How much a scan packs into a task, and how many tasks look up the files of a micro-batch, 10,000 by default.
TASK_SIZE = "spark.sql.files.maxPartitionBytes"
LOOKUPS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LEAST_LOOKUPS = 64
# Bytes of the driver's memory in which Spark keeps what it has listed, for a scan that is run again: no batch is.
KEPT_LISTS = "spark.sql.hive.filesourcePartitionFileCacheSize"

# The event time that is the time of the micro-batch a mail came in.
PROCESSED = "processed"


def with_event_time(mails: DataFrame, event_time: str) -> DataFrame:
    """The mails with the column ``event_time``: one they have, or PROCESSED.

    The time of a micro-batch is noted in the checkpoint before it is run, so one that is run again has the same.
    """
    if event_time == PROCESSED and PROCESSED not in mails.columns:
        return mails.withColumn(PROCESSED, F.current_timestamp())
    return mails


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row per line of text, column ``value``, of files of any age unless ``maxFileAge`` is given.

    Only files directly in the directory, or in one that the pattern ``path`` names, whenever it is made.
    """
    return _files(spark, path, options).select("value")


def _files(spark: SparkSession, path: str, options: dict, reader: DataStreamReader | None = None) -> DataFrame:
    # All below is listed, as directories named k=v would otherwise be taken for partitions.
    options = NO_AGE_LIMIT | {"recursiveFileLookup": "true"} | options
    files = (reader or spark.readStream).format("text").options(**options).load(path)
    return files.filter(directly_matching(spark, path))


def _packing_reader(spark: SparkSession) -> DataStreamReader:
    """A reader whose scans put TASK_FILES small files, or TASK_BYTES of large ones, into a task.

    A stream's scan goes by the settings of the session that made the stream, whichever runs it: here a copy of this one.
    """
    copy = spark._jsparkSession.cloneSession()
    conf = RuntimeConfig(copy.conf())
    conf.set(OPEN_COST, str(TASK_BYTES // TASK_FILES))
    conf.set(TASK_SIZE, str(TASK_BYTES))
    conf.set(KEPT_LISTS, "0")
    lookups = max(LEAST_LOOKUPS, 4 * spark.sparkContext.defaultParallelism)
    conf.set(LOOKUPS, str(min(lookups, int(conf.get(LOOKUPS)))))
    # Only on the JVM: a second session of Python's would take over ``RDD.toDF``.
    reader = spark.readStream
    reader._jreader = copy.readStream()
    return reader


def _moved(frame: DataFrame, spark: SparkSession) -> DataFrame:
    """The frame of a copy of the session as one of the session itself, which then is the one that runs it."""
    name = f"moved_{uuid.uuid4().hex}"
    frame.createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def stream_mail_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """One row per file: ``value``, its whole text, ``path``, and ``arrived``, when it was written.

    Only files directly in the directory, or in one that the pattern ``path``
    names, whenever it is made.  ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bound a micro-batch.  Files of any age are read
    unless ``maxFileAge`` is given; the log of seen files grows with the
    directory, so move read files away (``cleanSource="archive"`` and
    ``sourceArchiveDir``) where mails keep coming for long.

    Tasks get files as ``read_listed`` deals them, 2,000 small ones say, whatever the session counts for opening one.
    Of its other settings the scan has those of the time the stream is made.
    """
    files = _files(spark, path, {"wholetext": "true"} | options, _packing_reader(spark)).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )
    return _moved(files, spark)


def stream_listed_files(
    spark: SparkSession, listing: str, tasks: int | None = 200, opened: Opened = open_path, **options
) -> DataFrame:
    """As ``stream_mail_files``, but of the files that ``note_new_files`` adds to the table ``listing``.

    What the driver lists, and the stream's log of seen files grows with, are the few files of that table, not the
    mails.  ``tasks`` read the mails of a micro-batch; with None as many as all files ask for that are noted when the
    stream is made, which suits one that reads them in one batch.  Call ``note_new_files`` as often as new mails are
    to be looked for, once at least before the stream is started.
    """
    if tasks is None:
        tasks = tasks_for(committed.load(spark, listing))
    files = spark.readStream.schema(FILES).options(**(NO_AGE_LIMIT | options)).parquet(listing)
    return read_listed(files, tasks, opened)


def stream_mail(
    spark: SparkSession,
    path: str,
    errors: bool = False,
    parse_options: dict | None = None,
    listed: bool = False,
    **options,
) -> DataFrame:
    """The mails of a growing directory: the mail table and ``arrived``.

    ``errors=True`` adds ``_error`` and ``path``.  ``listed=True``: ``path`` is a table of files kept by ``note_new_files``
    (see ``stream_listed_files``).
    """
    files = stream_listed_files(spark, path, **options) if listed else stream_mail_files(spark, path, **options)
    mails = parse_mail(files, keep=["arrived", "path"], **(parse_options or {}))
    return mails if errors else mails.drop(ERROR_COLUMN, "path")
