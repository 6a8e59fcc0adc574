"""Files of very large directories as a table: tasks list them, tasks read them.

Spark's own scan of a directory lists it, with all below, on the driver, and a stream does so for every batch.  Here the
driver knows the directories only.  Each is listed by a task, one level deep, and what it holds are rows.

Tasks open files with ``pyarrow.fs``, which finds the file system by the scheme of a path (``file``, ``hdfs``, ``s3``,
``gs``), with the credentials of the machine.  For others give ``opened``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.sources import committed
from mailgauge.sources.opened import Opened, open_path
from mailgauge.sources.scratch import directories

FILES = "path string, length long, modified timestamp"
_FILES = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])
# Rows and bytes that a task holds at a time.
ROWS = 10_000
BYTES = 16 << 20
# Tasks that list directories, and files and bytes that a task reads; files from which on all cores are used.
LISTERS = 10_000
TASK_FILES = 2_000
TASK_BYTES = 128 << 20
LEAST_FILES = 200


def _hidden(name: str) -> bool:
    """What Spark's scan leaves out too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def list_files(spark: SparkSession, *patterns: str, opened: Opened = open_path) -> DataFrame:
    """path, length, modified of the files directly in the directories that some paths or patterns name.

    As for ``read_mail_files``: what lies below, hidden files (``_x``, ``.x``) and empty ones are left out, a path that
    does not exist has no files, and a pattern may name files themselves.  A directory is listed by one
    task, which holds its names, and no directory below it is; deal very many files over directories.
    """
    return list_folders(spark, directories(spark, *patterns), opened)


def list_folders(spark: SparkSession, folders: Sequence[str], opened: Opened = open_path) -> DataFrame:
    """As ``list_files``, for directories or files that are there, as ``directories`` gives them."""
    rows = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), LISTERS) or 1)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for folder in (f for batch in batches for f in batch.column(0).to_pylist()):
            system, path, before = opened(folder)
            info = system.get_file_info(path)
            if info.type == fs.FileType.Directory:
                found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
            else:
                found = [info]
            files = [i for i in found if i.type == fs.FileType.File and i.size and not _hidden(i.base_name)]
            for some in (files[k : k + ROWS] for k in range(0, len(files), ROWS)):
                columns = [[before + i.path for i in some], [i.size for i in some], [i.mtime for i in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FILES)], schema=_FILES)

    return rows.mapInArrow(listed, FILES)


def tasks_for(files: DataFrame) -> int:
    """How many tasks the rows of ``list_files`` ask for, by their number and length."""
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).head()
    least = min(files.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_FILES))
    return max(1, least, -(-n // TASK_FILES), -(-size // TASK_BYTES))


def read_listed(
    files: DataFrame, tasks: int | None = None, opened: Opened = open_path, name: Callable[[str], str] | None = None
) -> DataFrame:
    """``value``, a file's whole text, ``path`` and ``arrived``, when it was written, for rows of ``list_files``.

    The files are dealt to ``tasks`` tasks, by default to as many as ``tasks_for`` finds.
    Batch or stream; a stream has to be told.  ``name`` says how ``path`` is written.  A file that has gone since is an error.
    """
    if tasks is None:
        tasks = tasks_for(files)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems: dict[str, tuple[fs.FileSystem, str, str]] = {}
        for batch in batches:
            texts, size, start = [], 0, 0
            for at, path in enumerate(batch.column(0).to_pylist()):
                # One client for all files of a file system.
                where = path[: path.find("/", path.find("://") + 3)] if "://" in path else "file:"
                if where not in systems:
                    systems[where] = opened(path)
                system, _, before = systems[where]
                with system.open_input_stream(path.removeprefix(before)) as stream:
                    texts.append(stream.read())
                size += len(texts[-1])
                if size >= BYTES or at + 1 == batch.num_rows:
                    rest = batch.slice(start, at + 1 - start)
                    named = pa.array([name(p) for p in rest.column(0).to_pylist()], pa.string()) if name else rest.column(0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(texts, pa.binary()), named, rest.column(2)], names=["value", "path", "modified"]
                    )
                    texts, size, start = [], 0, at + 1

    dealt = files.select("path", "length", "modified").repartition(tasks)
    found = dealt.mapInArrow(read, "value binary, path string, modified timestamp")
    return found.select(F.col("value").cast("string").alias("value"), "path", F.col("modified").alias("arrived"))


def note_new_files(spark: SparkSession, listing: str, *patterns: str, opened: Opened = open_path) -> int:
    """List the files that the patterns name now and add those not known yet to a table of files; how many.

    The table, ``listing``, is one of committed batches: a call adds one batch, wholly or not at all.  Only file names
    are compared, by a join.  Read its files with ``read_listed``, or let a stream follow them (``stream_listed_files``).
    """
    now = list_files(spark, *patterns, opened=opened).dropDuplicates(["path"])
    held = committed.entries(spark, listing)
    if held:
        now = now.join(committed.load(spark, listing).select("path"), "path", "left_anti").select(now.columns)
    number = held[-1].last + 1 if held else 0
    committed.commit(now, listing, number)
    added = committed.load_batch(spark, listing, number)
    return added.count() if added is not None else 0
