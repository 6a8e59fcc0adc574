"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Narrow rows of a file, where partitions would make more and smaller files.
FILE_ROWS = 1 << 16

# Temporary folders of local sessions, by application.
_local: dict[str, str] = {}
# Tables that ``land`` has written and that are still there.
_landed: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, only a local session gets a temporary folder; on a
    cluster a folder of one machine is no use to the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local:
            _local[context.applicationId] = tempfile.mkdtemp(prefix="mailgauge-")
        base = _local[context.applicationId]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def land(df: DataFrame, by: str | None = None) -> DataFrame:
    """The frame written as a Parquet table and read back: computed once, lineage cut.

    ``by`` names the last column if the table is to have a directory for each of its values.
    The table stays as long as something may read it: until ``remove``, or
    until the Python process ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path, partitionBy=by)
    if not _landed:
        atexit.register(_remove_all, spark)
    _landed.add(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """A frame of at most about ``rows`` narrow rows, in no more partitions than these ask for.

    A partition becomes a file, and for each file that a task makes Hadoop's
    local file system starts processes that are, for a moment, as large as the
    executor.  The number of shuffle partitions is a session's, for its
    largest shuffles; adaptive execution joins small ones only where that is on.
    """
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


def remove(landed: DataFrame) -> None:
    """Delete the table behind a landed frame; nothing may read it any more."""
    named = {part for file in landed.inputFiles() for part in file.split("/")}
    for path in [p for p in _landed if p.rpartition("/")[2] in named]:
        delete(landed.sparkSession, path)


def _located(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop objects."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(context._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or directory of that name in any file system that Spark reads."""
    system, hadoop = _located(spark, path)
    return system.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or directory with all in it, in any file system that Spark reads."""
    system, hadoop = _located(spark, path)
    system.delete(hadoop, True)
    _landed.discard(path)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Give a directory another name; one step where the file system has such a step."""
    system, hadoop = _located(spark, path)
    _, named = _located(spark, target)
    system.mkdirs(named.getParent())
    if not system.rename(hadoop, named):
        raise OSError(f"cannot rename {path} to {target}")


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file of that name, which either is there or is not: nobody sees it half written."""
    system, hadoop = _located(spark, path)
    system.create(hadoop, True).close()


def make_directory(spark: SparkSession, path: str) -> None:
    """A directory of that name, with those above it."""
    system, hadoop = _located(spark, path)
    system.mkdirs(hadoop)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories in a directory, none where there is no such directory."""
    system, hadoop = _located(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop)) if system.exists(hadoop) else []


def directories(spark: SparkSession, *paths: str) -> list[str]:
    """The existing directories (or files) that some paths or patterns name, as full URIs."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in map(hadoop, paths):
        found += [s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []]
    return found


def _remove_all(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # a stopped session leaves its tables to whoever owns the folder
        for path in list(_landed):
            delete(spark, path)
