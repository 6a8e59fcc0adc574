"""Directories of raw mail files, one mail per file."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.operators.parse import parse_mail
from mailgauge.sources.listing import list_folders, read_listed, tasks_for
from mailgauge.sources.opened import Opened, open_path
from mailgauge.sources.scratch import delete, directories, exists, land, make_directory, rename

# Files are packed into scan tasks by size plus this cost per file.  Spark's
# default of 4 MiB fits big files; mails are a few KiB, and with the default a
# task would read about 30 of them.
OPEN_COST = "spark.sql.files.openCostInBytes"
MAIL_OPEN_COST = str(64 * 1024)

# Files of one directory that ``write_mail_files`` makes, and where they are until all are written.
FOLDER_FILES = 10_000
STAGED = "_staged"

# What Java escapes in the path of a URI.
_ESCAPED = re.compile(
    r"[^\w/!.~'()*:@&=+$,;\u00a1-\U0010ffff-]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def tune_for_mail_files(spark: SparkSession) -> None:
    """Session setting for scans of many small files (about 2,000 mails a task)."""
    spark.conf.set(OPEN_COST, MAIL_OPEN_COST)


def _plain(uri: Column) -> Column:
    """One form for the two in which a URI's scheme may be written."""
    return F.regexp_replace(uri, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _file_and_folder() -> tuple[Column, Column]:
    """Where a row was read: the file and the directory it lies in."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return _plain(path), _plain(F.regexp_replace(path, "/[^/]*$", ""))


def path_regex(pattern: str) -> str:
    """The regular expression for a path pattern of Hadoop: ``?``, ``*``, ``[a-c]``, ``[^a]``, ``{x,y}``, ``\\`` before a character."""
    out, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and (end := pattern.find("]", at + 2)) > 0:
            inner = pattern[at + 1 : end]
            denied = inner[0] in "^!"
            inner = "".join(f"\\{x}" if x in "\\[]^&" else x for x in (inner[1:] if denied else inner))
            out.append(f"[{'^' if denied else ''}{inner}]")
            at = end
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        at += 1
    return "".join(out)


def qualified(spark: SparkSession, path: str) -> str:
    """A path or pattern with its file system and from the root."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


def directly_matching(spark: SparkSession, pattern: str) -> Column:
    """Whether a row was read from a file that lies in a directory the pattern names, or that it names itself.

    Told from the names alone, so it holds for directories made later too.
    """
    file, folder = _file_and_folder()
    scheme, _, rest = qualified(spark, pattern).partition(":")
    whole = rf"\A{re.escape(scheme)}:/{path_regex(rest.lstrip('/'))}\z"
    return folder.rlike(whole) | file.rlike(whole)


def directly_in(folders: Sequence[str]) -> Column:
    """Whether a row was read from a file that lies in one of the folders, not below it."""
    file, parent = _file_and_folder()
    names = [_plain(F.lit(folder)) for folder in folders]
    return parent.isin(names) | file.isin(names) if names else F.lit(False)


def _scan(spark: SparkSession, folders: Sequence[str], endings: Sequence[str] | None = None) -> DataFrame:
    """Files of some folders by Spark's own scan, with ``endings`` only those whose names end so.

    The tree below each directory is listed, and only there: sub-directories
    named ``k=v`` would otherwise be taken for partitions.
    """
    files = spark.read.text(folders, wholetext=True, recursiveFileLookup=True).filter(directly_in(folders))
    path = F.col("_metadata.file_path")
    return (files if endings is None else files.filter(_ends(path, endings))).select("value", path.alias("path"))


def _ends(path: Column, endings: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.lower(path).endswith(e) for e in endings], F.lit(False))


def _compressed_endings(spark: SparkSession) -> list[str]:
    """What the names of files that Hadoop's readers decompress end with, in capitals or not."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension().lower() for c in codecs]


def file_path(path: str) -> str:
    """A path as Spark gives it in ``_metadata.file_path``, where characters that a URI may not have are escaped."""
    return _ESCAPED.sub(lambda m: quote(m[0], safe=""), path)


def read_mail_files(spark: SparkSession, *paths: str, opened: Opened | None = None) -> DataFrame:
    """``value``: a file's whole text, ``path``: where it is.

    Only files directly in the given directories; those in sub-directories,
    hidden ones (``_x``, ``.x``) and empty ones are left out.  A path that
    does not exist has no mails.  The files are those that are there now.

    Local files, and with ``opened`` those of all file systems (see ``list_files``), are listed and read by tasks, which
    get as many as their number and length ask for.  What is compressed, and other file systems, are left to Spark's
    scan: it lists on the driver and packs tasks by the session's settings (see ``tune_for_mail_files``).
    """
    folders = directories(spark, *paths)
    if not folders:
        return spark.createDataFrame([], "value string, path string")
    by_tasks = [f for f in folders if opened or f.startswith("file:")]
    scanned = [f for f in folders if f not in set(by_tasks)]
    found = [_scan(spark, scanned)] if scanned else []
    if by_tasks:
        opened, endings = opened or open_path, _compressed_endings(spark)
        listed = list_folders(spark, by_tasks, opened).dropDuplicates(["path"])
        # Told once for each file, and stored: the table is read by each of the steps below.
        files = land(listed.withColumn("compressed", _ends(F.col("path"), endings)))
        if not files.filter("compressed").isEmpty():
            found.append(_scan(spark, by_tasks, endings))
            files = files.filter("NOT compressed")
        found.append(read_listed(files, tasks_for(files), opened, file_path).select("value", "path"))
    return reduce(DataFrame.unionAll, found)


def read_mail(spark: SparkSession, *paths: str, **options) -> DataFrame:
    """The mails of some directories, parsed (see ``parse_mail`` for the options)."""
    return read_mail_files(spark, *paths).transform(parse_mail, **options)


def write_mail_files(
    raw: DataFrame, path: str, column: str = "value", folders: bool = False, opened: Opened = open_path
) -> None:
    """One file per row, written by tasks, in a new directory.  A line break is added at the end of a file; null is one.

    With ``folders=True`` the files lie in directories below ``path``, up to FOLDER_FILES in each: read ``path/*``, which
    many tasks list.  Files get into their places when all are written, so what a task that died has left is in none.
    What ``opened`` does not know is left to Spark's text sink, for which each file is a task's output to commit.
    """
    spark = raw.sparkSession
    if exists(spark, path):
        raise FileExistsError(f"{path} is there already")
    path, rows = path.rstrip("/"), raw.select(F.col(column).alias("value"))
    root = qualified(spark, path)
    try:
        opened(root)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        rows.write.option("maxRecordsPerFile", 1).text(f"{path}/0" if folders else path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base, _ = opened(root)
        attempt, written, made = uuid.uuid4().hex, 0, []
        for batch in batches:
            for value in batch.column(0):
                if written % FOLDER_FILES == 0:
                    made.append(f"{attempt}-{written // FOLDER_FILES}")
                    system.create_dir(f"{base}/{STAGED}/{made[-1]}")
                with system.open_output_stream(f"{base}/{STAGED}/{made[-1]}/{attempt}-{written}.txt") as stream:
                    stream.write((value.as_py() or b"") + b"\n")
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["folder"])

    def move_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base, _ = opened(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                # A task that is run again finds those left.
                for info in system.get_file_info(fs.FileSelector(f"{base}/{STAGED}/{folder}")):
                    system.move(info.path, f"{base}/{info.base_name}")
            yield batch

    made = [r.folder for r in rows.select(F.col("value").cast("binary")).mapInArrow(write, "folder string").collect()]
    # Also where there are no rows, something is there to be read.
    make_directory(spark, path if made or not folders else f"{path}/0")
    if folders:
        for number, folder in enumerate(sorted(made)):
            rename(spark, f"{path}/{STAGED}/{folder}", f"{path}/{number}")
    elif made:
        dealt = spark.createDataFrame([(f,) for f in made], "folder string").repartition(len(made))
        dealt.mapInArrow(move_up, "folder string").count()
    delete(spark, f"{path}/{STAGED}")
