"""Tables that grow by numbered batches, each of which is in the table wholly or not at all.

Batch ``n`` is the directory ``batch_id=<n>``, and becomes part of the table by an entry in the log: an empty file whose
name says which batches it stands for.  With ``fan_in`` so many directories are merged into one, which is written beside
them and takes their place by an entry of its own; merged ones are merged again, so that the directories left, and the
entries, grow with the logarithm of the batches.  A row is rewritten once for each such level.

What a merge has replaced is deleted by the next merge, so that who has begun to read it can end.

Directories are written aside and get their names when they are whole.  So without merging a stream may read the
table as a directory of files: it meets every row once.  What a writer that dies leaves is overwritten, or given its
entry, when the step is done again.  There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mailgauge.sources.scratch import create_empty, delete, exists, names_in, rename

BATCH = "batch_id"
# Names that start with an underscore are no data to who reads the directory as it is.
LOG = "_log"
MERGED = "_merged"
STAGED = "_staged"
# An entry of batches without any row, which have no directory.
NOTHING = ".none"

Combine = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True, order=True)
class Entry:
    """Batches first to last are in the table."""

    first: int
    last: int
    empty: bool = False

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}{NOTHING if self.empty else ''}"

    @property
    def directory(self) -> str:
        return f"{BATCH}={self.first}" if self.first == self.last else f"{MERGED}/{self.first}-{self.last}"

    def holds(self, batch_id: int) -> bool:
        return self.first <= batch_id <= self.last


def _noted(spark: SparkSession, path: str) -> list[Entry]:
    """All entries of the log, also those that a merge has replaced."""
    found = []
    for name in names_in(spark, f"{path}/{LOG}"):
        first, last = name.removesuffix(NOTHING).split("-")
        found.append(Entry(int(first), int(last), name.endswith(NOTHING)))
    return sorted(found)


def _current(noted: list[Entry]) -> list[Entry]:
    """Entries that none of a longer span stands for."""
    found: list[Entry] = []
    for entry in sorted(noted, key=lambda e: (e.first, -e.last)):
        if not found or entry.first > found[-1].last:
            found.append(entry)
    return found


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What the table consists of, in order of the batches."""
    return _current(_noted(spark, path.rstrip("/")))


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return any(e.holds(batch_id) for e in entries(spark, path))


def adopt(spark: SparkSession, path: str) -> None:
    """Start a log for a directory that was written without one."""
    path = path.rstrip("/")
    if names_in(spark, f"{path}/{LOG}"):
        return
    numbers = {int(n.partition("=")[2]) for n in names_in(spark, path) if n.startswith(f"{BATCH}=")}
    for n in range(max(numbers, default=-1) + 1):
        create_empty(spark, f"{path}/{LOG}/{Entry(n, n, n not in numbers).name}")


def commit(
    rows: DataFrame, path: str, batch_id: int, fan_in: int | None = None, combine: Combine | None = None
) -> bool:
    """Make the rows batch ``batch_id`` of the table; False, and ``rows`` not computed, if they are there already.

    Batches are numbered from 0 without gaps.  One without rows leaves no directory, but for the first, which has the schema.
    ``fan_in`` (at least 2) merges whenever so many directories of one size are there; ``combine`` then turns the
    rows of several batches, with ``batch_id``, into fewer.
    """
    spark, path, rows = rows.sparkSession, path.rstrip("/"), rows.drop(BATCH)
    held = entries(spark, path)
    if any(e.holds(batch_id) for e in held):
        _merge(spark, path, fan_in, combine)
        return False
    if batch_id != (held[-1].last + 1 if held else 0):
        raise ValueError(f"{path} ends with batch {held[-1].last if held else None}, {batch_id} cannot follow")
    entry = Entry(batch_id, batch_id)
    target, staged = f"{path}/{entry.directory}", f"{path}/{STAGED}/{entry.name}"
    written = not exists(spark, target)
    if written:
        rows.write.mode("overwrite").parquet(staged)
        # What was written is looked at, as computing the rows once more may cost much.
        if batch_id and spark.read.schema(rows.schema).parquet(staged).isEmpty():
            entry = Entry(batch_id, batch_id, True)
            delete(spark, staged)
        else:
            rename(spark, staged, target)
    create_empty(spark, f"{path}/{LOG}/{entry.name}")
    _merge(spark, path, fan_in, combine)
    return written


def _merge(spark: SparkSession, path: str, fan_in: int | None, combine: Combine | None) -> None:
    """Every merge that is due, small ones first."""
    if fan_in is None:
        return
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    noted = _noted(spark, path)
    span, last = fan_in, max((e.last for e in noted), default=-1)
    while span <= last + 1:
        current = _current(noted)
        # Spans are aligned, so the same batches are merged whenever this is run.
        for first in sorted({e.first // span * span for e in current}):
            parts = [e for e in current if first <= e.first and e.last < first + span]
            if len(parts) > 1 and parts[-1].last == first + span - 1 and parts[0].first == first:
                replaced = [e for e in noted if e not in current]
                merged = _merge_into(spark, path, Entry(first, first + span - 1), parts, combine)
                for old in replaced:
                    delete(spark, f"{path}/{old.directory}")
                    delete(spark, f"{path}/{LOG}/{old.name}")
                noted = sorted([*[e for e in noted if e not in replaced], merged])
                current = _current(noted)
        span *= fan_in


def _merge_into(spark: SparkSession, path: str, entry: Entry, parts: list[Entry], combine: Combine | None) -> Entry:
    if all(e.empty for e in parts):
        entry = Entry(entry.first, entry.last, True)
    else:
        rows = _read(spark, path, parts)
        if combine:
            rows = combine(rows)
            rows = rows if BATCH in rows.columns else rows.withColumn(BATCH, F.lit(entry.last).cast("long"))
        staged = f"{path}/{STAGED}/{entry.name}"
        rows.hint("rebalance").write.mode("overwrite").parquet(staged)
        delete(spark, f"{path}/{entry.directory}")
        rename(spark, staged, f"{path}/{entry.directory}")
    create_empty(spark, f"{path}/{LOG}/{entry.name}")
    return entry


def _read(spark: SparkSession, path: str, parts: list[Entry]) -> DataFrame:
    filled = [e for e in parts if not e.empty]
    single = [f"{path}/{e.directory}" for e in filled if e.first == e.last]
    merged = [f"{path}/{e.directory}" for e in filled if e.first != e.last]
    columns = [f for f in spark.read.parquet((single + merged)[0]).schema if f.name != BATCH]
    schema = StructType([*columns, StructField(BATCH, LongType())])
    read = [spark.read.schema(schema).option("basePath", path).parquet(*single)] if single else []
    read += [spark.read.schema(schema).parquet(*merged)] if merged else []
    return reduce(DataFrame.unionByName, read)


def load(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table, with ``batch_id`` last."""
    path = path.rstrip("/")
    held = entries(spark, path)
    if all(e.empty for e in held):
        raise FileNotFoundError(f"{path} has no batches")
    return _read(spark, path, held)


def load_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The rows of one batch that has not been combined with others, None if it has none."""
    path = path.rstrip("/")
    found = [e for e in entries(spark, path) if e.holds(batch_id)]
    if not found:
        raise LookupError(f"{path} has no batch {batch_id}: its log does not name it")
    if found[0].empty:
        return None
    rows = _read(spark, path, found)
    if found[0].first == found[0].last:
        return rows
    rows = rows.filter(F.col(BATCH) == F.lit(batch_id))
    return None if rows.isEmpty() else rows


def load_last(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch that has any; only its directory is read."""
    path = path.rstrip("/")
    filled = [e for e in entries(spark, path) if not e.empty]
    if not filled:
        raise FileNotFoundError(f"{path} has no batches")
    rows = _read(spark, path, filled[-1:])
    if filled[-1].first == filled[-1].last:
        return rows
    last = rows.agg(F.max(BATCH)).head()[0]
    return rows.filter(F.col(BATCH) == F.lit(last))
