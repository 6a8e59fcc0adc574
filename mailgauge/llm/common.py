"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of text that a Python task works on at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20

# Fixed value: the blanks that separate words.
BLANKS = " \t\n\x0b\x0c\r"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def in_fold(column: str, folds: int, fold: int) -> Column:
    """Whether a row is of that fold.  A null id is of no fold."""
    return F.coalesce(fold_of(column, folds) == fold, F.lit(False))


def outside_fold(column: str, folds: int, fold: int) -> Column:
    """Whether a row is of another fold.  A null id is of no fold, so nothing is learned from it."""
    return F.coalesce(fold_of(column, folds) != fold, F.lit(False))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    is_ascii = F.octet_length(column) == F.char_length(column)
    return F.when(is_ascii, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without columns that would clash with those about to be added."""
    taken = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def numbered(df: DataFrame) -> DataFrame:
    """The frame with its columns named by position, ``c0`` and so on, so that no added name can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def position(df: DataFrame, column: str) -> str:
    """The name that ``numbered`` gives a column."""
    lowered = [c.lower() for c in df.columns]
    return f"c{lowered.index(column.lower())}"


def pieces(batch: pa.RecordBatch, index: int) -> Iterator[pa.RecordBatch]:
    """A batch cut between rows so that each piece has about PIECE_BYTES of the text column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start, before = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def add_columns(
    df: DataFrame, text: str, added: str, prepare: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]]
) -> DataFrame:
    """``df`` and new columns that Python works out from a text column, batch by batch.

    ``added`` is the schema of the new columns; a column of ``df`` with one of
    those names is replaced.  ``prepare`` runs once in a task and returns what
    turns a piece of the text column into arrays of the new columns.
    """
    new = StructType.fromDDL(added)
    df = without(df, [f for f in new.fieldNames() if f.lower() != text.lower()])
    schema = StructType([*df.schema.fields, *new.fields])
    index = df.columns.index(text)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for batch in batches:
            for piece in pieces(batch, index):
                columns = [*piece.columns, *compute(piece.column(index))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def map_texts(
    df: DataFrame, schema: str, prepare: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], text: str
) -> DataFrame:
    """Any number of rows for each piece of ``df``; the function may add a method ``finish`` for the last ones."""
    index = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for piece in pieces(batch, index):
                yield from work(piece)
        if hasattr(work, "finish"):
            yield from work.finish()

    return df.mapInArrow(run, schema)


def strings(texts: pa.Array) -> list[str]:
    """Python strings; null is empty, and bytes that are no UTF-8 become U+FFFD."""
    return ["" if t is None else t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()]


class Words:
    """The words of a piece of texts, split at blanks, A-Z lowered unless told otherwise.

    ``flat``: all words, ``first``: where each row's words begin in it (one entry more than rows).
    A null text has no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
        if lower:
            trimmed = pc.ascii_lower(trimmed)
        lists = pc.ascii_split_whitespace(trimmed)
        counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        empty = pc.equal(pc.binary_length(trimmed), 0).to_numpy(zero_copy_only=False)
        if empty.any():  # an empty text is split into one empty word
            flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
            counts = np.where(empty, 0, counts)
        self.flat = flat
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
