"""Stored tables whose files disagree: what can be read is read, the rest is named.

A table that many jobs have written over the years holds files with other types, other columns or none at all, and one
of them fails the load of all.  Here tasks read the footers, files of one schema are read together, and each such
group is made a mail table column by column.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.schema import MANDATORY_COLUMNS, READ_SCHEMA
from mailgauge.sources.listing import Opened, list_files, open_path
from mailgauge.sources.scratch import land, remove

QUARANTINE = "path string, row long, reason string"
# Fixed value: what a Parquet file begins with.
MAGIC = b"PAR1"
# Files whose footers a task reads.
TASK_FILES = 200


def file_schemas(spark: SparkSession, *patterns: str, opened: Opened = open_path) -> DataFrame:
    """path, rows, schema, error of the Parquet files directly in some directories (or patterns), from their footers.

    ``schema`` is text that is equal for files with the same columns; it is null, and ``error`` says why, for a file
    that has no footer, or neither beginning nor length fit it.
    """
    files = list_files(spark, *patterns, opened=opened).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                system, name, _ = opened(path)
                try:
                    with system.open_input_file(name) as source:
                        footer = pq.ParquetFile(source).metadata
                        groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
                        columns = [g.column(i) for g in groups for i in range(g.num_columns)]
                        starts = [min(c.dictionary_page_offset or c.data_page_offset, c.data_page_offset) for c in columns]
                        ends = [start + c.total_compressed_size for start, c in zip(starts, columns)]
                        if source.read_at(4, 0) != MAGIC or max(ends, default=0) > source.size():
                            raise ValueError("not the data that its footer names")
                        fields = [(f.name, str(f.type)) for f in footer.schema.to_arrow_schema()]
                    found.append((path, footer.num_rows, json.dumps(fields), None))
                except (OSError, ValueError, pa.ArrowException) as error:
                    found.append((path, None, None, f"unreadable: {error}"[:500]))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            columns = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["path", "rows", "schema", "error"]
            )

    dealt = files.repartition(max(1, -(-files.count() // TASK_FILES)))
    return dealt.mapInArrow(read, "path string, rows long, schema string, error string")


def _conformed(rows: DataFrame) -> tuple[dict[str, Column], str | None]:
    """How each mail column comes from the columns there, or why it cannot."""
    there = {c.lower(): c for c in rows.columns}
    made: dict[str, Column] = {}
    for field in READ_SCHEMA:
        name = there.get(field.name.lower())
        if name is None:
            if field.name in MANDATORY_COLUMNS:
                return {}, f"no column {field.name}"
            made[field.name] = F.lit(None).cast(field.dataType)
            continue
        made[field.name] = F.col(f"`{name}`").try_cast(field.dataType)
        try:
            rows.select(made[field.name])
        except AnalysisException:
            return {}, f"{field.name} is {rows.schema[name].dataType.simpleString()}"
    return made, None


def load_checked(spark: SparkSession, *patterns: str, opened: Opened = open_path) -> tuple[DataFrame, DataFrame]:
    """(mails, quarantine) of the Parquet files directly in some directories or patterns, whatever their schemas.

    Columns are matched by name, ignoring case, and cast; ``Subject`` and ``Body`` may be absent.  The quarantine has path, row and
    reason: files that cannot be read or made a mail table, with row null, and single rows in which a value cannot be cast,
    such as a ``Date`` that is no date.  The driver gets the names of the files, as for any table, and their schemas.
    """
    known = land(file_schemas(spark, *patterns, opened=opened))
    bad = [(r.path, None, r.error) for r in known.filter("error IS NOT NULL").collect()]
    schemas = [r.schema for r in known.filter("error IS NULL").select("schema").distinct().collect()]

    mails = [spark.createDataFrame([], READ_SCHEMA)]
    rejected = []
    for schema in schemas:
        paths = [r.path for r in known.filter(F.col("schema") == F.lit(schema)).select("path").collect()]
        # Names are no patterns here.
        stored = spark.read.option("recursiveFileLookup", "true").parquet(*[_literal(p) for p in sorted(paths)])
        made, reason = _conformed(stored)
        if reason:
            bad += [(p, None, reason) for p in paths]
            continue
        there = {c.lower(): f"`{c}`" for c in stored.columns}
        lost = [
            F.when(F.col(there[name.lower()]).isNotNull() & value.isNull(), F.lit(f"{name} cannot be read"))
            for name, value in made.items()
            if name.lower() in there
        ]
        rows = stored.select(
            *[value.alias(name) for name, value in made.items()],
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.row_index").alias("row"),
            F.array_join(F.array_compact(F.array(*lost)), ", ").alias("reason"),
        )
        mails.append(rows.filter("reason = ''").select(*READ_SCHEMA.fieldNames()))
        rejected.append(rows.filter("reason <> ''").select("path", "row", "reason"))
    remove(known)
    named = spark.createDataFrame(bad, QUARANTINE)
    return reduce(DataFrame.unionAll, mails), reduce(DataFrame.unionAll, [named, *rejected])


def _literal(path: str) -> str:
    return "".join(f"\\{c}" if c in "{}[]*?\\," else c for c in path)
