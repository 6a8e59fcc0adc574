"""The mail table: one fixed schema, and the check that a frame has it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MAIL_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.StringType(), False),
        T.StructField("Date", T.TimestampType(), False),
        T.StructField("From", T.StringType(), False),
        T.StructField("Recipients", T.ArrayType(T.StringType()), False),
        T.StructField("Subject", T.StringType(), True),
        T.StructField("Body", T.StringType(), True),
    ]
)

MAIL_COLUMNS = MAIL_SCHEMA.fieldNames()

MANDATORY_COLUMNS = [f.name for f in MAIL_SCHEMA if not f.nullable]

# Stored files and parsed mails can hold nulls in any column, so frames are
# read and conformed with this relaxed form.  operators.parse.split_valid is
# what enforces the mandatory columns.
READ_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in MAIL_SCHEMA])


def to_mail_schema(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Turn any frame that has the mandatory columns into a mail table.

    Columns are matched by name (ignoring case), reordered and cast; extra
    columns but those in ``keep`` are dropped.  ``Subject`` and ``Body`` may be absent and are then
    null, a missing mandatory column is an error.
    """
    present = {name.lower() for name in df.columns}
    missing = [name for name in MANDATORY_COLUMNS if name.lower() not in present]
    if missing:
        raise ValueError(f"not a mail table, mandatory columns missing: {', '.join(missing)}")
    return df.to(T.StructType([*READ_SCHEMA, *[df.schema[c] for c in keep]]))
