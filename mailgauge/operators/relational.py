"""Filter, features, append, sort and top-n over the mail table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.functions.tokens import recipient_count, word_count, words
from mailgauge.schema import to_mail_schema


def in_interval(
    df: DataFrame, low: str, high: str, column: str = "Date", inclusive: str = "neither"
) -> DataFrame:
    """Rows dated between two bounds, both of them outside by default.

    Bounds are date or timestamp text, read in the session time zone; a plain
    date is its midnight.  Both comparisons reach the Parquet scan.
    """
    if inclusive not in ("neither", "low", "high", "both"):
        raise ValueError(f"inclusive must be neither, low, high or both, not {inclusive!r}")
    date = F.col(column)
    low_bound, high_bound = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    above = date >= low_bound if inclusive in ("low", "both") else date > low_bound
    below = date <= high_bound if inclusive in ("high", "both") else date < high_bound
    return df.filter(above & below)


def with_features(df: DataFrame, lines_kept: bool = False) -> DataFrame:
    """Adds ``Words``, ``WordCount`` and ``RecipientsCount``."""
    return df.withColumns(
        {
            "Words": words(F.col("Body"), lines_kept),
            "WordCount": word_count(F.col("Body"), lines_kept),
            "RecipientsCount": recipient_count(F.col("Recipients")),
        }
    )


# Where a row was read: ``load_parquet(..., positions=True)`` adds these columns, with these types.
POSITION = {"_file": "string", "_row": "bigint"}


def append_mail(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all tables, repeats kept.  No shuffle.  POSITION columns stay if every table has them."""
    tables = [first, *others]
    kept = [c for c in POSITION if all(c in t.columns for t in tables)]
    return reduce(DataFrame.unionAll, [to_mail_schema(t, kept) for t in tables])


def order_by_date(df: DataFrame, then_by: Sequence[str | Column] = ("ID",)) -> DataFrame:
    """Total sort, oldest first, undated mails before all others.

    ``then_by`` orders mails of the same instant, and the POSITION columns, if
    there, copies of the same mail; they are not returned.  Both let the
    range partitioner cut between such mails, so that a crowded instant is
    spread over tasks.
    """
    position = [c for c in POSITION if c in df.columns]
    return df.orderBy("Date", *then_by, *position).drop(*position)


def query_view(df: DataFrame, query: str, view: str) -> DataFrame:
    """SQL over a frame that goes by the name ``view`` in it; the view is gone afterwards.

    The name must not be that of a view the session has: that one would be replaced.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(view):
        raise ValueError(f"there is a table or view {view} already")
    df.createTempView(view)
    try:
        return spark.sql(query)
    finally:
        spark.catalog.dropTempView(view)


def top_n(df: DataFrame, measure: str, key: str, n: int = 5) -> DataFrame:
    """The n rows with the largest measure, ties broken by key.

    Each task keeps its own n best, nothing is sorted as a whole.
    """
    return df.orderBy(F.desc(measure), F.asc(key)).limit(n)
