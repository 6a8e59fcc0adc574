"""Words of a body and the two counts the averages are made of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(body: Column, lines_kept: bool = False) -> Column:
    """Tokens of a body: cut at single spaces, empty tokens dropped.

    Tabs and line breaks do not separate words.  A body that was parsed with
    its line breaks kept needs ``lines_kept=True``, which cuts at any run of
    whitespace.
    """
    return F.array_remove(F.split(body, r"\s+" if lines_kept else " "), "")


def word_count(body: Column, lines_kept: bool = False) -> Column:
    """Number of ``words(body)``; a null body has none.

    Where no two spaces stand together, there is one word more than spaces, and nothing has to be cut.
    """
    cut = F.size(words(body, lines_kept))
    if not lines_kept:
        inner = F.trim(body)
        spaces = F.octet_length(inner) - F.octet_length(F.replace(inner, F.lit(" "), F.lit("")))
        cut = F.when(inner == "", 0).when(F.contains(inner, F.lit("  ")), cut).otherwise(spaces + 1)
    return F.coalesce(cut, F.lit(0))


def recipient_count(recipients: Column) -> Column:
    return F.coalesce(F.size(recipients), F.lit(0))
