"""Dropping lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import BLANKS, lower_ascii, numbered, position
from mailgauge.sources.scratch import land

MIN_DOCS = 10
MIN_CHARS = 1


def line_keys(text: Column) -> Column:
    """The lines of a text (null is one empty line), A-Z lowered and without blanks at both ends."""
    lines = F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n", -1)
    return F.transform(lines, lambda line: F.trim(line, F.lit(BLANKS)))


def line_hashes(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """Two hashes for each line, of which neither tells the other; null for one whose key is too short to be dropped."""
    return F.transform(
        line_keys(text), lambda key: F.when(F.char_length(key) >= min_chars, F.struct(*_two_hashes(key)))
    )


def _two_hashes(value: Column) -> list[Column]:
    # A hash that went on from the first would be no second one, so the second begins with a constant.
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]


def common_lines(hashed: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """hash: lines found in at least ``min_docs`` rows.

    A row's repeats are dropped within the row, and rows are counted before
    the shuffle: a line in a third of all rows is one number per task.
    """
    once = hashed.select(F.explode(F.array_distinct(F.array_compact("hashes"))).alias("hash"))
    return once.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("hash")


def drop_common_lines(
    docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` with columns named by position, and kept (the text without common lines), n_lines, n_dropped.

    Every row is a document, also a repeated one.  A line is compared by its
    key (see ``line_keys``); keys of fewer than ``min_chars`` characters stay.
    Of a null text one empty line is kept, as of an empty one.

    Which lines of a text go depends on the text alone, so places are
    gathered by a pair of hashes of the text, once for equal texts, and
    joined to the rows.  Only lines' hashes and places are exploded.  An
    empty table gives no rows.
    """
    body = F.col(position(docs, text))
    identity = dict(zip(("h1", "h2"), _two_hashes(body)))
    hashed = land(
        numbered(docs).select(
            *[value.alias(name) for name, value in identity.items()], line_hashes(body, min_chars).alias("hashes")
        )
    )
    # What is joined is stored, so that adaptive execution can split the rows of a very common line or text.
    common = land(common_lines(hashed, min_docs))
    places = land(
        hashed.dropDuplicates(["h1", "h2"])
        .select("h1", "h2", F.posexplode("hashes").alias("place", "hash"))
        .join(common, "hash", "left_semi")
        .groupBy("h1", "h2")
        .agg(F.collect_list("place").alias("places"))
    )
    rows = numbered(docs).withColumns(identity).join(places, ["h1", "h2"], "left")
    lines = F.split(F.coalesce(body, F.lit("")), "\n", -1)
    dropped = F.coalesce("places", F.array().cast("array<int>"))
    # The places of a long text are looked up in a map, not searched line by line.
    lookup = F.map_from_arrays(dropped, F.transform(dropped, lambda _: F.lit(True)))
    kept = F.filter(lines, lambda line, place: F.try_element_at(F.col("lookup"), place).isNull())
    return (
        rows.withColumn("lookup", lookup)
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.size(dropped).cast("long"))
        .withColumn("kept", F.when(F.size(dropped) == 0, F.coalesce(body, F.lit(""))).otherwise(F.array_join(kept, "\n")))
        .drop("lookup", "places", "h1", "h2")
    )


def line_dedup_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row (see ``drop_common_lines``)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return drop_common_lines(base).select(
        F.col("c0").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
