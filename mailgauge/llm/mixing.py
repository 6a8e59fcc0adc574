"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.llm.common import UPPER, lower_ascii, numbered, position
from mailgauge.sources.scratch import land, remove

DIMENSIONS = ("source", "lang", "topic")
TOKEN = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column, words: Column) -> Column:
    """A coarse topic from the form of a text of so many words, by the first rule that holds.

    ``empty`` without any letter or digit, ``table`` with a bar for every
    eighth word or more, ``numeric`` with a digit for every word or more,
    ``brief`` below 100 words, else ``prose``.
    """
    bars = F.char_length(text) - F.char_length(F.replace(text, F.lit("|"), F.lit("")))
    return (
        F.when(~F.coalesce(text, F.lit("")).rlike(r"[\p{L}\p{N}]"), "empty")
        .when(bars * 8 >= words, "table")
        .when(F.regexp_count(text, F.lit("[0-9]")) >= words, "numeric")
        .when(words < 100, "brief")
        .otherwise("prose")
    )


def topic_by_terms(text: Column, topics: Mapping[str, Sequence[str]], otherwise: Column | None = None) -> Column:
    """The topic whose terms a text has most often, of equally frequent ones the first given.

    Terms are words or phrases, in any case (A-Z), that have no letter or digit on either side; each occurrence counts.
    A text with none of them, and a null text, gets ``otherwise``: null, or an expression such as ``topic_of``.
    """
    lowered = lower_ascii(F.coalesce(text, F.lit("")))
    counts = []
    for place, (name, terms) in enumerate(topics.items()):
        # Longer terms first, as an alternation takes the first that fits.
        quoted = "|".join(re.escape(t.translate(_LOWER)) for t in sorted(terms, key=len, reverse=True) if t)
        if quoted:
            pattern = rf"(?<![\p{{L}}\p{{N}}])(?:{quoted})(?![\p{{L}}\p{{N}}])"
            n = F.regexp_count(lowered, F.lit(pattern))
            counts.append(F.struct(n.alias("n"), F.lit(-place).alias("place"), F.lit(name).alias("name")))
    otherwise = F.lit(None).cast("string") if otherwise is None else otherwise
    if not counts:
        return otherwise
    best = F.array_max(F.array(*counts))
    return F.when(best["n"] > 0, best["name"]).otherwise(otherwise)


_LOWER = {ord(c): c.lower() for c in UPPER}


@dataclass
class Targets:
    """What share of the tokens each value of a dimension is to have.

    ``shares`` may name values of a dimension and their weights.  A value not
    named, and every value of a dimension not in ``shares``, weighs its own
    share of the tokens to the power ``flatten``: 1 leaves the mix, 0 makes
    all values equal.  ``keep`` is the share of all tokens to be sampled.
    """

    flatten: float = 0.7
    keep: float = 0.5
    shares: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    tolerance: float = 1e-3
    rounds: int = 10


def count_cells(docs: DataFrame) -> DataFrame:
    """source, lang, topic, tokens, docs; sums are taken before the shuffle."""
    return docs.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))


def with_target(cells: DataFrame, targets: Targets, dimension: str, total: float) -> DataFrame:
    """``cells`` with the target share of their value in one dimension; the shares of all values add up to 1."""
    value = F.col(dimension)
    weight = F.pow(F.sum("tokens") / total, F.lit(float(targets.flatten)))
    for named, wanted in targets.shares.get(dimension, {}).items():
        weight = F.when(value == named, F.lit(float(wanted))).otherwise(weight)
    weights = cells.groupBy(value.alias("value")).agg(weight.alias("share"))
    whole = weights.agg(F.sum("share")).head()[0]
    goal = weights.select("value", (F.col("share") / whole).alias(f"goal_{dimension}"))
    return cells.join(goal, value.eqNullSafe(F.col("value"))).drop("value")


def rake(cells: DataFrame, targets: Targets) -> DataFrame:
    """``cells`` that have tokens, with ``weight``: a share of the sample, by target marginals.

    A round scales the weights to one dimension after the other, then cuts a
    weight to ``most``, what its cell can give; the following round makes
    up for that in other cells.  A round ends in a stored table of one row
    per cell.  Rounds end when every marginal is within the tolerance, or
    after ``targets.rounds`` where targets contradict each other or ask for
    more than there is.  Null is a value like any other.  Margins are window
    sums over the cells, of which there are few beside the documents.
    """
    whole = cells.filter("tokens > 0")
    total = whole.agg(F.coalesce(F.sum("tokens"), F.lit(0))).head()[0]
    if not total:
        return whole.withColumns({"weight": F.lit(0.0), "most": F.lit(1.0)})
    current = whole
    for d in DIMENSIONS:
        current = with_target(current, targets, d, float(total))
    share = F.col("tokens") / float(total)
    stored = current = land(current.withColumns({"weight": share, "most": share / targets.keep}))
    for _ in range(targets.rounds):
        current = current.withColumn("off", F.lit(0.0))
        for d in DIMENSIONS:
            factor = F.col(f"goal_{d}") / F.sum("weight").over(Window.partitionBy(d))
            current = current.withColumn("factor", factor).withColumns(
                {
                    "weight": F.col("weight") * F.col("factor"),
                    "off": F.greatest("off", F.abs(F.col("factor") - 1)),
                }
            )
        before, current = stored, land(current.withColumn("weight", F.least("weight", "most")))
        stored = current
        remove(before)
        if current.agg(F.max("off")).head()[0] <= targets.tolerance:
            break
        current = current.drop("off", "factor")
    return current


def keep_probabilities(docs: DataFrame, targets: Targets) -> DataFrame:
    """source, lang, topic, weight, probability, by cell.

    A cell's probability is what its weight asks for against what it has, so
    that ``targets.keep`` of all tokens are kept in expectation, in the target mix.
    """
    cells = rake(land(count_cells(docs)), targets)
    return cells.select(*DIMENSIONS, "weight", (F.col("weight") / F.col("most")).alias("probability"))


def share_report(
    docs: DataFrame,
    targets: Targets | None = None,
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
) -> DataFrame:
    """dimension, value, wanted, reached, possible, met: what ``mix`` makes of its targets, a row for each value.

    ``wanted`` is the target share of the sample's tokens, ``reached`` the share that its probabilities give in expectation,
    and ``possible`` what the value would have if all its documents were taken.  A value is ``met`` if it is within the
    tolerance, as a share of ``wanted``.  Where targets ask for more than there is, or contradict each other, some are not, and
    ``reached`` adds up to less than 1: the sample is smaller then.
    """
    targets = targets or Targets()
    described = _described(docs, source, text, source, lang, topic)
    cells = land(rake(land(count_cells(described.select(*DIMENSIONS, "tokens"))), targets))
    parts = []
    for d in DIMENSIONS if f"goal_{DIMENSIONS[0]}" in cells.columns else ():
        sums = cells.groupBy(F.col(d).cast("string").alias("value")).agg(
            F.first(f"goal_{d}").alias("wanted"), F.sum("weight").alias("reached"), F.sum("most").alias("possible")
        )
        met = F.abs(F.col("reached") - F.col("wanted")) <= targets.tolerance * F.col("wanted")
        parts.append(sums.select(F.lit(d).alias("dimension"), "value", "wanted", "reached", "possible", met.alias("met")))
    none = docs.sparkSession.createDataFrame(
        [], "dimension string, value string, wanted double, reached double, possible double, met boolean"
    )
    return reduce(DataFrame.unionAll, parts, none)


def _described(docs: DataFrame, doc_id: str, text: str, source: str, lang: str, topic: Column | None) -> DataFrame:
    body = F.col(position(docs, text))
    counted = numbered(docs).withColumn("tokens", F.coalesce(F.regexp_count(body, F.lit(TOKEN)), F.lit(0)).cast("long"))
    return counted.withColumns(
        {
            "id": F.col(position(docs, doc_id)),
            "source": F.col(position(docs, source)),
            "lang": F.col(position(docs, lang)),
            "topic": topic_of(body, F.col("tokens")) if topic is None else topic,
            "draw": F.shiftrightunsigned(F.xxhash64(F.col(position(docs, doc_id)), F.lit("mix")), 11) / float(1 << 53),
        }
    )


def mix(
    docs: DataFrame,
    targets: Targets | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, selected: the whole table and the sample from it.

    Whether a document is selected depends on its id and its cell's
    probability alone, so a lost task repeats its choice, and rows of equal
    id and cell go the same way.  Documents without tokens weigh nothing and
    are never selected (weight and probability 0).  Long texts count whole, and a
    table without rows or without tokens gives no or no selected rows.  Null in source or lang is
    a value of its own.  ``topic`` is an expression over the columns named by
    position (``c0`` ...); without it ``topic_of`` is used.
    """
    described = _described(docs, doc_id, text, source, lang, topic)
    narrow = land(described.select("id", *DIMENSIONS, "tokens", "draw"))
    return _joined(narrow, keep_probabilities(narrow, targets or Targets())).select(
        F.col("id").alias("doc_id"),
        *DIMENSIONS,
        F.col("tokens").alias("n_tokens"),
        "weight",
        "probability",
        (F.col("draw") < F.col("probability")).alias("selected"),
    )


def _joined(described: DataFrame, probabilities: DataFrame) -> DataFrame:
    cells = probabilities.toDF(*[f"cell_{c}" for c in probabilities.columns])
    same = [described[d].eqNullSafe(cells[f"cell_{d}"]) for d in DIMENSIONS]
    none = F.lit(0.0)
    # A document without tokens may lie in a cell that has some.
    counted = described.join(cells, same, "left").withColumns(
        {
            "weight": F.when(F.col("tokens") > 0, F.col("cell_weight")).otherwise(none),
            "probability": F.when(F.col("tokens") > 0, F.col("cell_probability")).otherwise(none),
        }
    )
    return counted.drop(*cells.columns)


def sample_mix(docs: DataFrame, targets: Targets | None = None, **columns) -> DataFrame:
    """The rows of ``docs`` that ``mix`` selects, all columns as they are."""
    named = {"doc_id": "doc_id", "text": "text", "source": "source", "lang": "lang", "topic": None} | columns
    described = _described(docs, **named)
    cells = keep_probabilities(described.select(*DIMENSIONS, "tokens"), targets or Targets())
    kept = _joined(described, cells).filter("draw < probability")
    return kept.select(numbered(docs).columns).toDF(*docs.columns)
