"""Mixing by iterative proportional fitting, against the textbook loop."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mailgauge.llm import mixing
from mailgauge.llm.queries import QUERIES


def fitted(cells, targets, keep, rounds):
    """{cell: weight}: the same fitting in plain Python."""
    total = sum(cells.values())
    weight = {c: t / total for c, t in cells.items()}
    for _ in range(rounds):
        for d in range(3):
            sums = defaultdict(float)
            for c, w in weight.items():
                sums[c[d]] += w
            weight = {c: w * targets[d][c[d]] / sums[c[d]] for c, w in weight.items()}
        weight = {c: min(w, cells[c] / total / keep) for c, w in weight.items()}
    return weight


def flattened(cells, power):
    goals = []
    for d in range(3):
        sums = defaultdict(float)
        for c, t in cells.items():
            sums[c[d]] += t
        whole = sum((s / sum(cells.values())) ** power for s in sums.values())
        goals.append({v: (s / sum(cells.values())) ** power / whole for v, s in sums.items()})
    return goals


def cells_of(rows):
    cells = defaultdict(int)
    for r in rows:
        if r.n_tokens:
            cells[(r.source, r.lang, r.topic)] += r.n_tokens
    return cells


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op5_source_mixing"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.n_tokens == len(docs[r.doc_id].text.split()) for r in rows)
    cells = cells_of(rows)
    options = mixing.Targets()
    expected = fitted(cells, flattened(cells, options.flatten), options.keep, options.rounds)
    for r in rows:
        if r.n_tokens:
            cell = (r.source, r.lang, r.topic)
            assert r.weight == pytest.approx(expected[cell], abs=2e-4)
            most = cells[cell] / sum(cells.values()) / options.keep
            assert r.probability == pytest.approx(r.weight / most) and 0 < r.probability <= 1 + 1e-9
    assert 0 < sum(r.selected for r in rows) < len(rows)


def test_marginals_are_met_where_they_can_be(spark):
    rows = [(i, "w " * 10, "ab"[i % 5 == 0], "xy"[i % 3 == 0]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = mixing.Targets(shares={"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.4, "y": 0.6}}, keep=0.25)
    mixed = mixing.mix(docs, targets).collect()
    kept = [r for r in mixed if r.selected]
    assert sum(r.source == "a" for r in kept) / len(kept) == pytest.approx(0.5, abs=0.04)
    assert sum(r.lang == "x" for r in kept) / len(kept) == pytest.approx(0.4, abs=0.04)
    assert len(kept) == pytest.approx(1500, rel=0.1)
    again = {r.doc_id for r in mixing.mix(docs.repartition(7), targets).filter("selected").collect()}
    assert again == {r.doc_id for r in kept}
    sampled = mixing.sample_mix(docs, targets)
    assert sampled.columns == docs.columns and {r.doc_id for r in sampled.collect()} == again


def test_awkward_rows(awkward, no_documents):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r.n_tokens == 0:
            assert (r.weight, r.probability, r.selected) == (0, 0, False)
        else:
            assert 0 < r.probability <= 1 + 1e-9
    sampled = mixing.sample_mix(awkward)
    assert sampled.columns == awkward.columns
    assert mixing.mix(no_documents).count() == 0 and mixing.sample_mix(no_documents).count() == 0


def test_report_of_shares(spark, awkward, no_documents):
    """Targets that can be met are; one that asks for more than there is gets all there is, and is told."""
    rows = [(i, "w " * 10, "ab"[i % 10 == 0], "xy"[i % 2]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    can = mixing.Targets(shares={"source": {"a": 0.85, "b": 0.15}, "lang": {"x": 0.4, "y": 0.6}}, keep=0.5, rounds=50)
    report = {(r.dimension, r.value): r for r in mixing.share_report(docs, can).collect()}
    assert set(report) == {("source", "a"), ("source", "b"), ("lang", "x"), ("lang", "y"), ("topic", "brief")}
    assert all(r.met and r.reached <= r.possible for r in report.values())
    assert report["lang", "y"].wanted == pytest.approx(0.6)
    cannot = mixing.Targets(shares={"source": {"a": 0.5, "b": 0.5}}, keep=0.5)
    report = {(r.dimension, r.value): r for r in mixing.share_report(docs, cannot).collect()}
    scarce = report["source", "b"]
    assert not scarce.met and scarce.reached == pytest.approx(scarce.possible, rel=0.05) and scarce.possible == pytest.approx(0.2)
    # The same shares as in the sample.
    mixed = mixing.mix(docs, cannot).filter("source = 'b'").agg({"probability": "sum"}).head()[0]
    assert mixed / (4000 * 0.5) == pytest.approx(scarce.reached, rel=1e-6)
    values = {r.value for r in mixing.share_report(awkward).filter("dimension = 'lang'").collect()}
    assert None in values and "en" in values
    assert mixing.share_report(no_documents).isEmpty()


def test_topics_by_terms(spark):
    topics = {"sport": ["match", "Goal keeper", "goal"], "trade": ["MARKET", "a.b"], "none": []}
    texts = {
        "The goal keeper won the match": "sport", "market Market goal": "trade", "goal market": "sport", "goals amarket": "other",
        "a.b": "trade", "axb": "other", "": "other", None: "other", "\u00e9goal": "other", "(goal)": "sport",
    }
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    named = frame.select("text", mixing.topic_by_terms(F.col("text"), topics, F.lit("other")).alias("topic"))
    assert {r.text: r.topic for r in named.collect()} == texts
    rows = [(i, "goal " * 5 if i % 4 else "market " * 5, "a", "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    even = mixing.Targets(shares={"topic": {"sport": 0.5, "trade": 0.5}}, keep=0.4)
    kept = mixing.mix(docs, even, topic=mixing.topic_by_terms(F.col("c1"), topics)).filter("selected")
    shares = {r.topic: r["count"] for r in kept.groupBy("topic").count().collect()}
    assert shares["sport"] / sum(shares.values()) == pytest.approx(0.5, abs=0.06)
