"""Quality classifier: held-out accuracy, statistics against brute force, defined edge cases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from mailgauge.llm import quality
from mailgauge.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op2_quality_classifier"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in label]
    hits = [r.predicted == label[r.doc_id] for r in held]
    assert len(held) > 50 and np.mean(hits) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


@pytest.mark.parametrize("run", [1, 7, 1 << 20])
def test_statistics_do_not_depend_on_runs(monkeypatch, run):
    monkeypatch.setattr(quality, "RUN_BYTES", run)
    texts = ["The Cat  sat", "", None, "x", " lead", "A B\nC|d!", "é" * 9, "end "]
    rows = quality.document_statistics(pa.array(texts))
    place = {name: i for i, name in enumerate(quality.STATISTICS)}
    for text, row in zip(texts, rows):
        data = (text or "").encode()
        words = (text or "").split()
        expected = {
            "length": np.log1p(len(data)),
            "words": np.log((len(words) + 0.5) / (len(data) + 1)),
            "capital_words": np.log((sum("A" <= w[0] <= "Z" for w in words) + 0.5) / (len(data) + 1)),
            "high": np.log((sum(b > 127 for b in data) + 0.5) / (len(data) + 1)),
            "commonest": max((data.count(b) for b in set(data)), default=0) / max(len(data), 1),
        }
        for name, value in expected.items():
            assert row[place[name]] == pytest.approx(value), (text, name)


def test_scores_are_density_ratios(spark):
    """Against the densities written out, with the covariance inverted."""
    rng = np.random.default_rng(0)
    width = len(quality.STATISTICS)
    x = rng.normal(size=(300, width)) * rng.uniform(0.5, 2, width)
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(int)
    rows = [(int(c), [float(v) for v in r]) for c, r in zip(y, x)]
    model = quality.train_quality_model(spark.createDataFrame(rows, "label int, statistics array<double>"))
    logs = []
    for c in (0, 1):
        covariance = np.linalg.inv(model.whitener[c].T @ model.whitener[c])
        d = x - x[y == c].mean(axis=0)
        quadratic = np.einsum("ij,jk,ik->i", d, np.linalg.inv(covariance), d)
        logs.append(np.log(np.mean(y == c)) - 0.5 * (quadratic + np.linalg.slogdet(covariance)[1]))
    assert quality.quality_scores(model, x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])), abs=1e-9)


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (6, 0), (6, 1), (None, 1), (7, None), (8, 5), (99, 1)], "doc_id long, quality int"
    )
    rows = quality.classify_quality(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3)}
    assert len(empty) == 1
    assert {r.score for r in quality.classify_quality(awkward, labels.filter("false")).collect()} == {0.5}
    one = quality.classify_quality(awkward, labels.filter("quality = 0")).collect()
    assert {r.predicted for r in one} == {0}
    assert quality.classify_quality(no_documents, labels).count() == 0


def test_a_score_does_not_depend_on_the_rows_beside_it():
    random = np.random.default_rng(3)
    width = len(quality.STATISTICS)
    model = quality.QualityModel(
        np.array([0.4, 0.6]), random.normal(size=(2, width)), random.normal(size=(2, width, width)) / 9, np.array([1.0, 2.0])
    )
    x = random.normal(size=(57, width))
    together = quality.quality_scores(model, x)
    assert together.tolist() == [quality.quality_scores(model, row[None])[0] for row in x]
    assert together[5:26].tolist() == quality.quality_scores(model, x[5:26]).tolist()
