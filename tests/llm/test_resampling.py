"""Importance resampling against a plain model."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from mailgauge.llm import resampling
from mailgauge.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def model(docs, target, percent=5, min_words=20):
    """(doc_id, n_words, n_features, weight, score, rank) of rows (doc_id, text)."""
    found = [(i, *features(text)) for i, text in docs]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    rows = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        weight = sum(map(gain, f))
        rows.append([i, n, len(f), weight, weight + noise, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return Counter(map(tuple, rows))


def check(spark, docs, target, percent=5):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.resample(docs, goal, percent=percent)
    assert Counter(map(tuple, out.collect())) == model(rows, target, percent)


def test_awkward_rows(spark, awkward, no_documents):
    target = ["The cat sat on the mat", None, "", "Élan naïve word word"]
    for percent in (0, 5, 50, 100):
        check(spark, awkward, target, percent)
    check(spark, awkward, [])
    check(spark, no_documents, target)


def test_separators_and_letters_beyond_ascii(spark):
    texts = ["a\x00b\x7fC  ÀÉ_x-y'z 1,5 \U0001f600 İI", "漢字 かな。" * 30, "ß" * 3, "\n\t" * 50]
    check(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ["a b c àé"], 50)


def test_ties_go_to_the_smaller_id(spark):
    text = " ".join(f"w{i}" for i in range(25))
    frame = spark.createDataFrame([(7, text)] * 3 + [(None, text)] * 2 + [(8, text), (9, "few words")], "doc_id long, text string")
    check(spark, frame, [text], 50)


def test_the_query_on_whole_tables(spark, sf_dir):
    def texts(name):
        return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(
            "doc_id" if name == "documents" else "item_id", "text").collect()]

    out = QUERIES["op11_importance_resampling"](spark, sf_dir)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = model(texts("documents"), [t for _, t in texts("benchmark")])
    assert Counter(map(tuple, out.collect())) == Counter((r[0], *r[2:]) for r in expected.elements())


@pytest.mark.parametrize("at_a_time", [1, 2, 5, 1000])
def test_runs_across_the_words_taken_at_a_time(monkeypatch, at_a_time):
    monkeypatch.setattr(resampling, "WORDS_AT_A_TIME", at_a_time)
    texts = ["one two three four five", None, "six", "", "seven eight", "x" * 300 + " y " + "z" * 70_000]
    maker = resampling._Features(10_000, 3)
    words, first = maker.words(pa.array(texts))
    rows = np.searchsorted(first, np.arange(len(words)), side="right") - 1
    found = [Counter() for _ in texts]
    for buckets, begins in maker.buckets(words, first):
        for b, row in zip(buckets.tolist(), rows[begins].tolist()):
            found[row][b] += 1
    assert found == [Counter(features(t)[1]) for t in texts]
