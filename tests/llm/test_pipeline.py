"""The pipeline's rows against each stage done plainly, one after the other, over the whole smallest table."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from mailgauge.llm import language, mixing
from tests.llm.test_mixing import fitted, flattened
from tests.llm.test_sharding import check, described
from tests.llm.test_simhash import components, fingerprint


def in_a_language(docs):
    """Naive Bayes from the documents themselves; those with a letter whose likeliest language has half or more."""
    grams = {d.doc_id: Counter(np.concatenate([b for _, b in language.hashed_grams([d.text])]).tolist()) for d in docs}
    totals, number = defaultdict(Counter), Counter()
    for d in docs:
        totals[d.lang].update(grams[d.doc_id])
        number[d.lang] += 1
    size = {lang: sum(c.values()) + 0.5 * language.BUCKETS for lang, c in totals.items()}
    kept = []
    for d in docs:
        logs = [
            math.log(number[lang] / len(docs))
            + sum(n * math.log((c[b] + 0.5) / size[lang]) for b, n in grams[d.doc_id].items())
            for lang, c in totals.items()
        ]
        best = 1 / sum(math.exp(x - max(logs)) for x in logs)
        if best >= 0.5 and any(map(str.isalpha, d.text)):
            kept.append(d)
    return kept


def one_of_each_group(docs):
    docs = sorted(docs, key=lambda d: d.doc_id)
    roots = components([fingerprint(d.text) for d in docs])
    return [d for i, d in enumerate(docs) if roots[i] == i]


def without_items(docs, items):
    def words(text):
        return f" {' '.join(''.join(c.lower() if c.isalnum() else ' ' for c in text).split())} "

    return [d for d in docs if not any(words(item) in words(d.text) for item in items)]


def topic(text, words):
    if not regex.search(r"[\p{L}\p{N}]", text):
        return "empty"
    if text.count("|") * 8 >= words:
        return "table"
    if len(regex.findall("[0-9]", text)) >= words:
        return "numeric"
    return "brief" if words < 100 else "prose"


def kept_probabilities(docs):
    """doc_id to the probability that the mix keeps it."""
    size = {d.doc_id: len(regex.findall(r"[^\x20\x09-\x0D]+", d.text)) for d in docs}
    cell = {d.doc_id: (d.source, d.lang, topic(d.text, size[d.doc_id])) for d in docs}
    cells = Counter()
    for i, n in size.items():
        cells[cell[i]] += n
    cells = Counter({c: n for c, n in cells.items() if n})
    options = mixing.Targets()
    weight = fitted(cells, flattened(cells, options.flatten), options.keep, options.rounds)
    return {i: weight[cell[i]] * sum(cells.values()) * options.keep / cells[cell[i]] for i in size if size[i]}


def test_rows_are_those_of_the_stages_done_plainly(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = table.collect()
    assert all(d.text is not None and d.lang is not None for d in docs)
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = corpus_pipeline.run(spark, sf_dir).collect()

    left = without_items(one_of_each_group(in_a_language(docs)), items)
    draws = table.select("doc_id", F.expr("shiftrightunsigned(xxhash64(doc_id, 'mix'), 11) / 9007199254740992D").alias("u"))
    draw = {r.doc_id: r.u for r in draws.collect()}
    probability = kept_probabilities(left)
    # Raking ends within a tolerance, so a draw that close to its probability may go either way.
    sure = {i for i, p in probability.items() if draw[i] < p - 2e-3}
    maybe = {i for i, p in probability.items() if draw[i] < p + 2e-3}
    found = {r.doc_id for r in rows}
    assert sure <= found <= maybe and len(maybe - sure) <= 2 and 0 < len(found) < len(left) < len(docs)

    kept = table.filter(F.col("doc_id").isin(sorted(found)))
    check(rows, described(kept), corpus_pipeline.SHARDS, 0.1)
