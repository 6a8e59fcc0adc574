"""Queries against their SQL, and the pipeline."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from mailgauge.llm.oracles import ORACLES
from mailgauge.llm.queries import QUERIES
from tests.check_oracles import compare, connect


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_stages_keep_the_columns_and_drop_what_they_must(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        rows = after.count()
        assert 0 < rows <= before, name
        if name != "sharding":
            assert after.columns == docs.columns
            ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
            assert not Counter(r.doc_id for r in after.select("doc_id").collect()) - ids
            docs, before = spark.createDataFrame(after.collect(), docs.schema), rows
        else:
            assert rows == before


def test_stages_on_awkward_rows(spark, awkward, no_documents, sf_dir):
    for docs in (awkward, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, sf_dir)
            assert after.count() <= docs.count(), name
            assert name == "sharding" or after.columns == docs.columns
