"""Language identification: held-out accuracy, n-grams against brute force, defined edge cases."""

from __future__ import annotations

from collections import Counter

import numpy as np

from mailgauge.llm import language
from mailgauge.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_language_id"](spark, sf_dir).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_grams_do_not_depend_on_runs(monkeypatch):
    texts = ["Abc def", "", "ÄÖ\U0001f600x", "a" * 50, "\ud800 y"]

    def counted():
        return Counter((int(r), int(b)) for rows, buckets in language.hashed_grams(texts) for r, b in zip(rows, buckets))

    whole = counted()
    for t, text in enumerate(texts):
        n = len(f" {text.lower()} ")
        assert sum(v for (row, _), v in whole.items() if row == t) == n + max(0, n - 1) + max(0, n - 2)
    monkeypatch.setattr(language, "RUN_CHARS", 7)
    assert counted() == whole


def test_awkward_rows(awkward, no_documents):
    model = language.train_language_model(awkward)
    assert model.languages == ["de", "en", "fr"]
    rows = language.detect_language(awkward, model)
    assert [c for c in rows.columns if c == "score"] == ["score"] and rows.count() == awkward.count()
    by_id = {r.doc_id: r for r in rows.filter("doc_id IS NOT NULL").collect()}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (2, 3, 4, 5))
    assert by_id[1].lang_pred == by_id[9].lang_pred in model.languages
    nothing = language.train_language_model(no_documents)
    assert nothing.languages == []
    assert {r.lang_pred for r in language.detect_language(awkward, nothing).collect()} == {"und"}
    assert language.detect_language(no_documents, model).count() == 0


def test_numerals_are_no_letters(spark):
    model = language.train_language_model(spark.createDataFrame([("ein Wort", "de"), ("a word", "en")], "text string, lang string"))
    texts = ["½ ² ①", "Ⅷ", "٣ 12 _", "½ a", "ª", "漢", "𞤀"]
    rows = language.detect_language(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    found = {r.text: r.lang_pred == language.UNDETERMINED for r in rows}
    assert [found[t] for t in texts] == [True, True, True, False, False, False, False]
