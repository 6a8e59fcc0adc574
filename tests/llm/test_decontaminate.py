"""Benchmark decontamination by templates."""

from __future__ import annotations

import pytest

from mailgauge.llm import decontaminate
from mailgauge.llm.queries import QUERIES

ITEM = "A farmer has 12 sheep and sells 5 of them to Maria for 30 dollars each. After the sale 12 lambs are born to Maria."


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, ITEM), (3, "too short"), (4, None), (None, "an item without any id stands here for nothing")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, benchmark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(docs, benchmark).collect()}


def test_copies_and_new_parameters(spark, benchmark):
    other = ITEM.replace("12", "40").replace("30", "7.5").replace("Maria", "Tomas")
    long = "some words go before it all. " * 2000 + ITEM + " and some follow after that."
    texts = (ITEM, ITEM.lower(), ITEM.upper(), other, long, ITEM.replace(" ", "  \n"), f"Yes, {ITEM}")
    # Items 1 and 2 have one text; both are reported.
    assert found(spark, benchmark, *texts) == {(i, item) for i in range(len(texts)) for item in (1, 2)}


def test_names_that_begin_sentences(spark):
    """The subject of every sentence renamed: half of the windows and more still match, in one reading."""
    text = "Anna has 12 apples. Anna buys 5 more. Anna eats 3. How many apples are left?"
    item = spark.createDataFrame([(1, text)], "item_id long, text string")
    renamed = text.replace("Anna", "Bert").replace("12", "31")
    assert {(0, 1), (1, 1), (2, 1)} == found(spark, item, text, renamed, f"He said: {renamed} And so on.")
    docs = spark.createDataFrame([(0, renamed)], "doc_id long, text string")
    row = decontaminate.find_contamination(docs, item).head()
    assert row.coverage == 1 and row.n_windows == row.item_windows
    assert found(spark, item, "Bert likes pears. Carl sells 5 cars. How many people are here?") == set()


def test_items_with_few_windows_are_found_word_for_word(spark):
    texts = ["Compute 12 + 15 * 3 - 4 / 2 and 7 * 9.", "Which River Flows Through The City Of Paris And Into The North Sea?", "two tokens"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [f"Words before. {t} Words after." for t in texts] + ["Compute 12 + 15 * 3 - 4 / 2 and 8 * 9.", "two other tokens"]
    assert found(spark, items, *docs) == {(0, 0), (1, 1), (2, 2)}


def test_readings_count_their_own_windows(spark):
    """A title-cased item is not held by a text that shares one window of its reading without names."""
    title = "Which River Flows Through The City Of Paris And Into The North Sea?"
    items = spark.createDataFrame([(1, title)], "item_id long, text string")
    assert found(spark, items, "we walk through the city of paris every day", title.lower()) == {(1, 1)}


def test_windows_whose_slots_conflict_are_left_out(spark, benchmark):
    """12 stands twice in the item: with two values in the document the windows of one of them do not count."""
    broken = ITEM.replace("12 sheep", "40 sheep")
    docs = spark.createDataFrame([(0, broken), (1, ITEM)], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert set(rows) == {(0, 1), (0, 2), (1, 1), (1, 2)}
    row, whole = rows[0, 1], rows[1, 1]
    assert (whole.n_conflicts, whole.coverage) == (0, 1)
    assert row.n_conflicts > 0 and row.n_windows + row.n_conflicts == row.item_windows


def test_texts_whose_slots_all_conflict(spark):
    """One number stands six times in the item, and for six others in the text: no window agrees with many others."""
    item = " ".join(f"{a} 7 {a}er {a}ing" for a in ("old", "red", "big", "new", "wet", "hot"))
    other = item
    for k in range(6):
        other = other.replace(" 7 ", f" {20 + k} ", 1)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert found(spark, items, other, item.replace("7", "8")) == {(1, 1)}


def test_a_phrase_that_all_items_and_documents_share_brings_few_pairs(spark, monkeypatch):
    """Rarest windows only: the joined rows do not grow with the product of items and documents."""
    opening = "please read the following short story and answer the question below it"
    letters = lambda n: "".join("abcdefghij"[int(c)] for c in f"{n:05d}")
    rare = lambda kind, i: " ".join(f"{kind}{letters(20 * i + k)}" for k in range(20))
    items = spark.createDataFrame([(i, f"{opening} {rare('item', i)}") for i in range(150)], "item_id long, text string")
    texts = [f"{opening} {rare('text', i)}" for i in range(400)] + [f"{opening} {rare('item', i)}" for i in range(5)]
    stored = []
    real = decontaminate.land

    def counted(df, *args):
        stored.append(real(df, *args))
        return stored[-1]

    monkeypatch.setattr(decontaminate, "land", counted)
    assert found(spark, items, *texts) == {(400 + i, i) for i in range(5)}
    assert max(t.count() for t in stored) < 10_000


def test_letters_of_all_planes_and_scripts_without_blanks(spark):
    adlam = " ".join("".join(chr(0x1E900 + (i * 5 + k) % 34) for k in range(3)) for i in range(6))
    chinese = "小明有十二个苹果他把五个苹果送给了他的姐姐请问他现在还剩下几个苹果"
    items = spark.createDataFrame([(1, adlam), (2, chinese)], "item_id long, text string")
    texts = [adlam, f"before {adlam} after", f"题目如下{chinese}谢谢大家", chinese[:8] + "完全不同的一句话没有任何相同之处", "".join(reversed(chinese))]
    assert found(spark, items, *texts) == {(0, 1), (1, 1), (2, 2)}


def test_clean_texts_and_little_overlap(spark, benchmark):
    part = "A farmer has 12 sheep and sells a car. Nothing else is alike in this text, which goes on for long."
    numbers = "1 2 3 4 5 6 7 8 9 10 " * 50
    assert found(spark, benchmark, part, numbers, "", None, "12") == set()


def test_tokens_do_not_depend_on_runs(monkeypatch):
    texts = ["Anna has 1,000.5 kg of 12 apples. Then Bob left 5% there", "", "élan Élan x", "a" * 30]

    def read():
        row, slot, value, kind = decontaminate.templates(texts)
        return list(zip(row.tolist(), slot.tolist(), value.tolist(), kind.tolist()))

    whole = read()
    kinds = [k for r, _, _, k in whole if r == 0]
    plain, number, unit, name = decontaminate.PLAIN, decontaminate.NUMBER, decontaminate.UNIT, decontaminate.NAME
    assert kinds == [plain, plain, number, unit, plain, number, plain, plain, name, plain, number, unit, plain]
    assert whole[-4][2] == whole[-3][2] and [r for r, *_ in whole[-4:]] == [2, 2, 2, 3]
    monkeypatch.setattr(decontaminate, "RUN_CHARS", 31)
    assert read() == whole


def test_query_against_brute_force(spark, sf_dir):
    """The tables hold passages word for word, in other cases or between other words."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    def words(text):
        kept = "".join(c.lower() if c.isalnum() else " " for c in text or "")
        return " ".join(kept.split())

    held = {(d, i) for d, t in docs.items() for i, item in items.items() if f" {words(item)} " in f" {words(t)} "}
    rows = QUERIES["op1_benchmark_decontamination"](spark, sf_dir).collect()
    assert held and {(r.doc_id, r.item_id) for r in rows} == held
    assert all(0.5 <= r.coverage <= 1 for r in rows)


def test_awkward_rows(spark, awkward, no_documents, benchmark):
    sat = spark.createDataFrame([(7, awkward.head().text)], "item_id long, text string")
    rows = decontaminate.find_contamination(awkward, sat).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 7), (9, 7)}
    kept = decontaminate.drop_contaminated(awkward, sat)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3
    assert decontaminate.drop_contaminated(awkward, benchmark.filter("false")).count() == awkward.count()
    assert decontaminate.find_contamination(no_documents, benchmark).count() == 0
