"""Language-model scoring: counts and base scores exact, probabilities that add up, held-out gain."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from mailgauge.llm import bilinear
from mailgauge.llm.queries import QUERIES


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [bilinear.END]


def check(rows, docs, learned):
    """Counts and base scores against the contract's formula."""
    counts = Counter(t for d in docs if learned(d.doc_id) for t in tokens(d.text))
    n, types = sum(counts.values()), len(counts)
    expected = []
    for d in docs:
        own = tokens(d.text)
        base = sum(math.log10((counts[t] + 1) / (n + types + 1)) for t in own)
        expected.append((d.doc_id, len(own), sum(counts[t] > 0 for t in own), n, base))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=order)
    for a, b in zip(found, sorted(expected, key=order), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = QUERIES["op4_lm_scoring"](spark, sf_dir).collect()
    check(rows, docs, learned)
    assert all(r.held_out == (not learned(r.doc_id)) for r in rows)


def test_held_out_gain(spark):
    rows = QUERIES["op4_lm_scoring"](spark, "/root/testdata/sf0.1").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.98
    assert np.mean([r.score > r.base_score for r in held]) > 0.9


def test_files_and_partitions_do_not_matter(spark, tmp_path):
    """One partition and 256 give the same model, and one that has learned."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scores = []
    for parts in (1, 256):
        docs.repartition(parts).write.parquet(f"{tmp_path}/{parts}")
        rows = bilinear.score_texts(spark.read.parquet(f"{tmp_path}/{parts}")).collect()
        scores.append({r.doc_id: r.score for r in rows})
        gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
        assert gain > 0.1
    for doc_id, score in scores[0].items():
        assert scores[1][doc_id] == pytest.approx(score, rel=1e-3, abs=1e-3)


def test_shards_hold_every_token_once(spark, sf_dir):
    """Texts longer than a stretch too; turns grow with the number of shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    docs = docs.unionAll(spark.createDataFrame([("a b c " * 30_000,)], "text string"))
    lexicon = bilinear.build_lexicon(bilinear.count_words(docs), 100)
    shards, turns = bilinear.training_shards(docs, lexicon, "text", 10_000, 8_192)
    rows = shards.collect()
    _, *whole = bilinear.sequences(docs.toArrow().column("text").combine_chunks(), lexicon)[:4]
    found = np.concatenate([bilinear._read_stream(bytes(r.stream)) for r in rows], axis=1)
    order = lambda triples: sorted(zip(*(x.tolist() for x in triples)))
    assert order(found) == order(whole)
    n = len({r.shard for r in rows} - {-1})
    assert {r.turn for r in rows} - {-1} == set(range(turns)) and turns == math.ceil(math.sqrt(n))


def test_few_frequent_words_give_the_same(spark, sf_dir, monkeypatch):
    """The join of rare words gives what the broadcast table gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = {r.doc_id: r for r in bilinear.score_texts(docs).collect()}
    build = bilinear.build_lexicon
    monkeypatch.setattr(bilinear, "build_lexicon", lambda counts: build(counts, 1024, 1100))
    for r in bilinear.score_texts(docs).collect():
        assert (r.n_tokens, r.n_known) == (whole[r.doc_id].n_tokens, whole[r.doc_id].n_known)
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score)


def test_probabilities_add_up(spark, sf_dir):
    """After any two words the vocabulary and the rest have probability 1, and so has what is within the rest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = bilinear.count_words(docs)
    lexicon = bilinear.build_lexicon(counts, 200)
    model = bilinear.train_bilinear(docs, lexicon)
    near, far, normaliser = model.tables()
    logs = near[:, None, :] + far[None, :, :] - normaliser[:, :, None]
    assert np.exp(logs.astype(np.float64)).sum(axis=2) == pytest.approx(1, abs=1e-4)
    known = set(lexicon.words.to_pylist()[: lexicon.size])
    rest = [r.n for r in counts.collect() if r.word not in known]
    assert sum(n + 1 for n in rest) + 1 == lexicon.rest


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    shares = np.full(6, 1 / 6)
    model = bilinear.BilinearModel(shares, dimension=3)
    w, b, e = rng.integers(0, 6, 40), rng.integers(0, 7, 40), rng.integers(0, 7, 40)

    def loss(flat, drawn, learner):
        probe = bilinear.BilinearModel(shares, dimension=3)
        probe.set_flat(flat)
        p = probe.context[b] @ probe.place[0] + probe.context[e] @ probe.place[1]
        own = (p * probe.target[w]).sum(axis=1) + probe.bias[w] - learner.log_noise[w]
        other = p @ probe.target[drawn].T + probe.bias[drawn] - learner.log_noise[drawn]
        return -np.log1p(np.exp(-own)).sum() - np.log1p(np.exp(other)).sum()

    learner = bilinear.NoiseContrast(model, shares, noise=8, seed=3)
    drawn = np.searchsorted(learner.cumulative, np.random.default_rng(3).random(8), side="right")
    before = model.flat()
    learner.step(w, b, e)
    moved = model.flat() - before
    for at in rng.integers(0, len(before), 60):
        up, down = before.copy(), before.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        slope = (loss(up, drawn, learner) - loss(down, drawn, learner)) / 2e-2
        if abs(slope) > 0.05:
            assert np.sign(slope) == np.sign(moved[at])


def test_sequences():
    lexicon = bilinear.Lexicon(pa.array(["", "b", "a"]), np.array([2, 5, 3]), 10, 3, 3)
    row, token, before, earlier, *_ = bilinear.sequences(pa.array(["A  b x", None, "b"]), lexicon)
    assert row.tolist() == [0, 0, 0, 0, 1, 2, 2]
    assert token.tolist() == [2, 1, 3, 0, 0, 1, 0]
    assert before.tolist() == [4, 2, 1, 3, 4, 4, 1]
    assert earlier.tolist() == [4, 4, 2, 1, 4, 4, 4]


def test_awkward_rows(awkward, no_documents):
    rows = bilinear.score_texts(awkward).collect()
    check(rows, awkward.collect(), lambda i: True)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    nothing = bilinear.score_texts(awkward, awkward.doc_id < 0).collect()
    assert {(r.base_score, r.n_known) for r in nothing} == {(0, 0)}
    assert all(r.score == pytest.approx(0, abs=1e-6 * r.n_tokens) for r in nothing)
    assert bilinear.score_texts(no_documents).count() == 0


def test_scores_against_a_plain_loop(spark, sf_dir):
    """The score of a text, token by token, from the model's parameters and the counts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionAll(spark.createDataFrame([(-1, "never seen wörds and the x"), (-2, None)], docs.schema)).cache()
    taught = docs.filter("doc_id >= 0")
    counts = bilinear.count_words(taught)
    lexicon = bilinear.build_lexicon(counts, 50, 200, 16)
    model = bilinear.train_bilinear(taught, lexicon)
    scored = bilinear.score_known(docs, lexicon, model).collect()

    seen = {r.word: r.n for r in counts.collect()}
    vocabulary = {w: i for i, w in enumerate(lexicon.words.to_pylist()[: lexicon.size])}
    group = lambda w: zlib.crc32(w.encode()[-3:]) % 16
    outside = [w for w in seen if w not in vocabulary]
    totals = [1 + sum(seen[w] + 1 for w in outside if group(w) == g) for g in range(16)]
    symbol = lambda w: vocabulary[w] if w in vocabulary else lexicon.size + group(w)
    first, second = (p.astype(float) for p in model.place)

    def log_probability(text):
        before = earlier = lexicon.symbols
        total = 0.0
        for word in tokens(text):
            own = model.target @ (model.context[before] @ first + model.context[earlier] @ second) + model.bias
            total += own[symbol(word)] - math.log(sum(math.exp(x) for x in own))
            if word not in vocabulary:
                total += math.log((seen.get(word, 0) + 1) / totals[group(word)])
            before, earlier = symbol(word), before
        return total / math.log(10)

    for r, text in zip(scored, [d.text for d in docs.collect()]):
        rare = sum(x["n"] * math.log10(seen.get(x["word"], 0) + 1) for x in r.rare)
        assert r.score_part + rare == pytest.approx(log_probability(text), rel=1e-4)


def test_classes_cover_all_words(spark):
    words = ["a", "ab", "abc", "xabc", "größe", "é", "\U0001f600x", "running", "jumping"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    column = [r.c for r in frame.select(bilinear.class_column(frame.word, 97).alias("c")).collect()]
    assert column == bilinear.classes_of(pa.array(words), 97).tolist()
    assert column[2] == column[3] and column[-1] == column[-2]


def test_copies_are_dealt_over_shards(spark):
    """Half of all tokens are copies of one row; no shard has many more of them than another."""
    docs = spark.range(4000).selectExpr("if(id % 2 = 0, 'the same few words', concat('w', id, ' other v', id, ' end')) AS text")
    lexicon = bilinear.build_lexicon(bilinear.count_words(docs))
    shards, _ = bilinear.training_shards(docs.repartition(3), lexicon, "text", 1 << 11, 1 << 10)
    sizes = [len(r.stream) for r in shards.filter("shard >= 0").collect()]
    assert len(sizes) >= 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
