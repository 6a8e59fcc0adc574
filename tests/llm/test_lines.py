"""Line dedup against a plain model."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from mailgauge.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def model(texts, min_docs, min_chars):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANKS))

    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for ls in split for k in {key(x) for x in ls})
    gone = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for ls in split:
        kept = [x for x in ls if key(x) not in gone]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out)


def check(frame, min_docs, min_chars=1):
    texts = [r.text for r in frame.select("text").collect()]
    rows = lines.drop_common_lines(frame, min_docs=min_docs, min_chars=min_chars).collect()
    assert sorted((r.n_lines, r.n_dropped, r.kept) for r in rows) == model(texts, min_docs, min_chars)


def test_against_the_model(spark):
    texts = [f"Header\n own {i}\n\nÄhnlich \n header\t\r\nfooter é {i % 3}\n" for i in range(12)]
    texts += ["HEADER", "header\nheader", None, "", "\n\n", "x", "İ\nÄHNLICH", "\x0bheader\x0c"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for least in (2, 4, 10, 14, 99):
        check(frame, least)
    check(frame, 2, min_chars=7)


def test_awkward_rows(awkward, no_documents):
    check(awkward, 2)
    check(awkward, 1)
    digest = lines.line_dedup_digest(awkward).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_lines, r.n_dropped, r.kept_sha256) for r in digest if r.doc_id in (2, 3)} == {(1, 0, empty)}
    assert lines.line_dedup_digest(no_documents).count() == 0


def test_a_long_text_of_common_lines(spark):
    text = "\n".join(f"line {i}" for i in range(20_000))
    frame = spark.createDataFrame([(1, text), (2, text), (3, "line 5\nother")], "doc_id long, text string")
    rows = {r.c0: r for r in lines.drop_common_lines(frame, min_docs=2).collect()}
    assert (rows[1].n_dropped, rows[1].kept) == (20_000, "") and rows[3].kept == "other"


def test_the_second_hash_does_not_follow_from_the_first(spark):
    """xxhash64 of several columns goes on from the hash of those before: such a pair would be worth one hash."""
    frame = spark.createDataFrame([("one line",)], "text string").select(lines.line_hashes(F.col("text"))[0].alias("h"))
    row = frame.select("h.h1", "h.h2", F.xxhash64("h.h1").alias("a")).head()
    after = spark.createDataFrame([("one line",)], "t string").select(F.xxhash64("t", F.lit(1)).alias("x")).head().x
    assert row.h2 not in (after, row.a) and row.h1 != row.h2
