"""URL filter: vocabulary and rules."""

from __future__ import annotations

import re

from mailgauge.llm import urls
from mailgauge.llm.urls import STRICT_TERMS, Vocabulary, judge_urls


def judged(spark, *addresses):
    pages = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    return {r.page_id: r for r in urls.url_verdicts(pages).collect()}


def test_parts_of_an_address(spark):
    cases = {
        "HTTP://WWW.Example.COM/Fr/A?x=1#y": ("www.example.com", "/Fr/A"),
        "http://a.org": ("a.org", ""),
        "http://a.org?x=/b": ("a.org", ""),
        "a://b://c/d": ("b:", "//c/d"),
        "no address": ("", ""),
        "://": ("", ""),
        "http://ÄB.org/ÄB#": ("Äb.org", "/ÄB"),
        "http://a.org/x\ny?z": ("a.org", "/x\ny"),
        "": ("", ""),
        None: ("", ""),
    }
    found = judged(spark, *cases)
    assert [(found[i].host, found[i].path) for i in range(len(cases))] == list(cases.values())


def test_rules(spark):
    cases = {
        "http://any.org/x": ("org/", "allow"),
        "http://any.org": (None, "allow"),
        "http://org/": ("org/", "allow"),
        "http://a.example.org/es/1": ("example.org/es/", "block"),
        "http://example.org/en/12": ("example.org/en/1", "block"),
        "http://example.org/en/2": ("org/", "allow"),
        "http://notexample.org/es/": ("org/", "allow"),
        "http://x.com/fr/porn": ("com/fr/", "allow"),
        "http://x.com/de/fine": ("com/de/", "block"),
        "http://xcom/de/": (None, "allow"),
    }
    found = judged(spark, *cases)
    assert [(found[i].rule, found[i].verdict) for i in range(len(cases))] == list(cases.values())


def test_vocabulary_against_brute_force():
    vocabulary = Vocabulary()
    automaton = vocabulary.automaton()
    for url in (
        "http://a.net/porn",
        "http://pornography.net/",
        "http://a.net/free-sex_bonus?win",
        "http://freefree.net/free/free",
        "http://XXX.net",
        "poker.promo.bet",
        "porno porn",
        "",
        "é-free-é",
    ):
        lowered = "".join(c.lower() if c.isascii() else c for c in url)
        hits = [t for t in vocabulary.terms if re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", lowered)]
        expected = (sum(t in STRICT_TERMS for t in hits), sum(t not in STRICT_TERMS for t in hits))
        assert vocabulary.count(url, automaton) == expected, url


def test_verdicts_by_terms(spark):
    found = judged(spark, "http://a.net/casino", "http://a.net/free/sex", "http://a.net/free/sex/poker", "http://a.net/free/free/free")
    assert [found[i].verdict for i in range(4)] == ["block", "allow", "block", "allow"]


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (None, "http://a.net/xxx", None), (1, None, "x")], "page_id long, url string, host string")
    rows = judge_urls(pages)
    assert rows.columns[:3] == ["c0", "c1", "c2"] and rows.count() == 3
    assert urls.drop_blocked(pages).count() == 2 and urls.drop_blocked(pages).columns == pages.columns
    assert urls.url_verdicts(pages.filter("false")).count() == 0
    nothing = judge_urls(pages, vocabulary=Vocabulary((), ()))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_terms_in_any_case_and_from_a_table(spark):
    vocabulary = urls.Vocabulary(strict=["XXX"], soft=["Bet", "WIN", "", "xxx"])
    assert vocabulary.count("http://a/xxx/BET?win", vocabulary.automaton()) == (1, 2)
    table = spark.createDataFrame(
        [("Foo", True), ("foo", False), ("Bar", False), (None, True), ("", True), ("baz", None)], "term string, strict boolean"
    )
    read = urls.Vocabulary.from_table(table, soft_hits=2)
    assert read.terms == {"foo": True, "bar": False, "baz": False} and read.soft_hits == 2
    pages = spark.createDataFrame([(1, "http://a.de/x-FOO"), (2, "http://a.de/bar"), (3, "http://a.de/bar,BAZ")], "page_id long, url string")
    verdicts = {r.c0: r.verdict for r in urls.judge_urls(pages, vocabulary=read).collect()}
    assert verdicts == {1: "block", 2: "allow", 3: "block"}
    assert urls.Vocabulary.from_table(table.filter("false")).terms == {}


def test_a_very_long_url(spark):
    url = "http://a.de/" + "x-" * 500_000 + "casino"
    row = urls.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).head()
    assert row.verdict == "block" and len(row.path) == len(url) - len("http://a.de")
