"""URL filter: host rules, then a weighted vocabulary searched by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import add_columns, lower_ascii, numbered, position, strings

ALLOW, BLOCK = "allow", "block"

# Terms that reject a URL on their own, and terms that do so together.
STRICT_TERMS = "casino escort hentai jackpot porn porno sexcam viagra warez xxx".split()
SOFT_TERMS = """
    adult bet betting bonus cheap coupon crack dating deal download free keygen loan lottery nude payday
    pills poker promo replica sex slots spam torrent win
""".split()
SOFT_HITS = 3
# Terms that a vocabulary read from a table may have.
MAX_TERMS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and a beginning of the path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The production rules.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lowered; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, both null if none does; of equal lengths the first given."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


class Vocabulary:
    """Strict and soft terms, A-Z lowered as URLs are; a hit must not have a letter or digit on either side."""

    def __init__(self, strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS, soft_hits: int = SOFT_HITS):
        terms = [(t.translate(_LOWER), kind) for kind, given in ((False, soft), (True, strict)) for t in given if t]
        self.terms = dict(terms)  # a term given as both is strict
        self.soft_hits = soft_hits

    @classmethod
    def from_table(
        cls, terms: DataFrame, term: str = "term", strict: str = "strict", soft_hits: int = SOFT_HITS
    ) -> Vocabulary:
        """The terms of a table, those strict for which its boolean column is true; null and empty terms are none.

        A table of more than MAX_TERMS different terms is an error, as every task gets the vocabulary.
        """
        rows = terms.select(
            lower_ascii(F.col(term)).alias("t"), F.coalesce(F.col(strict), F.lit(False)).alias("s")
        ).filter("t <> ''")
        found = rows.groupBy("t").agg(F.max("s").alias("s")).limit(MAX_TERMS + 1).collect()
        if len(found) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms")
        return cls([r.t for r in found if r.s], [r.t for r in found if not r.s], soft_hits)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, strict in self.terms.items():
            found.add_word(term, (term, strict))
        if not self.terms:
            return None
        found.make_automaton()
        return found

    def count(self, url: str, automaton: ahocorasick.Automaton | None) -> tuple[int, int]:
        """(strict, soft): how many distinct terms of each kind are in the URL, A-Z lowered."""
        strict, soft = set(), set()
        lowered = url.translate(_LOWER)
        for last, (term, is_strict) in automaton.iter(lowered) if automaton else ():
            before, after = last - len(term), last + 1
            if before >= 0 and lowered[before] in _INSIDE or after < len(lowered) and lowered[after] in _INSIDE:
                continue
            (strict if is_strict else soft).add(term)
        return len(strict), len(soft)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def count_terms(rows: DataFrame, url: str, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with strict_hits and soft_hits; a null URL has none."""

    def prepare():
        automaton = vocabulary.automaton()

        def compute(column: pa.Array):
            hits = [vocabulary.count(u, automaton) for u in strings(column)]
            return pa.array([h[0] for h in hits], pa.int32()), pa.array([h[1] for h in hits], pa.int32())

        return compute

    return add_columns(rows, url, "strict_hits int, soft_hits int", prepare)


def judge_urls(
    pages: DataFrame, url: str = "url", rules: Sequence[Rule] = RULES, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """``pages`` with columns named by position, and host, path, rule, strict_hits, soft_hits, verdict.

    A fitting rule decides; else a URL with a strict term or with
    ``soft_hits`` distinct soft terms is blocked, and any other allowed.  A
    null or empty URL has empty host and path and is allowed, a very long
    one is searched whole.  Rows are judged one by one: repeated ones get
    equal verdicts, an empty table gives no rows.
    """
    vocabulary = vocabulary or Vocabulary()
    column = position(pages, url)
    counted = count_terms(numbered(pages), column, vocabulary)
    named = counted.withColumns({"host": url_host(F.col(column)), "path": url_path(F.col(column))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rejected = (F.col("strict_hits") > 0) | (F.col("soft_hits") >= vocabulary.soft_hits)
    by_terms = F.when(rejected, BLOCK).otherwise(ALLOW)
    return named.withColumns({"rule": rule, "verdict": F.coalesce(verdict, by_terms)})


def drop_blocked(pages: DataFrame, url: str = "url", **options) -> DataFrame:
    """The rows of ``pages`` that are allowed, all columns as they are."""
    judged = judge_urls(pages, url, **options).filter(F.col("verdict") == ALLOW)
    return judged.select(numbered(pages).columns).toDF(*pages.columns)


def url_verdicts(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits of every page."""
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    judged = judge_urls(base)
    return judged.select(F.col("c0").alias("page_id"), "host", "path", "rule", "verdict", "strict_hits", "soft_hits")
