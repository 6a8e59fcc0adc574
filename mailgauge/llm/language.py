"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import add_columns, map_texts, strings
from mailgauge.sources.scratch import land

UNDETERMINED = "und"
# N-grams of one to so many characters, and the buckets they are hashed to.
LONGEST_GRAM = 3
BUCKETS = 1 << 15
# The model is a matrix of buckets by languages; more languages than this are an error.
MAX_LANGUAGES = 1000
# Characters worked on at a time.
RUN_CHARS = 1 << 19

_GAP = "\0"


@dataclass
class LanguageModel:
    """Languages in name order, their log-priors, and log-probabilities by bucket and language."""

    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray


def hashed_grams(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all n-grams of some texts, in runs.

    Texts are lowered and get a blank at either end.  The character U+0000
    ends an n-gram, between texts as well as within one.
    """
    padded = [f" {text.lower()} " for text in texts]
    lengths = np.fromiter((len(t) + 1 for t in padded), dtype=np.int64, count=len(padded))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    joined = _GAP.join(padded)
    for begin in range(0, len(joined), RUN_CHARS):
        run = joined[begin : begin + RUN_CHARS + LONGEST_GRAM - 1]
        codes = np.frombuffer(run.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        here = min(RUN_CHARS, len(joined) - begin)
        low = np.searchsorted(starts, begin, side="right") - 1
        high = np.searchsorted(starts, begin + here, side="left")
        edges = np.append(np.maximum(starts[low:high], begin), begin + here)
        row = np.repeat(np.arange(low, high), np.diff(edges))
        value = np.zeros(len(codes), dtype=np.uint64)
        whole = np.ones(len(codes), dtype=bool)
        for size in range(1, min(LONGEST_GRAM, len(codes)) + 1):
            last = codes[size - 1 :]
            # Odd multipliers that spread the bits (golden ratio, and a mixing constant).
            value = value[: len(last)] * np.uint64(0x9E3779B97F4A7C15) + last + np.uint64(size)
            whole = whole[: len(last)] & (last != 0)
            kept = whole[:here]
            mixed = value[:here] * np.uint64(0xD6E8FEB86659FD93)
            yield row[: len(kept)][kept], (mixed >> np.uint64(49)).astype(np.int64)[kept] % BUCKETS


class _Counter:
    """Adds up n-grams by language over a task; its rows go out at the end."""

    def __init__(self):
        self.grams: dict[str, np.ndarray] = {}
        self.docs: dict[str, int] = {}

    def __call__(self, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, langs = piece.column(0), piece.column(1)
        for value in langs.unique():
            own = strings(texts.filter(pc.equal(langs, value)))
            counts = self.grams.setdefault(value.as_py(), np.zeros(BUCKETS, dtype=np.int64))
            for _, buckets in hashed_grams(own):
                counts += np.bincount(buckets, minlength=BUCKETS)
            self.docs[value.as_py()] = self.docs.get(value.as_py(), 0) + len(own)
            if len(self.grams) > 64:  # bounds the memory of a task over many languages
                yield from self.finish()

    def finish(self) -> Iterator[pa.RecordBatch]:
        for name, counts in self.grams.items():
            full = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * (len(full) + 1), pa.string()),
                    "bucket": pa.array([-1, *full.tolist()], pa.int32()),
                    "n": pa.array([self.docs[name], *counts[full].tolist()], pa.int64()),
                }
            )
        self.grams, self.docs = {}, {}


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, bucket, n: how often an n-gram of the bucket is in texts of the language.

    Bucket -1 counts the texts.  Rows without text or language do not count.
    Each task sends one row per language and bucket, whatever it has read.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    parts = map_texts(rows, "lang string, bucket int, n long", _Counter, "text")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train_language_model(
    docs: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5
) -> LanguageModel:
    """Naive Bayes from all rows of ``docs`` that have a text and a language.

    An empty table gives a model of no language.  At most BUCKETS + 1 numbers
    a language reach the driver.
    """
    counts = land(count_grams(docs, text, lang))
    languages = [r.lang for r in counts.filter("bucket = -1").select("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in column {lang}")
    languages.sort()
    place = {name: i for i, name in enumerate(languages)}
    matrix = np.full((BUCKETS, len(languages)), smoothing)
    prior = np.zeros(len(languages))
    # As arrays: rows as Python objects take many times the memory.
    for batch in counts.toArrow().to_batches():
        names = batch.column("lang").dictionary_encode()
        own = np.array([place[name] for name in names.dictionary.to_pylist()], dtype=np.int64)
        column = own[names.indices.to_numpy()]
        bucket, n = batch.column("bucket").to_numpy(), batch.column("n").to_numpy()
        prior[column[bucket < 0]] = n[bucket < 0]
        matrix[bucket[bucket >= 0], column[bucket >= 0]] += n[bucket >= 0]
    with np.errstate(divide="ignore"):
        log_prior = np.log(prior / prior.sum()) if languages else prior
    return LanguageModel(languages, log_prior, np.log(matrix / matrix.sum(axis=0)))


def score_texts(model: LanguageModel, texts: Sequence[str]) -> np.ndarray:
    """Log of prior times likelihood, by text and language."""
    total = np.tile(model.log_prior, (len(texts), 1))
    for row, buckets in hashed_grams(texts):
        for j in range(len(model.languages)):
            total[:, j] += np.bincount(row, weights=model.log_probability[buckets, j], minlength=len(texts))
    return total


def detect_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of that language (0 to 1).

    A text that is null or has no letter (other numerals, as ½ or Ⅷ, are none), and any text under a model of no
    language, is ``und`` with score 0.  Of equally likely languages the first
    in name order is taken.  Whole texts count, and rows are independent, so
    repeated rows get equal results.  Columns of ``docs`` named ``lang_pred``
    or ``score`` are replaced.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = spread.value

        def compute(column: pa.Array):
            texts = strings(column)
            known = np.array([bool(model.languages) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
            chosen = [texts[i] for i in np.flatnonzero(known)]
            language = np.full(len(texts), UNDETERMINED, dtype=object)
            score = np.zeros(len(texts))
            if chosen:
                logs = score_texts(model, chosen)
                best = logs.argmax(axis=1)
                language[known] = np.array(model.languages, dtype=object)[best]
                score[known] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            return pa.array(language, pa.string()), pa.array(score, pa.float64())

        return compute

    return add_columns(docs, text, "lang_pred string, score double", prepare)
