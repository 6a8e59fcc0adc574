"""Importance resampling of documents towards a target distribution.

Features are the runs of one to three words, hashed into buckets by crc32.  How much more often a bucket is met in the
target than in the corpus is its gain; a document's weight is the sum over its features.  A draw without replacement
takes the highest weights after adding Gumbel noise made from the document's id.

Word runs are formed by Arrow and numpy on whole batches: texts are lowered and split by kernels, words become
dictionary indices, and runs are pairs of shifted indices, encoded again, so that each distinct pair or triple is hashed once.
The crc32 of a run follows from those of its parts, as the crc of a concatenation is linear in them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import add_columns, map_texts
from mailgauge.llm.ranks import ranked
from mailgauge.sources.scratch import land

BUCKETS = 10_000
MAX_RUN = 3
MIN_WORDS = 20
DRAWN_PERCENT = 5
# Gains, weights and scores are thousandths, rounded down.
SCALE = 1000
SEED = 42

# Fixed value: the characters that are in no word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words whose runs are formed at a time.
WORDS_AT_A_TIME = 1 << 19
# Fixed value: the reversed polynomial of crc32.
POLYNOMIAL = 0xEDB88320


class _Shift:
    """crc32 of a followed by b, from both their crc32 and the length of b."""

    def __init__(self) -> None:
        # What a one bit of a crc becomes by one more zero byte.
        step = np.zeros(32, dtype=np.uint32)
        for bit in range(32):
            value = 1 << bit
            for _ in range(8):
                value = (value >> 1) ^ (POLYNOMIAL if value & 1 else 0)
            step[bit] = value
        self._bits = {1: step}
        self._bytes: dict[int, np.ndarray] = {}

    @staticmethod
    def _apply(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), dtype=np.uint32)
        for bit in range(32):
            out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), bits[bit], np.uint32(0))
        return out

    def _by_bit(self, length: int) -> np.ndarray:
        if length not in self._bits:
            half = self._by_bit(length // 2)
            twice = self._apply(half, half)
            self._bits[length] = self._apply(self._bits[1], twice) if length % 2 else twice
        return self._bits[length]

    def _by_byte(self, length: int) -> np.ndarray:
        """The same as four tables of 256 entries."""
        if length not in self._bytes:
            if len(self._bytes) > 4096:  # lengths that many words have are worked out again soon
                self._bytes.clear()
            values = np.arange(256, dtype=np.uint32)
            bits = self._by_bit(length)
            self._bytes[length] = np.stack([self._apply(bits, values << np.uint32(8 * b)) for b in range(4)])
            if length > 64:
                self._bits = {k: v for k, v in self._bits.items() if k <= 64}
        return self._bytes[length]

    def joined(self, first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = second.copy()
        order = np.argsort(lengths, kind="stable")
        found, begin = np.unique(lengths[order], return_index=True)
        for length, at in zip(found.tolist(), np.split(order, begin[1:])):
            tables, crc = self._by_byte(length), first[at]
            for b in range(4):
                out[at] ^= tables[b][(crc >> np.uint32(8 * b)) & np.uint32(0xFF)]
        return out


def _encoded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each code among the distinct ones, and these."""
    encoded = pa.array(codes).dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary.to_numpy()


class _Features:
    """Words and feature buckets of a piece of texts."""

    def __init__(self, buckets: int, max_run: int) -> None:
        self._buckets, self._max_run, self._shift = np.uint32(buckets), max_run, _Shift()

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words, and where each text's begin (one entry more than texts).  A null text has none."""
        # Bytes, as every byte of a longer character belongs to words and a text need not be valid.
        lowered = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.binary())
        lists = pc.split_pattern_regex(lowered, SEPARATORS)
        rows = pc.list_parent_indices(lists)
        flat = pc.list_flatten(lists)
        real = pc.greater(pc.binary_length(flat), 0)
        counts = np.bincount(rows.filter(real).to_numpy(), minlength=len(texts))
        return flat.filter(real), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)

    def buckets(self, words: pa.Array, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets of features and the word each begins with, some words at a time."""
        for start in range(0, len(words), WORDS_AT_A_TIME):
            stop = min(start + WORDS_AT_A_TIME, len(words))
            # The last runs that begin here reach into the next words.
            reach = min(stop + self._max_run - 1, len(words))
            # The words that follow each one in its text, itself included.
            ends = first[np.searchsorted(first, np.arange(start, stop), side="right")]
            left = ends - np.arange(start, stop)
            yield from self._runs(words.slice(start, reach - start), left, start)

    def _runs(self, words: pa.Array, left: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        encoded = words.dictionary_encode()
        index, distinct = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()
        crc = np.fromiter((zlib.crc32(w) for w in distinct), dtype=np.uint32, count=len(distinct))
        spaced = np.fromiter((zlib.crc32(w, _SPACE) for w in distinct), dtype=np.uint32, count=len(distinct))
        lengths = np.fromiter((len(w) + 1 for w in distinct), dtype=np.int64, count=len(distinct))
        at = np.arange(len(left))
        run, run_crc = index[: len(left)], crc
        for n in range(1, self._max_run + 1):
            if n > 1:
                long_enough = left[at] >= n
                at, run = at[long_enough], run[long_enough]
                # A run is an earlier run and one more word; each distinct one is hashed once.
                codes, known = _encoded(run * len(distinct) + index[at + n - 1])
                shorter, last = known // max(len(distinct), 1), known % max(len(distinct), 1)
                run, run_crc = codes.astype(np.int64), self._shift.joined(run_crc[shorter], spaced[last], lengths[last])
            yield (run_crc % self._buckets).astype(np.int64)[run], at + start


_SPACE = zlib.crc32(b" ")


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any.

    A task sends one row for each bucket it has met.
    """

    def prepare():
        features = _Features(buckets, max_run)
        total = np.zeros(buckets, dtype=np.int64)

        def count(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            words, first = features.words(piece.column(0))
            for found, _ in features.buckets(words, first):
                total[:] += np.bincount(found, minlength=buckets)
            return iter(())

        def finish() -> Iterator[pa.RecordBatch]:
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

        count.finish = finish
        return count

    counted = map_texts(docs.select(F.col(text).cast("string").alias("text")), "bucket long, n long", prepare, "text")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain of all buckets, from two tables of ``bucket_counts``."""
    every = corpus.sparkSession.range(buckets).toDF("bucket")
    counts = (
        corpus.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t"))
        .unionAll(target.select("bucket", F.lit(0), "n"))
        .unionAll(every.select("bucket", F.lit(0), F.lit(0)))
        .groupBy("bucket")
        .agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    )
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return counts.join(F.broadcast(totals)).select("bucket", F.floor(SCALE * F.log(ratio)).alias("gain"))


def weigh(
    docs: DataFrame, gains: DataFrame, text: str = "text", buckets: int = BUCKETS, max_run: int = MAX_RUN
) -> DataFrame:
    """``docs`` with n_words, n_features and weight, the sum of its features' gains (longs).

    The gains, one number for each of ``buckets`` buckets, go to every task.
    """
    table = np.zeros(buckets, dtype=np.int64)
    for found in gains.toArrow().to_batches():
        table[found.column("bucket").to_numpy()] = found.column("gain").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def prepare():
        features, gain = _Features(buckets, max_run), shared.value

        def compute(texts: pa.Array):
            words, first = features.words(texts)
            n_words = np.diff(first)
            # Sums of all features that begin with a word, then of a text's words.
            by_word = np.zeros(len(words) + 1, dtype=np.int64)
            for found, begins in features.buckets(words, first):
                by_word[begins] += gain.take(found)
            filled = n_words > 0
            weight = np.zeros(len(n_words), dtype=np.int64)
            if filled.any():
                weight[filled] = np.add.reduceat(by_word[:-1], first[:-1][filled])
            n_features = sum(np.maximum(n_words - n, 0) for n in range(max_run))
            return [pa.array(n_words), pa.array(n_features), pa.array(weight)]

        return compute

    return add_columns(docs, text, "n_words long, n_features long, weight long", prepare)


def gumbel_noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise, told by the id; a null id counts as an empty text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((hashed + 0.5) / float(1 << 32))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = DRAWN_PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs``.

    Of the N rows with at least ``min_words`` words, those with the floor(``percent`` * N / 100) highest scores are drawn and
    have a rank from 1, ties to the smaller id, a null id first; rows equal in both are drawn in any order.

    A null or empty text has no features and weight 0.  A repeated row is a document of its own, with the same score.
    Long texts are worked on some words at a time.  An empty ``target`` or no ``docs`` leave counts of 0, which the
    formula allows.  Other columns of ``docs`` play no part.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    gains = bucket_gains(bucket_counts(base), bucket_counts(target, target_text))
    weighed = weigh(base, gains).drop("text")
    scored = weighed.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id")))
    eligible = F.col("n_words") >= min_words
    # Rows that cannot be drawn come last in the same order, so that nothing has to be joined back.
    placed = ranked(
        scored.select("*", (~eligible).alias("_out"), (-F.col("score")).alias("_down")), [], ["_out", "_down", "doc_id"]
    )
    placed = land(placed.drop("_down", "size"))
    allowed = placed.agg(F.expr(f"count_if(NOT _out) * {percent} div 100").alias("_drawn"))
    drawn = ~F.col("_out") & (F.col("rank") < F.col("_drawn"))
    return placed.join(F.broadcast(allowed)).select(
        "doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("rank") + 1).alias("rank")
    )
