"""A log-bilinear language model, trained by noise-contrastive estimation.

The two words before a token predict a vector, r(w1) C1 + r(w2) C2; a token's
score is the product of that vector with the token's own, plus a bias.  The
model's symbols are the commonest words of the training texts, the end of a
text, and classes of all other words by how they end, so every word there is has
one, before a token as well as after it.  Within its class a word has its share
of the smoothed counts, and what was never seen is one word more in each.  So
the probabilities of all words, and of anything else, add up to 1 after any two
words.

As the score is a sum over the two places, three tables of bounded size give
every log-probability: a product for each place, and the normaliser of each
pair of symbols, which is one product of exponentials.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import Words, add_columns, map_texts
from mailgauge.sources.scratch import land, remove

END = ""  # The end of a text; no word is empty.
# Words the model has vectors for, and words whose counts all tasks have; the counts of others are joined.
VOCABULARY = 1024
FREQUENT = 1 << 18
# Classes of the other words, by a hash of their last bytes.
CLASSES = 512
ENDING = 3
DIMENSION = 16
NOISE = 64
BATCH = 2048
RATE = 0.1
SEED = 20
# Tokens of a training shard, and of the stretches that a longer text is cut into.
SHARD_TOKENS = 1 << 20
STRETCH = 1 << 16
# Texts outside training that tell when to stop: one of so many, and no more than about so many tokens.
FOLD = 16
FOLD_TOKENS = 1 << 17
# Training ends when a round adds less than this share of what was gained so far.
SETTLED = 0.01
# Words a task gathers before it sends their counts on.
GATHERED = 1 << 20


class _WordCounter:
    """Counts by word over a task, sent on when there are many."""

    def __init__(self):
        self.parts, self.size = [], 0

    def __call__(self, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counted = Words(piece.column(0)).flat.value_counts()
        words = pa.chunked_array([counted.field(0), pa.array([END])])
        numbers = pa.chunked_array([counted.field(1), pa.array([piece.num_rows], pa.int64())])
        self.parts.append(pa.table({"word": words, "n": numbers}))
        self.size += len(words)
        if self.size > GATHERED:
            merged = self._merged()
            if merged.num_rows * 2 > GATHERED:
                yield from merged.to_batches()
                self.parts, self.size = [], 0
            else:
                self.parts, self.size = [merged], merged.num_rows

    def _merged(self) -> pa.Table:
        grouped = pa.concat_tables(self.parts).group_by("word").aggregate([("n", "sum")])
        return pa.table({"word": grouped.column("word").combine_chunks(), "n": grouped.column("n_sum").combine_chunks()})

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield from self._merged().to_batches()


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n over all texts; the empty word counts the texts."""
    parts = map_texts(docs.select(F.col(text).alias("text")), "word string, n long", _WordCounter, "text")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The end and the frequent words in falling order with their counts, and the totals over all words.

    The first ``size`` words are the vocabulary.  ``rest`` is the smoothed
    count of all words outside it, with one word that was never seen.
    ``class_tokens`` and ``class_types`` tell how often, and how many, words
    outside it are in each class.
    """

    words: pa.Array
    counts: np.ndarray
    tokens: int
    types: int
    size: int
    class_tokens: np.ndarray | None = None
    class_types: np.ndarray | None = None

    def __post_init__(self):
        if self.class_tokens is None:  # one class of all
            known = self.counts[: self.size]
            self.class_tokens = np.array([self.tokens - int(known.sum())], dtype=np.int64)
            self.class_types = np.array([self.types - len(known)], dtype=np.int64)

    @property
    def symbols(self) -> int:
        """Vocabulary words and classes."""
        return self.size + len(self.class_tokens)

    @property
    def class_totals(self) -> np.ndarray:
        """Smoothed counts of the classes' words, and of one word never seen in each."""
        return self.class_tokens + self.class_types + 1

    @property
    def rest(self) -> int:
        return self.tokens + self.types + 1 - int(self.counts[: self.size].sum()) - self.size

    def symbol_ids(self, words: pa.Array) -> np.ndarray:
        """Place in the vocabulary; for other words ``size`` and their class."""
        found = pc.index_in(words, value_set=self.words.slice(0, self.size))
        found = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        other = np.flatnonzero(found < 0)
        found[other] = self.size + classes_of(words.take(pa.array(other)), len(self.class_tokens))
        return found


def classes_of(words: pa.Array, n: int) -> np.ndarray:
    """The class of each word: crc32 of its last bytes modulo ``n``."""
    ends = (crc32(w[-ENDING:]) % n for w in words.cast(pa.binary()).to_pylist())
    return np.fromiter(ends, dtype=np.int64, count=len(words))


def class_column(word: Column, n: int) -> Column:
    """``classes_of`` for a column."""
    whole = word.cast("binary")
    last = F.when(F.octet_length(word) > ENDING, F.substring(whole, -ENDING, ENDING)).otherwise(whole)
    return (F.crc32(last) % n).cast("int")


def build_lexicon(
    counts: DataFrame, size: int = VOCABULARY, frequent: int = FREQUENT, classes: int = CLASSES
) -> Lexicon:
    """The end, then the words at least as common as a threshold that no more than ``frequent`` words reach.

    The threshold comes from a histogram of the counts' logarithms, so
    what reaches the driver is bounded by the parameters.
    """
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).head()
    ends = counts.filter(F.col("word") == END).head()
    words = counts.filter(F.col("word") != END)
    levels = words.groupBy(F.floor(F.log2("n") * 32).alias("level")).agg(
        F.count("*").alias("words"), F.min("n").alias("least")
    )
    threshold, taken = None, 0
    for row in sorted(levels.collect(), key=lambda r: -r.level):
        if taken + row.words > frequent:
            break
        threshold, taken = row.least, taken + row.words
    common = words.filter(F.col("n") >= threshold) if threshold else words.limit(0)
    table = common.select("word", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    names = [pa.array([END] if ends else [], pa.string()), *[c.cast(pa.string()) for c in table.column("word").chunks]]
    n = np.concatenate([[ends.n] if ends else [], table.column("n").to_numpy()]).astype(np.int64)
    lexicon = Lexicon(pa.concat_arrays(names), n, totals.tokens, totals.types, min(size, len(n)))
    if totals.tokens:
        by_class = words.groupBy(class_column(F.col("word"), classes).alias("class")).agg(
            F.sum("n").alias("tokens"), F.count("*").alias("types")
        )
        lexicon.class_tokens, lexicon.class_types = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
        for row in by_class.collect():
            lexicon.class_tokens[row["class"]], lexicon.class_types[row["class"]] = row.tokens, row.types
        # Without the words that are symbols of their own; the first is the end, if there is one.
        first = 1 if ends else 0
        own = classes_of(lexicon.words.slice(first, lexicon.size - first), classes)
        np.subtract.at(lexicon.class_tokens, own, n[first : lexicon.size])
        np.subtract.at(lexicon.class_types, own, 1)
    return lexicon


def sequences(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Words, pa.Array]:
    """(row, token, word before, word before that) over the words and end of each text; the words, and the distinct ones.

    Tokens are symbols (see ``Lexicon.symbol_ids``); before a text stands one
    that is none of them.
    """
    words = Words(texts)
    encoded = words.flat.dictionary_encode()
    ids = lexicon.symbol_ids(encoded.dictionary)
    tokens = ids[encoded.indices.to_numpy(zero_copy_only=False)] if len(words.flat) else np.empty(0, dtype=np.int64)
    tokens = np.insert(tokens, words.first[1:], 0)  # the end comes first in the vocabulary
    begins = words.first[:-1] + np.arange(len(texts))
    row = np.repeat(np.arange(len(texts)), np.diff(words.first) + 1)
    start = lexicon.symbols
    before = np.concatenate([[start], tokens[:-1]])
    before[begins] = start
    earlier = np.concatenate([[start], before[:-1]])
    earlier[begins] = start
    return row, tokens, before, earlier, words, encoded


class BilinearModel:
    """Parameters, their training on batches of tokens, and the tables of log-probabilities."""

    def __init__(self, unigram: np.ndarray, dimension: int = DIMENSION, seed: int = SEED):
        random = np.random.default_rng(seed)
        n = len(unigram)
        small = lambda *shape: random.normal(0, 0.3 / np.sqrt(dimension), shape).astype(np.float32)
        self.context = small(n + 1, dimension)
        self.target = small(n, dimension)
        self.place = np.stack([np.eye(dimension, dtype=np.float32)] * 2)
        self.bias = np.log(unigram).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.context, self.target, self.place, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()]).astype(np.float64)

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for p in self.parameters():
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(by word before and token, by word before that and token, normaliser by both words), natural logarithms."""
        context, target = self.context.astype(np.float64), self.target.astype(np.float64)
        near = context @ self.place[0] @ target.T
        far = context @ self.place[1] @ target.T + self.bias
        top_near, top_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        total = np.exp(near - top_near) @ np.exp(far - top_far).T
        normaliser = np.log(total) + top_near + top_far.T
        return near.astype(np.float32), far.astype(np.float32), normaliser.astype(np.float32)


class NoiseContrast:
    """Noise-contrastive estimation by AdaGrad; a batch shares its noise, so the work is matrix products."""

    def __init__(self, model: BilinearModel, unigram: np.ndarray, noise: int = NOISE, rate: float = RATE, seed: int = 0):
        self.model, self.noise, self.rate = model, noise, rate
        self.cumulative = np.cumsum(unigram)
        self.log_noise = np.log(noise * unigram).astype(np.float32)
        self.squares = [np.full(p.shape, 1e-2, dtype=np.float32) for p in model.parameters()]
        self.random = np.random.default_rng(seed)

    def step(self, tokens: np.ndarray, before: np.ndarray, earlier: np.ndarray) -> None:
        m, n = self.model, len(tokens)
        drawn = np.searchsorted(self.cumulative, self.random.random(self.noise) * self.cumulative[-1], side="right")
        drawn = np.minimum(drawn, len(self.cumulative) - 1)
        near, far = m.context[before], m.context[earlier]
        predicted = near @ m.place[0] + far @ m.place[1]
        own = (predicted * m.target[tokens]).sum(axis=1) + m.bias[tokens] - self.log_noise[tokens]
        other = predicted @ m.target[drawn].T + (m.bias[drawn] - self.log_noise[drawn])
        # Gradients of the log-likelihood of telling tokens from noise.
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-other, -30, 30)))
        pull = up[:, None] * m.target[tokens] + down @ m.target[drawn]
        context = _sum_rows(before, pull @ m.place[0].T, m.context.shape)
        context += _sum_rows(earlier, pull @ m.place[1].T, m.context.shape)
        target = _sum_rows(tokens, up[:, None] * predicted, m.target.shape)
        np.add.at(target, drawn, down.T @ predicted)
        bias = np.bincount(tokens, weights=up, minlength=len(m.bias))
        np.add.at(bias, drawn, down.sum(axis=0))
        place = np.stack([near.T @ pull, far.T @ pull])
        for p, g, s in zip(m.parameters(), (context, target, place, bias), self.squares):
            g = (g / n).astype(np.float32) * np.float32(32)
            s += g * g
            p += np.float32(self.rate) * g / np.sqrt(s)


def _sum_rows(index: np.ndarray, rows: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Rows added up by index."""
    cell = (index[:, None] * shape[1] + np.arange(shape[1])).ravel()
    return np.bincount(cell, weights=rows.ravel(), minlength=shape[0] * shape[1]).reshape(shape)


def symbol_shares(lexicon: Lexicon) -> np.ndarray:
    """The share of each symbol in the training tokens, all above zero."""
    shares = np.append(lexicon.counts[: lexicon.size], lexicon.class_tokens) + 1.0
    return shares / shares.sum()


def _streams(texts: pa.Array, keys: np.ndarray, lexicon: Lexicon) -> Iterator[tuple[int, int, np.ndarray]]:
    """(key, number, stream) of the stretches of each text.

    A stream holds the two places before a stretch as their complements, then its tokens.
    """
    row, tokens, before, earlier, _, _ = sequences(texts, lexicon)
    ends = np.searchsorted(row, np.arange(len(texts) + 1))
    for text, key in enumerate(keys.tolist()):
        for number, at in enumerate(range(ends[text], ends[text + 1], STRETCH)):
            stop = min(at + STRETCH, ends[text + 1])
            yield key, number, np.concatenate([[~earlier[at], ~before[at]], tokens[at:stop]])


def _read_stream(stream: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, word before, word before that) of streams put together."""
    marked = np.frombuffer(stream, dtype=np.int32).astype(np.int64)
    plain = np.where(marked < 0, ~marked, marked)
    at = np.flatnonzero(marked >= 0)
    return plain[at], plain[at - 1], plain[at - 2]


_HELD_OUT = -1


def training_shards(docs: DataFrame, lexicon: Lexicon, text: str, shard_tokens: int, fold_tokens: int) -> tuple[DataFrame, int]:
    """turn, shard, stream: one row per shard of about ``shard_tokens`` tokens, stored by turn; and the number of turns.

    A text's shard depends on its columns alone, and so does its place in it;
    copies of a row that a task meets are dealt like different rows.  Turns and shards of a turn grow alike, with the square root of the
    corpus.  Turn and shard _HELD_OUT are the fold that tells when to stop.
    """
    shards = max(1, round(lexicon.tokens / shard_tokens))
    turns = int(np.ceil(np.sqrt(shards)))
    fold = max(FOLD, -(-lexicon.tokens // fold_tokens))
    spread = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = docs.select(F.xxhash64(*[F.col(c) for c in docs.columns]).alias("key"), F.col(text).alias("text"))

    def prepare():
        lexicon = spread.value
        met: Counter[int] = Counter()

        def work(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            keys = piece.column(0).to_numpy()
            copy = np.empty(len(keys), dtype=np.int64)
            for at, key in enumerate(keys.tolist()):
                copy[at] = met[key]
                met[key] += 1
            found = list(_streams(piece.column(1), np.arange(len(keys)), lexicon))
            own = np.array([at for at, _, _ in found], dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(keys[own]),
                    "copy": pa.array(copy[own]),
                    "number": pa.array([number for _, number, _ in found], pa.int32()),
                    "stream": pa.array([stream.astype(np.int32).tobytes() for *_, stream in found], pa.binary()),
                }
            )

        return work

    encoded = map_texts(rows, "key long, copy long, number int, stream binary", prepare, "text")
    place = ("key", "copy", "number")
    dealt = F.xxhash64(*place, F.lit("shard"))
    shard = F.when(F.pmod(F.xxhash64(*place, F.lit("fold")), F.lit(fold)) == 0, _HELD_OUT).otherwise(
        F.pmod(dealt, F.lit(shards))
    )

    def join(keys, rows):
        rows = rows.sort_by([("key", "ascending"), ("number", "ascending")])
        stream = b"".join(rows.column("stream").to_pylist())
        number = keys[0].as_py()
        turn = number if number == _HELD_OUT else number % turns
        return pa.table(
            {"shard": pa.array([number], pa.int32()), "stream": pa.array([stream], pa.binary()), "turn": pa.array([turn], pa.int32())}
        )

    put = encoded.withColumn("shard", shard.cast("int")).groupBy("shard")
    return land(put.applyInArrow(join, "shard int, stream binary, turn int"), by="turn"), turns


class _State:
    """A model with its learner: all that a round changes, as one array."""

    def __init__(self, shares: np.ndarray, values: np.ndarray | None = None, seed=0):
        self.model = BilinearModel(shares)
        self.learner = NoiseContrast(self.model, shares, seed=seed)
        if values is not None:
            half = len(values) // 2
            self.model.set_flat(values[:half])
            at = half
            for s in self.learner.squares:
                s[...] = values[at : at + s.size].reshape(s.shape)
                at += s.size

    def values(self) -> np.ndarray:
        return np.concatenate([self.model.flat(), *[s.ravel() for s in self.learner.squares]])

    def learn(self, stream: bytes, seed) -> int:
        """One pass over the tokens in an order of the seed; their number."""
        tokens, before, earlier = _read_stream(stream)
        order = np.random.default_rng(seed).permutation(len(tokens))
        for at in range(0, len(tokens), BATCH):
            chosen = order[at : at + BATCH]
            self.learner.step(tokens[chosen], before[chosen], earlier[chosen])
        return len(tokens)


def _loss(model: BilinearModel, streams: list[bytes]) -> float:
    """Mean negative log-probability of a token."""
    near, far, normaliser = model.tables()
    total, n = 0.0, 0
    for stream in streams:
        tokens, before, earlier = _read_stream(stream)
        logs = near[before, tokens].astype(np.float64) + far[earlier, tokens] - normaliser[before, earlier]
        total, n = total - logs.sum(), n + len(tokens)
    return total / n


def _train_round(shards: DataFrame, shares: np.ndarray, start: np.ndarray, number: int) -> np.ndarray:
    """``start`` after each shard has been gone over from there, averaged by tokens."""
    spread = shards.sparkSession.sparkContext.broadcast((shares, start))

    class Train:
        def __init__(self):
            self.shares, self.start = spread.value
            self.total, self.seen = np.zeros(len(self.start)), 0

        def __call__(self, piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for shard, stream in zip(piece.column(0).to_pylist(), piece.column(1)):
                seed = [SEED, number, shard]
                state = _State(self.shares, self.start, seed)
                n = state.learn(stream.as_buffer(), seed)
                self.total += n * state.values()
                self.seen += n
            return iter(())

        def finish(self) -> Iterator[pa.RecordBatch]:
            if self.seen:
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": pa.array(np.arange(len(self.total), dtype=np.int32)),
                        "value": pa.array(self.total),
                        "weight": pa.array(np.full(len(self.total), float(self.seen))),
                    }
                )

    parts = map_texts(shards.select("shard", "stream"), "place int, value double, weight double", Train, "stream")
    averaged = parts.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value")).toArrow()
    spread.unpersist()
    if not averaged.num_rows:
        return start
    values = np.zeros(len(start))
    values[averaged.column("place").to_numpy()] = averaged.column("value").to_numpy()
    return values


def train_bilinear(
    docs: DataFrame,
    lexicon: Lexicon,
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
    fold_tokens: int = FOLD_TOKENS,
    settled: float = SETTLED,
) -> BilinearModel:
    """The model after rounds of training, each from the averaged parameters of the one before.

    In a round, each shard of one turn is gone over from the same start, in
    an order and with noise of its own; parameters and AdaGrad's sums are averaged by
    tokens.  Shards are of a fixed size and by a hash of the row, whatever the files and partitions.
    Rounds end when all turns have come and the loss on a hash fold, bounded in size and held by the
    driver, has settled; then the fold is learned from as well, so every token of every text is.
    As each round but the last must add a share of the gain, their number is bounded.
    One number per parameter and task is shuffled, one per parameter reaches the driver.
    """
    shares = symbol_shares(lexicon)
    if not lexicon.tokens:
        return BilinearModel(shares)
    shards, turns = training_shards(docs, lexicon, text, shard_tokens, fold_tokens)
    fold = [bytes(r.stream) for r in shards.filter(F.col("turn") == _HELD_OUT).select("stream").collect()]
    # Of a few texts none may be in the fold.
    watched = fold or [bytes(r.stream) for r in shards.select("stream").limit(1).collect()]
    state = _State(shares)
    values = state.values()
    losses = [_loss(state.model, watched)]
    best = reached = values
    number = 0
    while True:
        reached = _train_round(shards.filter(F.col("turn") == number % turns), shares, reached, number)
        number += 1
        losses.append(_loss(_State(shares, reached).model, watched))
        if number <= turns or losses[-1] <= min(losses[turns:]):
            best = reached
        # Turns differ a little, so two rounds are judged together.
        before = min(losses[:-2], default=losses[0])
        gained = before - min(losses[-2:])
        if number >= turns and gained <= max(0.0, 2 * settled * (losses[0] - before)):
            break
    remove(shards)
    state = _State(shares, best, [SEED, number])
    for stream in fold:
        state.learn(stream, [SEED, number])
    return state.model


_PARTS = (
    "n_tokens long, n_known long, base_part double, score_part double, rare array<struct<word: string, n: long>>"
)


def score_known(docs: DataFrame, lexicon: Lexicon, model: BilinearModel, text: str = "text") -> DataFrame:
    """``docs`` with its sums over frequent words, and the other words with their numbers."""
    spread = docs.sparkSession.sparkContext.broadcast((lexicon, model.tables()))

    def prepare():
        lexicon, (near, far, normaliser) = spread.value
        log_counts = np.log10(lexicon.counts + 1.0)
        log_total = np.log10(lexicon.tokens + lexicon.types + 1.0)
        # By symbol: what a word has to be divided by within its class, nothing for a word of the vocabulary.
        log_class = np.concatenate([np.zeros(lexicon.size), np.log10(lexicon.class_totals.astype(np.float64))])

        def compute(column: pa.Array):
            n = len(column)
            row, tokens, before, earlier, words, encoded = sequences(column, lexicon)
            logs = near[before, tokens].astype(np.float64) + far[earlier, tokens] - normaliser[before, earlier]
            score = np.bincount(row, weights=logs, minlength=n) / np.log(10)
            # Words by text: counts of frequent ones are at hand, the others are handed on.
            owner = words.rows()
            code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            place = pc.fill_null(pc.index_in(encoded.dictionary, value_set=lexicon.words), -1)
            place = place.to_numpy(zero_copy_only=False).astype(np.int64)[code] if len(code) else code
            known = place >= 0
            own = log_counts[place[known]]
            base = np.bincount(owner[known], weights=own - log_total, minlength=n).astype(np.float64)
            outside = place[known] >= lexicon.size
            score += np.bincount(owner[known][outside], weights=own[outside], minlength=n)
            score -= np.bincount(row, weights=log_class[tokens], minlength=n)
            n_known = np.bincount(owner[known], minlength=n)
            if lexicon.size:  # the end comes first
                base += log_counts[0] - log_total
                n_known = n_known + 1
            sizes = np.diff(words.first) + 1
            base -= (sizes - n_known) * log_total
            pairs, times = np.unique(np.stack([owner[~known], code[~known]]), axis=1, return_counts=True)
            offsets = np.searchsorted(pairs[0], np.arange(n + 1)).astype(np.int32)
            rare = pa.StructArray.from_arrays(
                [encoded.dictionary.take(pa.array(pairs[1])), pa.array(times.astype(np.int64))], ["word", "n"]
            )
            return (
                pa.array(sizes),
                pa.array(n_known.astype(np.int64)),
                pa.array(base),
                pa.array(score),
                pa.ListArray.from_arrays(pa.array(offsets), rare),
            )

        return compute

    return add_columns(docs, text, _PARTS, prepare)


def score_texts(docs: DataFrame, learn_from: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learned from the rows for which ``learn_from`` (over doc_id) holds.  A
    null text is as an empty one: its only token is the end.  If there is
    nothing to learn from, the model knows one symbol, and both scores are 0.
    Long texts are scored whole, repeated rows alike; an empty table gives no rows.

    Counts of frequent words are broadcast; the other words of a text, by
    their nature few, are joined to the table of all counts.  Where a word
    was never seen it adds nothing to that sum, so the join is an inner one.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    taught = base if learn_from is None else base.filter(learn_from)
    counts = land(count_words(taught))
    lexicon = build_lexicon(counts)
    model = train_bilinear(taught, lexicon)
    scored = land(score_known(base, lexicon, model).drop("text").withColumn("row", F.monotonically_increasing_id()))
    words = scored.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", F.col("rare.n").alias("times"))
    met = words.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs")
    )
    none = F.lit(0)
    return (
        scored.drop("rare")
        .join(met, "row", "left")
        .select(
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.coalesce("known", none)).alias("n_known"),
            F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
            (F.col("base_part") + F.coalesce("logs", none)).alias("base_score"),
            (F.col("score_part") + F.coalesce("logs", none)).alias("score"),
        )
    )
