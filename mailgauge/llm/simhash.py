"""SimHash near-duplicates, candidates filtered along a ring of fingerprint segments.

A fingerprint of 64 bits is cut into SEGMENTS consecutive segments on a ring.
If two fingerprints differ in at most ``max_distance`` bits, then the ring has
a start from which every chain of ``l`` segments differs in at most
``l * max_distance / SEGMENTS`` bits (pigeonring principle; for chains of one
segment it is the pigeonhole principle).  With 5 segments and 4 bits the
budgets are 0, 1, 2, 3 and 4.  So some segment is equal and its successor
differs in at most one bit: the two together are the join key, and the side
whose second segment has an even number of bits also comes with each of its
bits flipped.  What meets under a key is checked along the longer chains, and
what is left by the full distance.

Groups under a key are searched without listing pairs: from a fingerprint to
all not yet reached ones that link to it, and on from those.  So a group of
near copies costs a few passes over it and gives a tree, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import Words, add_columns, numbered, position
from mailgauge.llm.components import connected_components
from mailgauge.sources.scratch import gathered, land

BITS = 64
SEGMENTS = 5
# Keys of a fingerprint on average: its own of each segment, and those that one flip reaches in half of the cases.
KEYS = SEGMENTS + BITS // 2
# Shingles hashed at a time.
RUN_SHINGLES = 1 << 16
# Fingerprints under one key that a task holds; more are searched in pairs of blocks.
BLOCK = 1 << 20
SEED = 42  # Fixed value: seed of the shingle hash.

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint_words(words: list[bytes], shingle: int) -> int:
    """The fingerprint of a sequence of words; 0 for none."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        begins, ends = [0], ends[-1:]
    else:
        begins = np.concatenate([[0], ends[:-shingle] + 1])
        ends = ends[shingle - 1 :]
    total = len(ends)
    ones = np.zeros(BITS, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, total, RUN_SHINGLES):
        pairs = zip(np.asarray(begins[at : at + RUN_SHINGLES]).tolist(), ends[at : at + RUN_SHINGLES].tolist())
        h = np.array([hashed(joined[b:e], SEED) for b, e in pairs], dtype=np.uint64)
        if len(h) < 64:
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:  # a histogram of each of the eight bytes, then the bits of each byte value
            cell = h.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(8) * 256
            histogram = np.bincount(cell.ravel(), minlength=8 * 256).reshape(8, 256)
            ones += (histogram @ _BIT_OF_BYTE).ravel()
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """``docs`` with ``fingerprint``, 64 bits as a signed long.  A null text is as one without words: 0."""

    def prepare():
        def compute(column: pa.Array):
            words = Words(column)
            flat = words.flat.cast(pa.binary()).to_pylist()
            values = [
                fingerprint_words(flat[a:b], shingle)
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())
            ]
            return (pa.array(np.array(values, dtype=np.uint64).view(np.int64)),)

        return compute

    return add_columns(docs, text, "fingerprint long", prepare)


def _segment(at: int) -> tuple[int, int]:
    """Lowest bit and width of a segment."""
    begin, end = (k * BITS // SEGMENTS for k in (at % SEGMENTS, at % SEGMENTS + 1))
    return begin, end - begin


def _mask(start: int, length: int) -> int:
    """The bits of a chain of segments."""
    spans = (_segment(start + k) for k in range(length))
    return sum(((1 << width) - 1) << begin for begin, width in spans)


def _bits(column: str, at: int) -> Column:
    begin, width = _segment(at)
    return F.shiftrightunsigned(column, begin).bitwiseAND(F.lit((1 << width) - 1))


def candidate_keys(fingerprints: DataFrame) -> DataFrame:
    """key, fingerprint, own: a fingerprint's five keys, and those it reaches by one flipped bit."""
    rows = []
    for start in range(SEGMENTS):
        first, second = _bits("fingerprint", start), _bits("fingerprint", start + 1)
        width = _segment(start + 1)[1]
        own = F.lit(start).cast("long") * (1 << 26) + first * (1 << width) + second
        flips = F.array(
            *[F.struct(own.bitwiseXOR(F.lit(1 << b)).alias("key"), F.lit(False).alias("own")) for b in range(width)]
        )
        none = F.slice(flips, 1, 0)
        reached = F.when(F.bit_count(second) % 2 == 0, flips).otherwise(none)
        rows.append(F.concat(F.array(F.struct(own.alias("key"), F.lit(True).alias("own"))), reached))
    keys = fingerprints.select("fingerprint", F.explode(F.concat(*rows)).alias("_k"))
    return keys.select(F.col("_k.key").alias("key"), "fingerprint", F.col("_k.own").alias("own"))


def _linked(x: np.uint64, others: np.ndarray, start: int, max_distance: int) -> np.ndarray:
    """Places in ``others`` that keep the budget of every chain from ``start`` on, and the whole distance."""
    places = np.arange(len(others))
    difference = others ^ x
    for length in range(1, SEGMENTS + 1):
        mask = np.uint64(_mask(start, length))
        near = np.bitwise_count(difference & mask) <= length * max_distance // SEGMENTS
        places, difference = places[near], difference[near]
    return places


def spanning_links(values: np.ndarray, start: int, max_distance: int, side: np.ndarray | None = None) -> list[tuple]:
    """A tree for every set of distinct fingerprints that links hold together.

    With ``side``, links are sought between the two sides only.
    """
    left = np.arange(len(values))
    links = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            here = front.pop()
            sought = left if side is None else left[side[left] != side[here]]
            near = sought[_linked(values[here], values[sought], start, max_distance)]
            if len(near):
                links += [(values[here], values[n]) for n in near]
                front += near.tolist()
                left = left[~np.isin(left, near, assume_unique=True)]
    return links


LINK, DEFERRED = 0, 1
_FOUND = "kind int, key long, block long, a long, b long"


def _found(kind: int, key: int | None, block: int | None, a, b) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_pydict(
        {
            "kind": pa.array(np.full(n, kind, dtype=np.int32)),
            "key": pa.array([key] * n, pa.int64()),
            "block": pa.array([block] * n, pa.int64()),
            "a": pa.array(np.asarray(a, dtype=np.uint64).view(np.int64)),
            "b": pa.array(np.asarray(b, dtype=np.uint64).view(np.int64)),
        }
    )


class _GroupSearch:
    """Over rows sorted by key: links within each group, and the rows of groups longer than a block."""

    def __init__(self, max_distance: int, block: int):
        self.max_distance, self.block = max_distance, block
        self.key, self.held, self.blocks = None, [], 0

    def links(self, key: int, values: np.ndarray) -> list[tuple]:
        return spanning_links(values, key >> 26, self.max_distance)

    def close_block(self, more: bool) -> Iterator[pa.RecordBatch]:
        """Search what is held; rows of a group of several blocks go out to be searched against each other."""
        values = np.concatenate(self.held)
        if links := self.links(self.key, values):
            yield _found(LINK, None, None, *zip(*links))
        if more or self.blocks:
            yield _found(DEFERRED, self.key, self.blocks, values, values)
        self.held, self.blocks = [], self.blocks + 1

    def add(self, key: int | None, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of a group that may go on in the next batch."""
        if key != self.key:
            if self.held:
                yield from self.close_block(more=False)
            self.key, self.blocks = key, 0
        for at in range(0, len(values), self.block):
            if sum(map(len, self.held)) >= self.block:
                yield from self.close_block(more=True)
            self.held.append(values[at : at + self.block].copy())

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            own = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            begins, ends = edges[:-1], edges[1:]
            yield from self.add(int(keys[0]), values[: ends[0]])
            links = []
            inside = (ends - begins > 1) & (np.add.reduceat(own, begins) > 0)
            inside[[0, -1]] = False
            for g in np.flatnonzero(inside).tolist():
                if ends[g] - begins[g] <= self.block:
                    links += self.links(int(keys[begins[g]]), values[begins[g] : ends[g]])
                else:
                    yield from self.add(int(keys[begins[g]]), values[begins[g] : ends[g]])
            if links:
                yield _found(LINK, None, None, *zip(*links))
            if len(begins) > 1:
                yield from self.add(int(keys[-1]), values[begins[-1] :])
        yield from self.add(None, np.empty(0, dtype=np.uint64))


def _search_between(max_distance: int):
    """Links between two blocks of one key."""

    def run(keys, table):
        values = table.column("a").to_numpy().view(np.uint64)
        side = table.column("block").to_numpy()
        links = spanning_links(values, int(table.column("key")[0].as_py()) >> 26, max_distance, side)
        a, b = zip(*links) if links else ((), ())
        return pa.Table.from_pydict(
            {
                "a": pa.array(np.asarray(a, dtype=np.uint64).view(np.int64)),
                "b": pa.array(np.asarray(b, dtype=np.uint64).view(np.int64)),
            }
        )

    return run


def link_fingerprints(fingerprints: DataFrame, max_distance: int = 4, block: int = BLOCK) -> DataFrame:
    """a, b: links that hold together exactly what links of at most ``max_distance`` bits hold together.

    ``fingerprints`` has distinct values.  A key's rows beyond ``block`` are
    searched block by block and then in pairs of blocks.
    """
    if max_distance >= SEGMENTS:
        raise ValueError(f"one equal segment in {SEGMENTS} is certain for fewer than {SEGMENTS} bits only")
    keyed = candidate_keys(fingerprints).repartition("key")
    found = land(
        gathered(keyed, KEYS * fingerprints.count())
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: _GroupSearch(max_distance, block)(batches), _FOUND)
    )
    links = found.filter(F.col("kind") == LINK).select("a", "b")
    deferred = found.filter(F.col("kind") == DEFERRED)
    if not deferred.head(1):
        return gathered(links.distinct(), links.count())
    last = deferred.groupBy("key").agg(F.max("block").alias("last"))
    pairs = (
        deferred.join(last, "key")
        .select("key", "block", "a", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
        .filter("block <> other")
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )
    between = pairs.groupBy("key", "low", "high").applyInArrow(_search_between(max_distance), "a long, b long")
    return links.union(between).distinct()


def first_of_components(rows: DataFrame, first: Column, max_distance: int = 4, block: int = BLOCK) -> DataFrame:
    """fingerprint, first: for every fingerprint the least ``first`` of its component's rows.

    ``first`` is an expression over ``rows``, a stored table with
    ``fingerprint``.  Minima are taken by fingerprint before anything is joined, and what is
    joined is stored, so that adaptive execution can split the rows of a very
    common fingerprint or a very large component.
    """
    least = rows.groupBy("fingerprint").agg(F.min(first).alias("first"))
    by_print = land(gathered(least, rows.count()))
    prints = by_print.count()
    roots = connected_components(link_fingerprints(by_print.select("fingerprint"), max_distance, block))
    linked = land(gathered(by_print.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint"), prints))
    heads = land(gathered(linked.groupBy("root").agg(F.min("first").alias("head")), prints))
    moved = linked.join(heads, "root").select("fingerprint", "head")
    firsts = by_print.join(moved, "fingerprint", "left").select("fingerprint", F.coalesce("head", "first").alias("first"))
    return land(gathered(firsts, prints))


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach.

    One row per row of ``docs``.  A null id names no component: such rows get
    the smallest id of the others, or null if there is none.  Texts without
    words have fingerprint zero and are linked like any other.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = land(with_fingerprint(base, "text", shingle).select("doc_id", "fingerprint"))
    components = first_of_components(prints, F.col("doc_id"), max_distance)
    found = prints.join(components, "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"),
    )
    return gathered(found, prints.count())


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those of its smallest doc_id, one row each.

    Rows with an id come before those without.  All columns are returned as
    they are.  Each row is numbered in a stored copy, so that of rows equal
    in every column one stays.
    """
    rows = numbered(docs)
    kept = land(
        with_fingerprint(rows, position(docs, text), shingle).withColumn("row", F.monotonically_increasing_id())
    )
    narrow = kept.select("row", F.col(position(docs, doc_id)).alias("id"), "fingerprint")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    survivors = first_of_components(narrow, first, max_distance).select(F.col("first.row").alias("row")).distinct()
    return kept.join(survivors, "row", "left_semi").select(rows.columns).toDF(*docs.columns)
