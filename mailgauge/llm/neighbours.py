"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots.  Pivot inverted
files hold, for each pivot, the vectors that have it among their nearest ones
and at what rank.  A query goes through the files of its own nearest pivots;
vectors are ranked by the footrule distance between the two orders, and the
first of them are ranked anew by the distance itself.

Vectors are indexed in blocks, each an index of its own over a bounded number
of vectors, so that ranking and reranking take place where the vectors are.  Queries go to
all blocks, and a query's best of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.sources.scratch import land

PIVOTS = 256
PREFIX = 64
# Vectors of a block, queries of a block, and queries ranked at a time.
BLOCK = 4096
QUERY_BLOCK = 8192
QUERY_RUN = 64
# Share of a block's vectors that is reranked, and how many at least.
RERANKED = 0.25
RERANKED_LEAST = 200


def usable_vectors(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dimension: int | None = None
) -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part.

    Left out are rows whose id or vector is null, zero vectors, vectors with a null or
    non-finite component, and those not of ``dimension`` components, as vectors of
    different lengths have no distance; by default that is the commonest length (of equally common ones the longer).
    """
    v = F.col("vector")
    sound = (
        F.col("vec_id").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull() & sound)
    if dimension is None:
        lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
        first = lengths.orderBy(F.desc("n"), F.desc("d")).head()
        dimension = first.d if first else 0
    return rows.filter(F.size("vector") == dimension)


def _distinct_vectors(vectors: DataFrame, n: int) -> DataFrame:
    """vector, vec_id, members: every vector once, with its least id and the ``n`` least ones.

    A task sends no more than ``n`` rows of a vector on, however many have it.
    """
    least = Window.partitionBy("vector").orderBy("vec_id")
    first = vectors.select("vector", "vec_id").withColumn("place", F.row_number().over(least)).filter(F.col("place") <= n)
    return first.groupBy("vector").agg(
        F.min("vec_id").alias("vec_id"), F.array_sort(F.collect_list("vec_id")).alias("members")
    )


def choose_pivots(distinct: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """``n`` of some distinct vectors, those whose ids have the least hashes: a documented sample that only places pivots."""
    rows = distinct.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("vector").collect()
    return np.array([r.vector for r in rows], dtype=np.float64)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    distance = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(distance, axis=1, kind="stable")[:, :prefix].astype(np.int16)


class PermutationIndex:
    """Inverted files by pivot over a block of vectors.

    ``members`` are the ids of the rows that have each vector, in order, by default the one in ``ids``.
    """

    def __init__(
        self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, prefix: int, members: list | None = None
    ):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.members = [members[i] for i in order] if members else [[i] for i in self.ids.tolist()]
        self.prefix = min(prefix, len(pivots))
        near = nearest_pivots(self.vectors, pivots, self.prefix)
        rank = np.tile(np.arange(self.prefix, dtype=np.int16), len(ids))
        posts = np.argsort(near.ravel(), kind="stable")
        self.member = posts // max(self.prefix, 1)
        self.rank = rank[posts]
        self.begin = np.searchsorted(near.ravel()[posts], np.arange(len(pivots) + 1))

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """Distance of one query's order to all orders of the block; a pivot in one order only counts as last."""
        # Moves from "in neither order" by what each shared pivot saves.
        total = np.zeros(len(self.ids), dtype=np.int32)
        for rank, pivot in enumerate(near.tolist()):
            files = slice(self.begin[pivot], self.begin[pivot + 1])
            own = self.rank[files].astype(np.int32)
            saved = (self.prefix - rank) + (self.prefix - own) - np.abs(own - rank)
            total[self.member[files]] -= saved
        return total

    def search(self, ids: np.ndarray, queries: np.ndarray, near: np.ndarray, k: int, reranked: int):
        """(query, id, distance) of the k best of the block for each query, nearest first, ties to the smaller id."""
        for q in range(len(ids)):
            footrule = self.footrule(near[q])
            if reranked < len(footrule):
                # Of equal footrules the smaller ids come first: they are in id order.
                limit = np.partition(footrule, reranked - 1)[reranked - 1]
                below = np.flatnonzero(footrule < limit)
                at = np.flatnonzero(footrule == limit)[: reranked - len(below)]
                chosen = np.sort(np.concatenate([below, at]))
            else:
                chosen = np.arange(len(footrule))
            distance = np.sqrt(((self.vectors[chosen] - queries[q]) ** 2).sum(axis=1))
            best = np.argsort(distance, kind="stable")
            for n in (4 * k, len(best)):
                found = self._rows(ids[q], chosen[best[:n]], distance[best[:n]])
                if len(found) >= k:
                    break
            yield ids[q], np.array([i for _, i in found[:k]], np.int64), np.array([d for d, _ in found[:k]], np.float64)

    def _rows(self, query: int, vectors: np.ndarray, distance: np.ndarray) -> list[tuple[float, int]]:
        """(distance, id) of the rows with these vectors, nearest first; a repeated id counts once, the query's own not."""
        rows = sorted((d, i) for v, d in zip(vectors.tolist(), distance.tolist()) for i in self.members[v])
        nearest: dict[int, float] = {}
        for d, i in rows:
            if i != query:
                nearest.setdefault(i, d)
        return [(d, i) for i, d in nearest.items()]


_HITS = "query_id long, vec_id long, score double"


def _search_block(pivots, prefix: int, k: int, share: float, least: int):
    def run(keys, vectors, queries):
        found = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            p = pivots.value

            def matrix(table):
                return table.column("vector").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

            members = vectors.column("members").to_pylist()
            index = PermutationIndex(vectors.column("vec_id").to_numpy(), matrix(vectors), p, prefix, members)
            reranked = max(least, k + 1, int(np.ceil(share * vectors.num_rows)))
            ids, asked = queries.column("vec_id").to_numpy(), matrix(queries)
            near = nearest_pivots(asked, p, prefix)
            for query, hits, distance in index.search(ids, asked, near, k, reranked):
                found[0].append(np.full(len(hits), query))
                found[1].append(hits)
                found[2].append(distance)
        none = [np.empty(0)]
        return pa.Table.from_pydict(
            {
                "query_id": pa.array(np.concatenate(found[0] or none).astype(np.int64)),
                "vec_id": pa.array(np.concatenate(found[1] or none).astype(np.int64)),
                "score": pa.array(np.concatenate(found[2] or none).astype(np.float64)),
            }
        )

    return run


def _blocks(rows: DataFrame, size: int, salt: str) -> tuple[DataFrame, int]:
    n = max(1, -(-rows.count() // size))
    return rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.lit(n)).cast("int")), n


def search_nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    n_pivots: int = PIVOTS,
    prefix: int = PREFIX,
    reranked: float = RERANKED,
    least: int = RERANKED_LEAST,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, by Euclidean distance in doubles.

    Equal vectors are one in the index, with the k + 1 smallest of their ids, which is as many as a query can ask for:
    however many copies there are, they take one place among those that are ranked.  Both frames are as ``usable_vectors`` returns them, stored.  A query's
    own id is no candidate.  Ties go to the smaller vec_id; a vec_id that
    is repeated is one candidate, with its least distance, and a repeated
    query id is asked once, with its first vector in order.  Fewer than k
    candidates are all returned, an empty table gives no rows.
    """
    spark = vectors.sparkSession
    distinct = land(_distinct_vectors(vectors, k + 1))
    pivots = spark.sparkContext.broadcast(choose_pivots(distinct, n_pivots))
    blocked, n_blocks = _blocks(distinct, block, "block")
    once = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked, n_asked = _blocks(land(once), query_block, "query")
    # Each block of vectors meets each block of queries in one task of bounded size.
    left = blocked.select("vec_id", "vector", "members", "block", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("part"))
    right = asked.select(
        "vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.col("block").alias("part")
    )
    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    hits = met.applyInArrow(_search_block(pivots, prefix, k, reranked, least), _HITS)
    best = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def nearest_neighbours(
    table: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10, **options
) -> DataFrame:
    """The nearest neighbours of the rows for which ``is_query`` (over vec_id) holds, among all usable rows."""
    rows = land(usable_vectors(table, vec_id, vector).distinct())
    return search_nearest(rows, rows.filter(is_query), k, **options)
