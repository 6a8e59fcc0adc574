"""Near-duplicate vectors: all pairs of one label whose cosine reaches a threshold.

Vectors are scaled to length one and turned into the axes of the greatest spread over the whole table.  Most of a product
of two vectors then comes from their leading coordinates, and what the others can add is bounded by the product of
the lengths of the two remainders.  Tiles are compared from the leading coordinates on, and given up when no pair
can reach the threshold any more; pairs left at the end are compared by the cosine of the vectors themselves.

Equal vectors are one vector with a count.  A label's vectors are dealt to tiles by hash, and each pair of tiles is a group of
bounded size.  A group returns a row for each vector with links, never its links: how many it has found, and the least of
the vectors that its links reach within the group, from which the components are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.llm.common import numbered, position
from mailgauge.llm.components import connected_components
from mailgauge.sources.scratch import land

MIN_COSINE = 0.93
# A label of n vectors has sqrt(n / DEAL) tiles, so that tiles and the copies of a vector grow alike, and more where
# one would hold over LARGEST vectors.
DEAL = 256
LARGEST = 1 << 16
# Vectors of one side, and pairs left over, that are compared at a time.
SIDE = 512
RUN = 4096
# Axes are worked out for vectors of up to so many components; longer ones are compared in the given axes.
MAX_AXES = 1024
# Bounds are widened by this much, far beyond what rounding adds.
SLACK = 1e-9


def _sound(vector: Column) -> Column:
    """Whether a vector is not null, of finite components without nulls, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    # The largest component first, so that no square is too large or too small for a double.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes by number of components, those of the greatest spread first, from all rows of ``vectors`` (vector).

    Tasks send sums of products; the driver gets one number for each pair of axes.  Only the commonest number of
    components, if it is at most MAX_AXES, has axes: they make comparisons shorter, not other.
    """
    lengths = vectors.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), "d").head()
    if first is None or first.d > MAX_AXES:
        return {}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((first.d, first.d))
        for batch in batches:
            unit = _scaled(_matrix(batch.column(0)))
            total += unit.T @ unit
        row, column = np.triu_indices(first.d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(column), pa.array(total[row, column])], names=["i", "j", "value"]
        )

    of_length = vectors.filter(F.size("vector") == first.d).select("vector")
    sums = of_length.mapInArrow(products, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value"))
    spread = np.zeros((first.d, first.d))
    for batch in sums.toArrow().to_batches():
        i, j, value = (c.to_numpy() for c in batch.columns)
        spread[i, j] = spread[j, i] = value
    return {first.d: np.linalg.eigh(spread)[1][:, ::-1]}


class _Links:
    """Links found between the vectors of a group: how many by vector, and which vectors they join."""

    def __init__(self, copies: np.ndarray):
        self._copies = copies
        self.found = np.zeros(len(copies), dtype=np.int64)
        self.root = np.arange(len(copies))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.found, a, self._copies[b])
        np.add.at(self.found, b, self._copies[a])
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further


def _steps(dimension: int) -> list[int]:
    """Where products are looked at: after an eighth, a quarter and half of the coordinates, and at the end."""
    return sorted({max(1, dimension >> 3), max(1, dimension >> 2), max(1, dimension >> 1), dimension})


def compare(
    vectors: np.ndarray,
    axes: np.ndarray | None,
    left: np.ndarray,
    right: np.ndarray | None,
    links: _Links,
    least: float,
) -> None:
    """Add the links between rows ``left`` and ``right`` of ``vectors``, or among ``left``."""
    unit = _scaled(vectors)
    turned = unit if axes is None else unit @ axes
    stops = _steps(vectors.shape[1])
    # Length of what follows each stop.
    squares = np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1]
    rest = [np.sqrt(squares[:, s]) if s < vectors.shape[1] else np.zeros(len(vectors)) for s in stops]
    among = right is None
    right = left if among else right
    for p in range(0, len(left), SIDE):
        for q in range(p if among else 0, len(right), SIDE):
            a, b = left[p : p + SIDE], right[q : q + SIDE]
            i, j = _candidates(turned, rest, stops, a, b, least)
            if among and p == q:
                i, j = i[i < j], j[i < j]
            if len(i):
                a, b = a[i], b[j]
                cosine = np.empty(len(a))
                for k in range(0, len(a), RUN):
                    some = slice(k, k + RUN)
                    cosine[some] = np.einsum("ij,ij->i", unit[a[some]], unit[b[some]])
                links.add(a[cosine >= least], b[cosine >= least])


def _candidates(turned, rest, stops, a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and b of the pairs that may reach ``least``."""
    product, done = np.zeros((len(a), len(b))), 0
    for stop, remainder in zip(stops, rest):
        product += turned[a, done:stop] @ turned[b, done:stop].T
        able = product + np.outer(remainder[a], remainder[b]) >= least - SLACK
        i, j = np.nonzero(able)
        done = stop
        # No pair can reach it, or so few that the caller rather takes them one by one.
        if len(i) <= SIDE:
            break
    return i, j


_FOUND = "node struct<id:long,key:long>, root struct<id:long,key:long>, links long"


def _compare_tiles(axes, least: float):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("key", "ascending")])
        tile = group.column("tile").to_numpy()
        vectors = _matrix(group.column("vector"))
        links = _Links(group.column("copies").to_numpy())
        first, second = key[1].as_py(), key[2].as_py()
        left = np.flatnonzero(tile == first)
        right = None if first == second else np.flatnonzero(tile == second)
        if right is None or (len(left) and len(right)):
            compare(vectors, axes.value.get(vectors.shape[1]), left, right, links, least)
        met = np.flatnonzero(links.found)
        ids, keys = group.column("id").to_numpy(), group.column("key").to_numpy()

        def node(at: np.ndarray) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(ids[at]), pa.array(keys[at])], names=["id", "key"])

        return pa.table([node(met), node(links.root[met]), pa.array(links.found[met])], names=["node", "root", "links"])

    return run


def _tiled(distinct: DataFrame, deal: int, largest: int) -> DataFrame:
    """Rows of ``distinct`` once for every pair of tiles they are compared in."""
    sizes = land(distinct.groupBy("part").agg(F.count("*").alias("n")))
    tiles = F.greatest(F.ceil(F.sqrt(F.col("n") / deal)), F.ceil(F.col("n") / largest)).cast("int")
    sized = distinct.join(sizes.select(F.col("part").alias("_part"), tiles.alias("tiles")), F.col("part") == F.col("_part"))
    dealt = sized.withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "key", "id"), F.col("tiles")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    pair = [F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second")]
    return dealt.select("part", "id", "key", "vector", "copies", "tile", each).select("*", *pair).drop("other")


def near_duplicates(
    table: DataFrame,
    least: float = MIN_COSINE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    deal: int = DEAL,
    largest: int = LARGEST,
) -> DataFrame:
    """``table`` with columns named by position, and n_links, component_id, kept.

    Rows link if their labels are equal and not null, their vectors have equally many components, and their cosine, in
    doubles, is at least ``least`` (which must be above 0).  ``n_links`` counts the other rows that a row links with,
    ``component_id`` is the smallest id that links lead to, the row's own included, and ``kept`` says that it is its own.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without an id
    (component_id null, kept).  Rows are vectors of their own also where an id is repeated.  Tables without rows give none.
    """
    if least <= 0:
        raise ValueError("least must be above 0")
    id_, vec, lab = (position(table, c) for c in (vec_id, vector, label))
    rows = numbered(table).withColumn("_usable", F.col(id_).isNotNull() & F.col(lab).isNotNull() & _sound(F.col(vec)))
    named = rows.filter("_usable").select(
        F.col(id_).cast("long").alias("id"), F.col(vec).alias("vector"), F.struct(F.col(lab), F.size(vec)).alias("part")
    )
    distinct = named.groupBy("part", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # Different vectors may have the same least id, where ids are repeated.
    distinct = land(distinct.withColumn("key", F.xxhash64("part", "vector")))
    axes = distinct.sparkSession.sparkContext.broadcast(principal_axes(distinct))

    pairs = _tiled(distinct, deal, largest).groupBy("part", "first", "second")
    found = land(pairs.applyInArrow(_compare_tiles(axes, least), _FOUND))
    reached = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    described = land(
        distinct.withColumn("node", F.struct("id", "key"))
        .join(links, "node", "left")
        .join(reached, "node", "left")
        .select(
            F.col("part").alias("_part"),
            F.col("vector").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root.id", "id").alias("component_id"),
        )
    )
    # One row for each distinct vector, so a vector that very many rows share meets a single row.
    part = F.when(F.col("_usable"), F.struct(F.col(lab), F.size(vec)))
    met = rows.join(described, (part == F.col("_part")) & (F.col(vec) == F.col("_vector")), "left")
    component = F.coalesce("component_id", F.col(id_).cast("long"))
    return met.select(
        *[f"c{i}" for i in range(len(table.columns))],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col(id_).cast("long")).alias("kept"),
    )


def vector_components(table: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``embeddings``."""
    base = table.select("vec_id", "embedding", "label")
    return near_duplicates(base).select(F.col("c0").alias("vec_id"), "n_links", "component_id", "kept")
