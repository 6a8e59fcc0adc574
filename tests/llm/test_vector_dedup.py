"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from mailgauge.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string, c0 int"


def usable(row):
    i, v, label = row[:3]
    return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = (np.array(x) / np.abs(x).max() for x in (a, b))
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def model(rows, least):
    near = [[] for _ in rows]
    for p, a in enumerate(rows):
        for q, b in enumerate(rows[:p]):
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= least:
                near[p].append(q)
                near[q].append(p)
    out = []
    for p, row in enumerate(rows):
        seen, todo = {p}, [p]
        while todo:
            todo += [q for q in near[todo.pop()] if q not in seen and not seen.add(q)]
        component = min(rows[q][0] for q in seen) if row[0] is not None else None
        out.append((row[0], len(near[p]), component, component == row[0]))
    return Counter(out)


def check(spark, rows, least=0.93, **options):
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA).repartition(3)
    out = vector_dedup.near_duplicates(frame, least, **options).select("c0", "n_links", "component_id", "kept")
    assert Counter(map(tuple, out.collect())) == model(rows, least)


def clustered(n, dimension, seed, labels=3):
    """Vectors around few centres at distances that put cosines on both sides of the threshold, and copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dimension))
    rows = []
    for i in range(n):
        spread = rng.choice([0.0, 0.15, 0.3, 0.5])
        v = centres[rng.integers(6)] * rng.choice([0.5, 1, 100]) + spread * rng.normal(size=dimension)
        rows.append((int(rng.integers(10**6)), v.tolist(), int(rng.integers(labels))))
    return rows + [(r[0] + 10**7, r[1], r[2]) for r in rows[: n // 5]]


@pytest.mark.parametrize("dimension", [1, 2, 5, 24])
def test_against_all_pairs(spark, dimension):
    check(spark, clustered(150, dimension, dimension))


@pytest.mark.parametrize(("deal", "largest"), [(1, 1 << 16), (256, 7), (4, 30)])
def test_many_tiles(spark, deal, largest):
    check(spark, clustered(120, 8, 3, labels=1), deal=deal, largest=largest)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, [-1.0, -2.0, -3.0], 1), (4, v, 2), (5, v, None),
        (None, v, 1), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, nan, 3.0], 1), (10, [inf, 2.0, 3.0], 1),
        (11, [1.0, None, 3.0], 1), (12, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (14, [1e300, 2e300, 3e300], 1),
        (15, [1e-300, 2e-300, 3e-300], 1), (None, None, None), (16, [-0.0, 1.0, 0.0], 3), (17, [0.0, 1.0, 0.0], 3),
        (20, [1.0, 0.0, 0.0], 4), (20, [0.0, 1.0, 0.0], 4), (21, [1.0, 0.01, 0.0], 4),  # an id that is repeated
    ]
    check(spark, rows)
    check(spark, [])
    check(spark, [(None, None, None), (1, [0.0], 1)])


def test_threshold_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [3.0, 4.0], 1), (3, [0.0, 1.0], 1)]
    assert model(rows, 0.6)[(1, 1, 1, True)] == 1
    check(spark, rows, 0.6)
    check(spark, rows, 0.6000001)


def test_a_hot_group_of_copies_is_one_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0 + (i % 2) * 1e-3], 1) for i in range(400)] + [(1000 + i, [float(i), 1.0, 0.0], 2) for i in range(50)]
    check(spark, rows)


def test_axes_are_those_of_the_greatest_spread(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 6)) * [1, 5, 2, 9, 0.1, 3]
    frame = spark.createDataFrame([(v.tolist(),) for v in vectors], "vector array<double>")
    axes = vector_dedup.principal_axes(frame)[6]
    assert np.allclose(axes.T @ axes, np.eye(6))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    spread = ((unit @ axes) ** 2).sum(axis=0)
    assert (np.diff(spread) <= 1e-9).all() and np.abs(axes[:, 0]).argmax() == 3
