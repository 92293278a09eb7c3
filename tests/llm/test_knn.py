import math
import random

import numpy as np
import pytest
from lakegauge.llm import voronoi_knn as vk
from pyspark.sql import functions as F


def brute(rows, every, k):
    """By all pairs, in Python's integers."""
    whole = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in whole:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def found(spark, rows, every=5, k=3, kind="float", **options):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"score": F.lit("x"), "rank": F.lit("y")})
    return sorted(tuple(r) for r in vk.top_k(table.repartition(3), every, k, **options).collect())


def clustered(seed, n=600, width=6, clusters=8, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    rows = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, width))
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"group_queries": 7, "slice_rows": 50}, {"group_queries": 30, "pivots": 3}, {"pivots": 1}])
def test_all_pairs(spark, options):
    rows = clustered(1)
    assert found(spark, rows, **options) == brute(rows, 5, 3)


def test_bounds_leave_rows_out(spark):
    rows = np.array([v for _, v in clustered(2, 2000)])
    ints = np.floor(1024 * rows).astype(np.int64)
    pivots = vk.choose_pivots(ints[:500], 8)
    cell, far = vk.nearest(ints, pivots)
    norm = np.sqrt((ints.astype(float) ** 2).sum(axis=1))
    radius, reach = np.full(8, -1.0), np.zeros((2, 8))
    np.maximum.at(radius, cell[::50], far[::50]), np.maximum.at(reach[0], cell, norm), np.maximum.at(reach[1], cell, far)
    bounds = vk.Bounds(pivots, radius, reach)
    scores = ints[::50] @ ints.T
    low, high = bounds.range(ints, cell[::50])
    assert (low <= scores).all() and (scores <= high).all()
    bounds.least[bounds.cells] = np.sort(bounds.range(ints, bounds.cells)[0], axis=1)[:, -4]
    bounds.settle()
    # every row among the best three of a query is copied, and most others are not
    needed = (bounds.range(ints, bounds.cells)[1] >= bounds.least[bounds.cells][:, None]) & bounds.open[bounds.cells][:, cell]
    place = {c: i for i, c in enumerate(bounds.cells)}
    for q, s in enumerate(scores):
        best = np.lexsort((np.arange(len(s)), -s))
        assert needed[place[cell[50 * q]], best[best != 50 * q][:3]].all()
    assert needed.mean() < 0.5 and not bounds.open.all()


def test_copies_ties_and_hot_cells(spark):
    rng = random.Random(3)
    rows = [(i, [0.5, -0.25, 1.0]) for i in range(200)] + [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(200, 300)]
    for options in ({}, {"group_queries": 4, "slice_rows": 20}):
        assert found(spark, rows, every=10, k=7, **options) == brute(rows, 10, 7)


def test_nulls_lengths_and_numbers_that_are_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, None), (None, [1.0, 1.0]), (10, [nan, 1.0]), (15, [1.0, inf]), (20, [None, 1.0]), (25, []), (30, [1.0, 2.0, 3.0]), (-5, [-1.0]), (-7, [0.3]), (3, [-0.0001, 2.0]), (4, [1.0, 2.0, 0.5])]
    got = found(spark, rows, k=4)
    assert got == brute(rows, 5, 4)
    assert {r[0] for r in got} == {0, 25, 30, -5}


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.25, 1.0])]
    assert found(spark, rows, k=3) == brute(rows, 5, 3)


def test_few_and_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert found(spark, [(5, None), (10, [None])]) == []
    rows = [(i, [float(i)]) for i in range(3)]
    assert found(spark, rows, k=10) == brute(rows, 5, 10)


def test_scores_beyond_the_exact_doubles(spark):
    rows = [(i, [2.0**20 + i, 2.0**20 - 3 * i + 0.5]) for i in range(20)]
    assert found(spark, rows, kind="double") == brute(rows, 5, 3)
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(5, [1e9, 1e9]), (6, [1e9, 1e9])], kind="double")
