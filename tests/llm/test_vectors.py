import math

import numpy as np
import pytest

from wikicells.llm import nearest, vectors, voronoi
from wikicells.llm.nearest import bounds, distances
from wikicells.llm.nearest import nearest as search
from wikicells.llm.voronoi import top_products

NAN, INF = float("nan"), float("inf")
ODD = [
    (None, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (200, None), (300, []), (400, [0.0, 0.0]), (1, [0.0, 0.0]),
    (500, [1.0, None]), (600, [NAN, 1.0]), (700, [INF, 1.0]), (800, [1.0, 2.0, 3.0]), (3, [1.5, 2.0, 3.0]), (4, [-1.0, 2.5]), (5, [1e6, 1.0]), (6, [1.0, 2.0]),
    (900, [5.0]),
]


def table(spark, rows):
    rows = [(i, v, 0, 1, 2) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, rank int, block int").repartition(3)


def brute(rows, every, k, score, largest, usable):
    rows = [(n, i, np.float32(v).astype(float)) for n, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and usable(v)]
    out = []
    for n, i, q in rows:
        if i is not None and i % every == 0:
            found = [(score(q, x), j) for m, j, x in rows if m != n and len(x) == len(q)]
            found.sort(key=lambda f: (-f[0] if largest else f[0], f[1] is None, f[1] or 0))
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def random_rows(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    x = centres[rng.integers(0, 7, n)] + 0.3 * rng.normal(size=(n, dims)) * rng.random((n, 1))
    x[n // 2 : n // 2 + n // 4] = x[0]  # one very common vector
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("rows", [ODD, random_rows(400, 12, 1)], ids=["odd", "random"])
def test_nearest(spark, monkeypatch, rows):
    monkeypatch.setattr(nearest, "ROWS", 64)
    monkeypatch.setattr(nearest, "QUERIES", 3)
    euclid = lambda q, x: float(distances(q, x[None])[0])
    expected = brute(rows, 20, 10, euclid, False, any)
    assert sorted(map(tuple, search(table(spark, rows), 10, 20).collect()), key=str) == expected and expected
    assert search(table(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("rows", [ODD, random_rows(400, 12, 2)], ids=["odd", "random"])
def test_top_products(spark, monkeypatch, rows):
    monkeypatch.setattr(voronoi, "ROWS", 64)
    monkeypatch.setattr(voronoi, "QUERIES", 3)
    product = lambda q, x: int(np.floor(64 * q) @ np.floor(64 * x))
    expected = brute(rows, 20, 20, product, True, lambda v: True)
    assert sorted(map(tuple, top_products(table(spark, rows), pivots=6).collect()), key=str) == expected and expected
    assert top_products(table(spark, rows).limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for scale in (1e-6, 1, 1e6):
        x, y = scale * rng.normal(size=(30, 64)), scale * rng.normal(size=(40, 64))
        y[:5] = x[:5]
        low, high = bounds(x, y)
        true = np.array([distances(q, y) for q in x])
        assert (low <= true).all() and (true <= high).all() and (high - low).max() < 0.2 * true.max()


def test_cells_that_cannot_win_are_left_out():
    pivots = np.array([[10.0, 0.0], [-10.0, 0.0], [9.0, 1.0]])
    assert voronoi.needed([(0, 1, 1.0)], [(0, 50, 1.0), (1, 50, 1.0), (2, 50, 1.0)], pivots, 20) == [(0, 0), (0, 2)]


def test_smallest():
    score, ids = np.array([3.0, 1.0, 1.0, 2.0, 1.0]), np.array([1, 9, 2, 3, 5])
    assert vectors.smallest(np.arange(5), score, ids, 2).tolist() == [2, 4]
