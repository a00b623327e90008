"""Near vectors against brute force, and the bound of the quantised products."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import embedding_dedup as D

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, kept int"


def usable(v, label):
    return label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.98):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            (_, v, p), (_, w, q) = rows[a], rows[b]
            if usable(v, p) and usable(w, q) and p == q and len(v) == len(w):
                v_, w_ = np.array(v, float), np.array(w, float)
                if v_ @ w_ / (np.linalg.norm(v_) * np.linalg.norm(w_)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for a in range(n):
        if rows[a][0] is not None:
            least[find(a)] = min(least.get(find(a), rows[a][0]), rows[a][0])
    return sorted(((rows[a][0] is None, rows[a][0] or 0, links[a], least.get(find(a))) for a in range(n)), key=str)


def run(spark, rows):
    out = D.near_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("tile, cells", [(1024, 5), (4, 2), (8, 3)])
def test_against_brute_force(spark, monkeypatch, tile, cells):
    monkeypatch.setattr(D, "TILE", tile)
    monkeypatch.setattr(D, "CELLS", cells)
    rng = np.random.default_rng(1)
    rows, centre = [], rng.standard_normal((6, 16))
    for i in range(90):
        v = centre[i % 6] + (0.12 if i % 3 else 1.0) * rng.standard_normal(16)
        rows.append((1000 - i, v.astype(np.float32).tolist(), i % 2))
    rows += [(2000 + i, rows[0][1], 0) for i in range(5)]  # copies
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    v = [1.0, 0.0, 0.5]
    rows = [(1, v, 1), (2, v, 2), (3, v, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.5], 1), (7, [float("nan"), 0.0, 0.5], 1),
            (8, [float("inf"), 0.0, 0.5], 1), (9, [], 1), (10, [2.0, 0.0, 1.0], 1), (10, [2.0, 0.0, 1.0], 1), (None, v, 1), (12, [1e38, 0.0, 5e37], 1),
            (13, [1e-38, 0.0, 5e-39], 1), (14, [1.0, 0.0], 1), (15, [-1.0, 0.0, -0.5], 1), (16, v, None), (16, v, None)]
    assert run(spark, rows) == brute(rows)
    assert D.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 300), st.floats(1e-6, 10))
def test_bounds_are_rigorous(seed, dimension, spread):
    rng = np.random.default_rng(seed)
    units = D.unit(rng.standard_normal((12, dimension)) ** 3 * spread + rng.standard_normal(dimension))
    parts = D.quantise(units)
    assert (D.upper_bounds(parts, parts) >= units @ units.T).all()


def test_directions_never_separate_a_pair():
    u = D.directions(64)
    assert np.allclose(u.T @ u, np.eye(u.shape[1]))
