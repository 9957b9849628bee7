"""Eigenvectors against numpy, whitened rows against plain definitions."""

import math
import random

import numpy as np
import pytest

from spendcast.llm import tridiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, deviation string, place string, key string, vector string"


def matrices():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 8, 40):
        a = rng.normal(size=(n, n))
        yield a @ a.T
        yield np.diag(rng.integers(0, 3, n).astype(float))
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    for values in ([5.0] * 10 + [1.0] * 20, [1e9, 1e9, 1.0] + [1e-9] * 27, [2.0] * 30, list(1 + 1e-9 * np.arange(30))):
        yield q @ np.diag(values) @ q.T
    yield np.ones((20, 20))
    yield np.zeros((4, 4))
    yield np.diag([0.0, 3.0, 0.0, 3.0, 3.0])


@pytest.mark.parametrize("matrix", list(matrices()))
def test_leading_eigenpairs(matrix):
    matrix = (matrix + matrix.T) / 2
    k = min(8, len(matrix))
    values, vectors = tridiagonal.leading_eigenpairs(matrix, k)
    size = max(np.abs(matrix).max(), 1e-300) * len(matrix)
    assert np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size


def test_sturm_counts():
    rng = np.random.default_rng(3)
    d, e = rng.normal(size=12), rng.normal(size=11)
    e[4] = 0
    exact = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = rng.normal(size=50) * 2
    assert tridiagonal.below(d, e, points).tolist() == [(exact < p).sum() for p in points]


def rows():
    rng = random.Random(5)
    mix = np.random.default_rng(1).normal(size=(6, 6))
    vectors = [(mix @ [rng.gauss(0, 1) for _ in range(6)]).tolist() for _ in range(150)]
    found = [(i, v) for i, v in enumerate(vectors)]
    found += [(3, vectors[3]), (None, vectors[4]), *[(500 + i, vectors[0]) for i in range(70)]]
    found += [(900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5), (904, []), (905, [1.0, 2.0]), (906, [0.0] * 6)]
    return [(i, v, 1, *["x"] * 6) for i, v in found]


def test_whitening_equals_its_definition(spark):
    table = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    model = whitening.fit(table, components=4)
    got = whitening.project(table, model).collect()
    part = [(r[0], [float(np.float32(c)) for c in r[1]]) for r in rows() if r[1] and len(r[1]) == 6 and all(c is not None and math.isfinite(c) for c in r[1])]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in part]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array(x) - np.array(sums) / n
    covariance = centred.T @ centred / n
    values, vectors = (a[..., ::-1] for a in np.linalg.eigh(covariance))
    assert len(got) == 4 * n
    wanted = sorted((str(i), k + 1, sum((n * c - s) ** 2 for c, s in zip(v, sums)), abs(centred[j] @ vectors[:, k]) / math.sqrt(values[k])) for j, ((i, _), v) in enumerate(zip(part, x)) for k in range(4))
    for r, w in zip(sorted((str(r.vec_id), r.component, r.deviation, abs(r.whitened)) for r in got), wanted):
        assert r[:3] == w[:3] and r[3] == pytest.approx(w[3], abs=1e-9)
    for r in got:
        assert r.n == n and r.identity_error < 1e-10 and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-10)


def test_whitening_of_degenerate_tables(spark):
    def whitened(found, components=8):
        table = spark.createDataFrame([(i, v, 1, *["x"] * 6) for i, v in found], SCHEMA.replace("float", "double"))
        return whitening.project(table, whitening.fit(table, components=components)).collect()

    assert whitened([]) == [] and whitened([(1, None), (2, [])]) == []
    assert whitened([(1, [1.0, 2.0])] * 3) == []  # no variance
    flat = whitened([(i, [float(i), 7.0, 0.0]) for i in range(5)])
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)
    assert sorted(r.whitened for r in flat)[2] == pytest.approx(0)
    huge = whitened([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])])
    assert {r.deviation for r in huge} == {None, (3 * 103072 - 306144) ** 2} and all(math.isfinite(r.whitened) for r in huge)
    large = whitened([(i, [2.0**30 * i, 1.0 * i]) for i in range(4)])
    x = [[1024 * 2**30 * i + 100000, 1024 * i + 100000] for i in range(4)]
    exact = {i: sum((4 * a - sum(c)) ** 2 for a, c in zip(x[i], zip(*x))) for i in range(4)}
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None) for r in large)
