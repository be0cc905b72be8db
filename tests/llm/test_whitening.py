"""Whitening against numpy's own eigenvectors, and its exact parts against plain algebra."""
from fractions import Fraction

import numpy as np
import pytest

from staffhouse.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, y string, vec string, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y", "z", "w") for i, v in rows], SCHEMA)


def brute(rows):
    """(id, x) of the rows that count, n, sums, eigenvalues of the covariance and eigenvectors, falling."""
    taken = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in taken), default=0)
    taken = [(i, np.floor(64 * np.pad(v, (0, dim - len(v)))).astype(np.int64) + 1_000_000) for i, v in taken]
    fit = np.unique([x for _, x in taken], axis=0)
    values, basis = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True).reshape(dim, dim))
    return taken, len(fit), fit.sum(axis=0), values[::-1], basis[:, ::-1]


def check(got, rows, count=16):
    taken, n, total, values, basis = brute(rows)
    k = min(count, int((values > 1e-9 * values[0]).sum()))
    got = sorted(got, key=lambda r: (r.vec_id, r.component))
    assert sorted((r.vec_id, r.component) for r in got) == sorted((i, c) for i, _ in taken for c in range(1, k + 1))
    sign = {}
    by_id = {}
    for i, x in taken:
        by_id.setdefault(i, x)
    for r in got:
        x = by_id[r.vec_id]
        assert r.n == n and r.deviation == int(((n * x - total) ** 2).sum())
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
        assert r.identity_error < 1e-9
        want = float((x - total / n) @ basis[:, r.component - 1] / np.sqrt(values[r.component - 1]))
        if abs(want) > 1e-6:
            sign.setdefault(r.component, np.sign(want * r.whitened))
        assert abs(r.whitened - sign.get(r.component, 1) * want) < 1e-6
    return got


@pytest.fixture(scope="module")
def odd():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(20) * np.linspace(1, 3, 20)).tolist()) for i in range(120)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (0, rows[0][1]), (300, None), (301, [1.0, None] + [0.0] * 18), (302, [float("nan")] * 20), (303, [float("inf")] + [0.0] * 19),
             (304, [0.0] * 20), (305, [1.0, 2.0]), (306, [])]
    return rows


def test_whitening_matches_numpy(spark, odd):
    check(W.whiten(vectors(spark, odd)).collect(), odd)
    small = [(i, [i % 7, i * i % 11, i % 3]) for i in range(40)]
    check(W.whiten(vectors(spark, small)).collect(), small)


def test_rank_below_the_components(spark):
    rows = [(i, [a, 2 * a, -a, b, b]) for i, (a, b) in enumerate([(1, 2), (3, 1), (0, 5), (2, 2), (7, 1)])]
    got = check(W.whiten(vectors(spark, rows)).collect(), rows)
    assert max(r.component for r in got) == 2


def test_equal_eigenvalues_get_an_orthonormal_basis(spark):
    rows = [(2 * i + s, [(1 - 2 * s) * (i == j) for j in range(4)]) for i in range(4) for s in range(2)]
    got = W.whiten(vectors(spark, rows)).collect()
    m = np.zeros((8, 4))
    for r in got:
        assert abs(r.explained - .25) < 1e-15 and r.identity_error < 1e-12
        m[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(m.T @ m / 8, np.eye(4), atol=1e-12)


def test_whitening_of_nothing(spark):
    assert W.whiten(vectors(spark, [])).count() == 0
    assert W.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert W.whiten(vectors(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0


def test_huge_entries_stay_exact(spark):
    rows = [(i, [x, y]) for i, (x, y) in enumerate([(1e15, 3), (-2e15, 4), (5e14, -9), (0, 0)])]
    got = W.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and all(r.deviation is None and r.identity_error < 1e-6 for r in got)
    assert W.whiten(vectors(spark, [(1, [1e30]), (2, [-1e30]), (3, [3e38])])).count() == 3


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-9, 9, (30, 7))
    x[:, 6] = x[:, 0]                                   # a root of zero
    m = [[int(v) for v in row] for row in x.T @ x]
    poly = W.characteristic_polynomial(spark, m)

    def det(a):                                         # exact, over fractions
        a, out = [[Fraction(v) for v in row] for row in a], Fraction(1)
        for k in range(len(a)):
            p = next((i for i in range(k, len(a)) if a[i][k]), None)
            if p is None:
                return Fraction(0)
            if p != k:
                a[k], a[p], out = a[p], a[k], -out
            out *= a[k][k]
            for i in range(k + 1, len(a)):
                f = a[i][k] / a[k][k]
                a[i] = [u - f * v for u, v in zip(a[i], a[k])]
        return out
    for t in range(-3, 6):
        assert sum(c * t ** i for i, c in enumerate(poly)) == det([[(t if i == j else 0) - m[i][j] for j in range(7)] for i in range(7)])
    want = np.linalg.eigvalsh(np.array(m, float))[::-1]
    assert W.roots_above(poly, 0) == 6
    got = W.largest_roots(poly, 16)
    assert [n for _, n in got] == [1] * 6
    assert np.allclose([r / 2 ** W.ROOT_BITS for r, _ in got], want[:6], rtol=1e-12)
    # (x - 3)^2 (x - 5) x
    assert W.largest_roots([0, -45, 39, -11, 1], 16) == [(5 << W.ROOT_BITS, 1), (3 << W.ROOT_BITS, 2)]
