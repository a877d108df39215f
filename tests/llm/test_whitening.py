"""Whitening against numpy's eigenvectors of an exact covariance."""

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tarnspark.llm import whitening


def brute(rows, k=4):
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = [[Fraction(n * x[j] - sums[j], n) for j in range(d)] for x in fit]
    v = np.array([[float(sum(r[a] * r[b] for r in y) / n) for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, x in kept:
        c = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
        for m in range(min(k, d)):
            if e[m] > 1e-12 * e[0]:
                out.append((i, m + 1, n, sum((n * x[j] - sums[j]) ** 2 for j in range(d)), float(c @ u[:, m] / math.sqrt(e[m])), float(e[m] / v.trace())))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def same(got, want):
    """Equal but for the sign of each component."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], abs(r[4]))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all(r[6] < 1e-4 for r in got) and np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    for m in {r[1] for r in got}:
        a, b = (np.array([r[4] for r in rows if r[1] == m]) for rows in (got, want))
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)


def test_factor_and_rotations():
    rng = np.random.default_rng(0)
    for d, r in ((1, 1), (2, 1), (5, 5), (9, 4), (32, 32)):
        b = rng.normal(size=(d, r)) * np.logspace(0, -3, r)
        a = b @ b.T
        order, l = whitening.pivoted_cholesky(a)
        assert np.allclose(l @ l.T, a[np.ix_(order, order)], atol=1e-12) and l.shape[1] == r and np.allclose(np.triu(l, 1), 0)
        values, unit = whitening.components(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:r], rtol=1e-9, atol=1e-14)
        assert np.allclose(unit.T @ unit, np.eye(r), atol=1e-10) and np.allclose(a @ unit, unit * values, atol=1e-12)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(6, 6)) * [9, 5, 3, 1, 0.5, 0.1]
    rows = [(i, [float(np.float32(c)) for c in mix @ rng.normal(size=6) + 400]) for i in range(60)]
    rows += [(i % 5, rows[3][1]) for i in range(40)] + [(None, rows[4][1])]
    got = whitening.whiten(frame(spark, rows).repartition(4).withColumns({"x": F.lit(1), "n": F.lit("y"), "component": F.lit(2)})).collect()
    same(got, brute(rows))


def test_odd_rows(spark):
    good = [(1, [0.1, -0.2, 0.5]), (2, [0.3, 0.1, -0.5]), (3, [-0.0, 0.7, 0.0])]
    odd = [(4, None), (5, []), (6, [1.0, None, 2.0]), (7, [1.0, float("nan"), 2.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0]), (10, [1.0, 2.0, 3.0, 4.0])]
    same(whitening.whiten(frame(spark, good + odd)).collect(), brute(good))  # three vectors: two components have variance


def test_no_variance_and_empty(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_are_exact_or_null():
    big = 1 << 52
    x = np.array([[0, 1], [5, -7], [big, 0], [-big, big]], dtype=np.int64)
    sums = [int(c) for c in x.sum(axis=0)]
    got = whitening.Centre(4, sums).deviations(x)
    want = [sum((4 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    assert got == [w if w < 1 << 63 else None for w in want]
    small = np.array([[1, 2], [3, -9]], dtype=np.int64)
    assert whitening.Centre(2, [4, -7]).deviations(small) == [(2 - 4) ** 2 + (4 + 7) ** 2, (6 - 4) ** 2 + (-18 + 7) ** 2]


def test_repeats_fit_once(spark):
    """A vector that most rows share weighs as one."""
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 5.0])]
    once, often = (whitening.whiten(frame(spark, r)).where("vec_id = 2").orderBy("component").collect() for r in (rows, rows + [(i, [1.0, 0.0]) for i in range(10, 500)]))
    assert [tuple(r) for r in once] == [tuple(r) for r in often] and once[0].n == 3
