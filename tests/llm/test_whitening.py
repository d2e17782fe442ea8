"""Whitening against plain numpy, and exactness against Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.whitening import covariance, deviations, square_sums, whiten


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"v": F.lit(1), "w": F.lit("x"), "n": F.lit(0)})


def plain(vectors, components):
    x = np.floor(1024 * vectors.astype(np.float64)) + 100_000
    v = np.cov(x.T, bias=True).reshape(vectors.shape[1], -1)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    n, s = len(x), x.sum(0)
    dev = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, s)) for row in x]
    return dev, ((x - s / n) @ u[:, :components]) / np.sqrt(e[:components]), e[:components] / np.trace(v)


def collect(df):
    return sorted(((r.vec_id if r.vec_id is not None else -1, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in df.collect()))


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(0.1, 1, 12) + rng.normal(size=12)).astype(np.float32)
    bad = [(900, None, 0), (901, [float("nan")] + [0.0] * 11, 0), (902, [None] + [0.0] * 11, 0), (903, [float("inf")] * 12, 0), (904, [1e30] * 12, 0)]
    rows = [(k, [float(x) for x in row], 0) for k, row in enumerate(vectors)]
    got = collect(whiten(table(spark, rows + bad).repartition(4)))
    dev, white, share = plain(vectors, 8)
    assert [g[:2] for g in got] == [(k, c) for k in range(300) for c in range(1, 9)]
    assert [g[3] for g in got[::8]] == dev
    mine = np.array([g[4] for g in got]).reshape(300, 8)
    signs = np.sign((mine * white).sum(0))
    np.testing.assert_allclose(mine * signs, white, rtol=1e-7, atol=1e-9)
    np.testing.assert_allclose([g[5] for g in got[:8]], share, rtol=1e-9)
    assert {g[2] for g in got} == {300} and got[0][6] < 1e-9 and len({g[6] for g in got}) == 1


def test_square_sums_are_exact_at_any_size():
    rng = np.random.default_rng(0)
    for width in (9, 33, 40):
        z = rng.integers(-(1 << width), 1 << width, (40, 5))
        q = square_sums(z)
        for d in range(5):
            for e in range(d, 5):
                want = sum(int(r[d]) ** 2 if d == e else (int(r[d]) + int(r[e])) ** 2 for r in z)
                assert q[d, e] == want
        n, s = len(z), [int(x) for x in z.sum(0)]
        product = sum(int(r[1]) * int(r[3]) for r in z)
        assert covariance(q, n, s)[1, 3] == (n * product - s[1] * s[3]) / (n * n)
        want = [sum((n * int(x) - t) ** 2 for x, t in zip(row, s)) for row in z]
        assert deviations(z, n, s) == [w if w < 1 << 63 else None for w in want]


def test_odd_tables(spark):
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, None, 0)])).collect() == []
    assert whiten(table(spark, [(1, [0.5, 0.25], 0)])).collect() == []                    # no variance
    # repeated and null ids, a shorter vector (missing entries are 0), one dimension without variance
    got = collect(whiten(table(spark, [(1, [0.5, 0.25, 0.5], 0), (1, [0.5, 0.25, 0.5], 0), (None, [-0.5], 0), (4, [0.0, 1.0, 0.0], 0)])))
    assert [g[:3] for g in got] == [(-1, 1, 4), (-1, 2, 4), (1, 1, 4), (1, 1, 4), (1, 2, 4), (1, 2, 4), (4, 1, 4), (4, 2, 4)]
    assert math.isclose(sum(g[5] for g in got[:2]), 1.0) and got[0][6] < 1e-9
    same = collect(whiten(table(spark, [(k, [0.25, k / 4], 0) for k in range(5)])))
    assert {g[1] for g in same} == {1} and sum(g[4] for g in same) == pytest.approx(0, abs=1e-9)


def test_hot_vector(spark):
    rng = np.random.default_rng(1)
    vectors = np.concatenate([np.tile(rng.normal(size=6), (400, 1)), rng.normal(size=(200, 6))]).astype(np.float32)
    got = collect(whiten(table(spark, [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]).repartition(5)))
    dev, _, share = plain(vectors, 6)
    assert [g[3] for g in got[::6]] == dev
    np.testing.assert_allclose([g[5] for g in got[:6]], share, rtol=1e-9)
