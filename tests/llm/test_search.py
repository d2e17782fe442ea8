"""Vector searches against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import neighbours, topk
from tessera.llm.common import table


def brute(rows, score, is_query, k=5):
    out = []
    for q, v in sorted(rows.items()):
        if is_query(q):
            near = sorted(((-score(v, w), i) for i, w in rows.items() if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def result(df):
    return sorted(tuple(r) for r in df.collect())


def products(a, b):
    n = min(len(a), len(b))
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a[:n], b[:n], strict=True))


def cosine(a, b):
    n = min(len(a), len(b))
    return float(np.dot(a[:n], b[:n]) / np.sqrt(np.dot(a, a)) / np.sqrt(np.dot(b, b)))


def odd_vectors():
    rng = np.random.default_rng(4)
    good = {k: rng.normal(size=6).tolist() for k in range(30)}
    good[3] = good[7] = good[9] = good[0]                 # ties
    good[12] = [1.0, 2.0]                                 # shorter
    good[13] = [-x for x in good[10]]
    bad = [(40, None), (50, [None] * 6), (60, [1.0, float("nan")]), (70, [float("inf"), 1.0]), (None, [1.0] * 6), (80, [])]
    rows = [*good.items(), *bad]
    return good, rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, v string")


def test_top_products(spark, sf_small):
    vectors = table(spark, sf_small, "embeddings")
    rows = {r.vec_id: r.embedding for r in vectors.collect()}
    got = topk.top_products(vectors, F.col("vec_id") % 50 == 0, group_rows=128)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert result(got) == brute(rows, products, lambda q: q % 50 == 0)


def test_top_products_odd_rows(spark):
    good, rows = odd_vectors()
    zero = {90: [0.0] * 6}
    got = topk.top_products(frame(spark, [*rows, *zero.items()]), F.col("vec_id") % 10 == 0, group_rows=7)
    assert result(got) == brute(good | zero, products, lambda q: q % 10 == 0)
    assert topk.top_products(frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.top_products(frame(spark, [(0, [1.0]), (1, [2.0])]), F.col("vec_id") == 0).collect()[0][1:] == (1, 1, 256 * 512)


def test_blocks_are_pruned_and_exact_beyond_doubles():
    rng = np.random.default_rng(8)
    ids = np.arange(2000)
    weights = np.floor(rng.normal(size=(2000, 8)) * 10).astype(np.int64)
    weights[640:704] += 300                               # one block far above the others
    queries = np.abs(weights[:5]) + 1
    q, v, s, scored = topk.search_blocks(ids, weights, np.arange(-5, 0), queries, 5)
    want = np.sort(queries @ weights.T, axis=1)[:, ::-1][:, :5]
    assert (s.reshape(5, 5) == want).all() and scored < 5 * 32 / 2
    large = np.full((3, 4), 2 ** 26) - np.arange(3)[:, None]
    _, v, s, _ = topk.search_blocks(np.arange(3), large, np.array([9]), large[:1], 3)
    assert v.tolist() == [0, 1, 2] and s.tolist() == [int(x) for x in (large[0].astype(object) @ large.T.astype(object))]


def shared_ids():
    """Rows that share ids, of candidates and of queries: (id, vector)."""
    rng = np.random.default_rng(6)
    rows = [(k % 9, rng.normal(size=6).tolist()) for k in range(24)]
    return [*rows, rows[5], rows[5], rows[0]]


def brute_rows(rows, score, is_query, k=5):
    out = []
    for a, (q, v) in enumerate(rows):
        if is_query(q):
            near = sorted((-score(v, w), i) for b, (i, w) in enumerate(rows) if b != a)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def test_rows_that_share_an_id_all_take_part(spark):
    rows = shared_ids()
    got = topk.top_products(frame(spark, rows), F.col("vec_id") % 4 == 0, group_rows=5)
    assert result(got) == brute_rows(rows, products, lambda q: q % 4 == 0)
    one = topk.top_products(frame(spark, [(50, [1.0]), (1, [2.0]), (1, [3.0])]), F.col("vec_id") == 50)
    assert [tuple(r) for r in one.orderBy("rank").collect()] == [(50, 1, 1, 256 * 768), (50, 2, 1, 256 * 512)]
    arrays = [(i, np.array(v)) for i, v in rows]
    got = result(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 4 == 0, probes=16, tables=2, group_rows=4))
    want = brute_rows(arrays, cosine, lambda q: q % 4 == 0)
    assert [(g[0], g[1], round(g[3], 9)) for g in got if g[0] != 0] == [(w[0], w[1], round(w[3], 9)) for w in want if w[0] != 0]
    assert sorted((g[0], g[1], round(g[3], 9)) for g in got) == sorted((w[0], w[1], round(w[3], 9)) for w in want)


def test_large_values_are_not_held(spark):
    rows = [(0, [1.0]), (1, [1e6]), (2, [3e5]), (3, [2e6]), (4, [-1e6])]
    got = topk.top_products(frame(spark, rows), F.col("vec_id") == 0)
    assert [r.vec_id for r in got.orderBy("rank").collect()] == [3, 1, 2, 4]
    # sums whose parts pass a long and cancel, and scores beyond a long
    rows = [(0, [1e12, 1e12]), (1, [1e12, -1e12 + 1]), (2, [1e12, -1e12]), (3, [1e300, 1e300]), (4, [-1e308, 0.0])]
    got = [(r.vec_id, r.score) for r in topk.top_products(frame(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(3, 2 ** 63 - 1), (1, 256 * 256 * 10 ** 12), (2, 0), (4, -(2 ** 63) + 1)]


def test_small_tables_are_complete_with_production_parameters(spark):
    rng = np.random.default_rng(12)
    for n in (2, 6, 10):
        rows = [(i, rng.normal(size=64).tolist()) for i in range(n)]
        got = result(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 3 == 0))
        want = brute({i: np.array(v) for i, v in rows}, cosine, lambda q: q % 3 == 0)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        if n <= 6:                                        # all candidates are wanted
            assert [g[:3] for g in got] == [w[:3] for w in want]


def test_nearest_recall_and_scores(spark, sf_small):
    vectors = table(spark, sf_small, "embeddings")
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in vectors.collect()}
    got = result(neighbours.nearest(vectors, F.col("vec_id") % 50 == 0))
    want = brute(rows, cosine, lambda q: q % 50 == 0)
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    found = len({(g[0], g[2]) for g in got} & {(w[0], w[2]) for w in want})
    assert found >= 0.9 * len(want)
    assert all(abs(g[3] - cosine(rows[g[0]], rows[g[2]])) < 1e-12 for g in got)


def test_nearest_odd_rows(spark):
    good, rows = odd_vectors()
    # all axes probed: every candidate is found, so the result is exact
    got = neighbours.nearest(frame(spark, [*rows, (90, [0.0] * 6)]), F.col("vec_id") % 10 == 0, probes=16, tables=2, group_rows=4)
    want = brute({k: np.array(v) for k, v in good.items()}, cosine, lambda q: q % 10 == 0)
    # equal vectors have equal scores, ranked by id
    assert [(g[0], g[1], g[2]) for g in result(got)] == [(w[0], w[1], w[2]) for w in sorted(
        (q, r, i) + (s,) for q, r, i, s in retied(want, good))]
    assert neighbours.nearest(frame(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0


def retied(want, good):
    """Brute-force rows with scores of equal vectors made equal."""
    by_query = {}
    for q in {w[0] for w in want}:
        a = np.array(good[q])
        scores = []
        for i, v in good.items():
            if i != q:
                b = np.zeros(6)
                b[:len(v)] = v
                scores.append((-float(neighbours.cosines(a[None], b[None])[0]), i))
        by_query[q] = sorted(scores)[:5]
    return [(q, r + 1, i, -s) for q, rows in by_query.items() for r, (s, i) in enumerate(rows)]


def test_rotation_keeps_lengths_and_angles():
    v = np.random.default_rng(2).normal(size=(20, 50))
    x = neighbours.rotated(v, 3)
    assert np.allclose(x @ x.T, v @ v.T)
    axes = neighbours.nearest_axes(v, 3, 4)
    assert (np.take_along_axis(np.stack([x, -x], 2).reshape(20, -1), axes, 1)[:, 0] == np.abs(x).max(1)).all()
