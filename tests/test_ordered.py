"""Running sums over ranges and range lookups by bins, against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.analytics import concentration, with_running_share
from tessera.operators.ordered import range_lookup, running_sums


def test_running_sums_over_several_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # several ranges of a small table
    try:
        rows = [(k, (k * 7919) % 50, None if k % 9 == 0 else k % 13) for k in range(2000)]
        df = spark.createDataFrame(rows, "k int, o int, n int")
        got = running_sums(df, [F.col("o").desc(), F.col("k").asc()], {"run": "n"}, "place", {"total": "n"}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    run = np.cumsum([r[2] or 0 for r in ordered])
    assert sorted((r.place, r.k, r.o, r.n, r.run) for r in got) == [(i + 1, *r, int(run[i])) for i, r in enumerate(ordered)]
    assert {r.total for r in got} == {int(run[-1])}
    assert running_sums(df.limit(0), [F.col("k").asc()], {"run": "n"}, "place").collect() == []


def test_concentration_and_shares(spark):
    rows = [(None, 5), ("a", 5), ("b", 90), ("c", 0)]
    got = [tuple(r) for r in concentration(spark.createDataFrame(rows, "k string, n long"), "k", "n").orderBy("rang").collect()]
    assert got == [("b", 90, 1, 90.0, True), (None, 5, 2, 95.0, False), ("a", 5, 3, 100.0, False), ("c", 0, 4, 100.0, False)]
    # peers and a null share their place: a hot order value is one row of the running sum
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("o"), F.lit(1).alias("n"))
    got = {r.o: round(r.pct_cumul, 6) for r in with_running_share(df, "n", F.col("o")).distinct().collect()}
    assert got == {None: 33.333333, 1: 66.666667, 2: 100.0}


def test_no_window_over_all_rows(spark):
    counts = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("n"))
    plan = concentration(counts, "k", "n")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # rows are numbered within their range; what runs over all ranges has one row a range
    assert any("row_number" in w and "[__part" in w for w in windows)
    assert not any("row_number" in w and "[__part" not in w for w in windows)


def _plain(values, ranges):
    out = []
    for v in values:
        hit = [name for name, lo, hi in ranges
               if v is not None and v == v and (lo is None or v >= lo) and (hi is None or v < hi)]
        out += [(v, h) for h in hit] or [(v, None)]
    return sorted(map(repr, out))


def test_range_lookup_odd_ranges(spark):
    ranges = [("open", None, 3), ("wide", -1000, 10 ** 6), ("one", 5, 6), ("empty", 7, 7), ("turned", 9, 8), ("end", 40, None), ("all", None, None)]
    values = [None, -2000, -1000, 0, 2, 3, 5, 6, 7, 8, 9, 40, 40, 41, 10 ** 6, 2 ** 31 - 1]
    r = spark.createDataFrame(ranges, "name string, lo long, hi long")
    p = spark.createDataFrame([(v,) for v in values], "v long")
    assert sorted(repr((x.v, x.name)) for x in range_lookup(p, "v", r, "lo", "hi").collect()) == _plain(values, ranges)
    assert sorted(repr((x.v, x.name)) for x in range_lookup(p, "v", r.limit(0), "lo", "hi").collect()) == _plain(values, [])
    assert range_lookup(p.limit(0), "v", r, "lo", "hi").collect() == []
    real = [("a", 0.1, 0.30000000000000004), ("b", -1e-9, 1e-9), ("c", 1e300, None)]
    values = [0.1, 0.3, 0.30000000000000004, 0.0, 1e-9, 1e300, 2e300, float("nan"), -5.5]
    r = spark.createDataFrame(real, "name string, lo double, hi double")
    p = spark.createDataFrame([(v,) for v in values], "v double")
    assert sorted(repr((x.v, x.name)) for x in range_lookup(p, "v", r, "lo", "hi").collect()) == _plain(values, real)


def test_range_lookup_of_many_ranges(spark):
    # 100,000 ranges side by side, of widths from 1 to 1000, and a third of all rows with one value
    r = spark.range(100_000).select(F.col("id").alias("n"), (F.col("id") * 1000).alias("lo"), (F.col("id") * 1000 + 1 + F.col("id") % 1000).alias("hi"))
    p = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5000).otherwise((F.col("id") * 1_000_003) % 100_000_000).alias("v"))
    out = range_lookup(p, "v", r, "lo", "hi")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = out.select("v", "n").toPandas()
    v = got.v.to_numpy()
    n = v // 1000
    want = np.where(v - n * 1000 < 1 + n % 1000, n, -1)
    assert len(got) == 60_000 and (got.n.fillna(-1).to_numpy() == want).all()
