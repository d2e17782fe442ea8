"""Heavy keys from a sketch: exact while small, bounded and complete above its size, same rows whatever is split."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import groups
from tessera.operators.groups import SaltPlan, attach_group_stats, frequent_keys


def test_small_tables_are_counted_exactly(spark):
    rows = [("a", 1)] * 50 + [("b", 1)] * 7 + [(None, 1)] * 20 + [("", 1)] * 3
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    assert frequent_keys(df, "k") == [("a", 50), (None, 20), ("b", 7), ("", 3)]
    assert frequent_keys(df, "k", most=2) == [("a", 50), (None, 20)]
    assert frequent_keys(df.limit(0), "k") == []
    nulls = df.where("k is null")
    assert frequent_keys(nulls, "k") == [(None, 20)]
    heavy = {r["k"]: r["__buckets"] for r in SaltPlan.for_fact(df, ["k"], rows_per_task=10).heavy.collect()}
    assert heavy == {"a": 5, None: 2}


def test_hot_keys_among_many(spark):
    """300,000 keys of one row each around three hot ones: the hot ones are found, the list stays bounded."""
    n = 600_000
    hot = F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 10 == 1, -2).when(F.col("id") % 20 == 3, -3)
    df = spark.range(n, numPartitions=8).select(F.coalesce(hot, F.col("id")).cast("long").alias("k"), F.col("id").alias("v"))
    found = dict(frequent_keys(df, "k"))
    exact = {r.k: r["count"] for r in df.where("k < 0").groupBy("k").count().collect()}
    assert len(found) <= groups.MAX_HEAVY
    assert all(abs(found[k] - exact[k]) <= n / groups.MAX_HEAVY for k in (-1, -2, -3))
    heavy = SaltPlan.for_fact(df, ["k"], rows_per_task=20_000).heavy
    assert {r.k for r in heavy.collect()} == {-1, -2, -3}


@pytest.mark.parametrize("rows_per_task", [1, 1000, 10**9])
def test_group_stats_do_not_depend_on_what_is_split(spark, rows_per_task):
    df = spark.range(5000, numPartitions=4).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("k"))
    got = attach_group_stats(df, ["k"], {"n": F.count(F.lit(1)), "s": F.sum("id")}, salt_from=["id"], rows_per_task=rows_per_task)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
    plain = df.join(want.withColumnRenamed("k", "_k"), df["k"].eqNullSafe(F.col("_k"))).drop("_k")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(((r.id, r.k, r.n, r.s) for r in plain.collect()))


def test_no_exchange_on_the_key_to_find_heavy_ones(spark):
    df = spark.range(1000, numPartitions=4).select("id", (F.col("id") % 10).alias("k"))
    got = attach_group_stats(df, ["k"], {"n": F.count(F.lit(1))}, salt_from=["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1          # the window's own; none to count keys
    assert "BroadcastHashJoin" not in plan                        # no key is heavy: nothing to look up


def test_the_list_from_counts_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(groups, "MAX_HEAVY", 3)
    counts = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 10).alias("n"))
    plan = SaltPlan.from_counts(counts, ["k"], "n", rows_per_task=10)
    assert {r.k for r in plan.heavy.collect()} == {17, 18, 19}
