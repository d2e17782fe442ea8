"""Operators: cascades, star join, skew-safe groups, dedup, top-k, checks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.analytics import concentration, distinct_list, top_k_per_group, with_running_share
from tessera.operators.cascade import Cascade, FlagSet, Rule
from tessera.operators.groups import SaltPlan, attach_group_stats, duplicate_keys, first_per_key
from tessera.operators.projection import drop_null_columns, left_join_keep_left, select_tolerant
from tessera.operators.quality import bounds_check, distribution_check, group_consistency_check, unique_key_check
from tessera.rules import bands
from tessera.operators.star import DimRef, bounded, star_join, unmatched_keys


def test_cascade_first_match_and_sql(spark):
    c = Cascade("lab", (Rule("x >= 10", "big"), Rule("x >= 5", "mid")), "small")
    df = spark.createDataFrame([(12,), (7,), (1,), (None,)], "x int")
    assert [r.lab for r in df.select(c.column()).collect()] == ["big", "mid", "small", "small"]
    assert c.sql() == "CASE WHEN x >= 10 THEN 'big' WHEN x >= 5 THEN 'mid' ELSE 'small' END AS lab"


def test_flags_exclusive_vs_overlapping(spark):
    rules = (("a", "x >= 5"), ("b", "x >= 3"))
    df = spark.createDataFrame([(6,), (4,), (None,)], "x int")
    over = [(r.a, r.b) for r in FlagSet(rules).apply(df).collect()]
    excl = [(r.a, r.b) for r in FlagSet(rules, exclusive=True).apply(df).collect()]
    assert over == [(True, True), (False, True), (False, False)]
    assert excl == [(True, False), (False, True), (False, False)]


def test_star_join_roles_and_unmatched(spark):
    fact = spark.createDataFrame([(1, "a", "b"), (2, "b", "z"), (3, None, "a")], "id int, k1 string, k2 string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, lab string")
    out = star_join(fact, [DimRef("r1", dim, {"k1": "k"}, {"lab": "lab1"}),
                           DimRef("r2", dim, {"k2": "k"}, {"lab": "lab2"})])
    got = sorted((r.id, r.lab1, r.lab2) for r in out.collect())
    assert got == [(1, "A", "B"), (2, "B", None), (3, None, "A")]
    inner = star_join(fact, [DimRef("r", dim, {"k2": "k"}, {"lab": "lab"}, "inner", checked=True)])
    assert sorted(r.id for r in inner.collect()) == [1, 3]
    miss = {r.k2: r.nb_lignes for r in unmatched_keys(fact, "k2", dim, "k").collect()}
    assert miss == {"z": 1}


def test_bounded_broadcast(spark):
    small = spark.range(5)
    assert "broadcast" in bounded(small, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in bounded(small, 3)._jdf.queryExecution().analyzed().toString().lower()


def test_group_stats_hot_key_and_null_key(spark):
    # one hot key with most rows, a null key, light keys; tiny threshold splits the hot key
    rows = [(i, "hot" if i < 900 else (None if i < 920 else f"k{i % 7}"), float(i % 13)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    salted = attach_group_stats(df, ["k"], {"m": F.sum("v"), "n": F.count(F.lit(1))}, salt_from=["id"],
                                rows_per_task=50)
    win = df.withColumn("m", F.sum("v").over(Window.partitionBy("k"))).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    a = sorted(((r.id, r.m, r.n) for r in salted.collect()), key=lambda t: t[0])
    b = sorted(((r.id, r.m, r.n) for r in win.collect()), key=lambda t: t[0])
    assert a == b
    plan = SaltPlan.for_fact(df, ["k"], rows_per_task=50)
    assert {r["k"]: r["__buckets"] for r in plan.heavy.collect()} == {"hot": 18}


def test_first_per_key_and_duplicates(spark):
    df = spark.createDataFrame([(1, 10, False), (1, 11, True), (1, 9, False), (2, 20, False), (2, 19, None)],
                               "k int, s int, siege boolean")
    order = [F.struct(F.col("siege").isNull(), ~F.col("siege")), F.col("s")]
    got = sorted((r.k, r.s) for r in first_per_key(df, ["k"], order).collect())
    assert got == [(1, 11), (2, 20)]
    dup = {r.k: r.nb_occurrences for r in duplicate_keys(df, ["k"]).collect()}
    assert dup == {1: 3, 2: 2}


def test_top_k_two_stage_matches_single(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1000).alias("s"))
    order = [F.col("s").desc(), F.col("id")]
    a = sorted(tuple(r) for r in top_k_per_group(df, ["g"], 5, order, salt_from=["id"], buckets=16).collect())
    b = sorted(tuple(r) for r in top_k_per_group(df, ["g"], 5, order).collect())
    assert a == b and len(a) == 15


def test_shares_lists_concentration(spark):
    agg = spark.createDataFrame([("a", 1, 5), ("b", 2, 3), ("c", 2, 2)], "k string, o int, n long")
    rs = {r.k: r.pct_cumul for r in with_running_share(agg, "n", F.col("o")).collect()}
    assert rs == {"a": 50.0, "b": 100.0, "c": 100.0}     # RANGE frame: peers included
    c = {r.k: (r.rang, r.dans_noyau) for r in concentration(agg, "k", "n").collect()}
    assert c == {"a": (1, True), "b": (2, True), "c": (3, False)}
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("x", None), ("x", "c")], "g string, v string")
    assert df.groupBy("g").agg(distinct_list("v", 2).alias("l")).first().l == "a,b"


def test_projection_ops(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    assert drop_null_columns(df).columns == ["a", "c"]
    t = select_tolerant(df, ["a", "zz"])
    assert t.columns == ["a", "zz"] and t.first().zz is None
    left = spark.createDataFrame([(1, "L")], "k int, v string")
    right = spark.createDataFrame([(1, "R", 5)], "k int, v string, w int")
    j = left_join_keep_left(left, right, "k").first()
    assert (j.v, j.w) == ("L", 5)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 30), (1, "b", 140), (2, "a", 50)], "k int, s string, x int")
    assert unique_key_check(df, ["k"], "u").first().statut == "ANOMALIE"
    assert group_consistency_check(df, "k", "s", "g").first().valeur == 1.0
    b = bounds_check(df, "x", 25, 130, "b").first()
    assert b.statut == "ANOMALIE" and b.valeur == 1.0


def test_distribution_check_registry_profiles(spark):
    rows = [(f"{i:02d}", p) for i, p in enumerate(p for p, n in bands.REGISTRY_PROFILE_COUNTS for _ in range(n))]
    dim = spark.createDataFrame(rows, "dep string, profil_territorial string")
    exp = spark.createDataFrame(list(bands.REGISTRY_PROFILE_COUNTS), "profil_territorial string, n long")
    assert dim.count() == 101
    assert distribution_check(dim, "profil_territorial", exp, "p").first().statut == "OK"
    bad = dim.where("dep <> '00'")
    assert distribution_check(bad, "profil_territorial", exp, "p").first().valeur == 2.0


def test_api_cascade_modes(spark):
    from tessera import api
    df = spark.createDataFrame([(6,), (4,)], "x int")
    c = api.cascade("lab", [("x >= 5", "hi")], "lo")
    assert [r.lab for r in df.select(c.column()).collect()] == ["hi", "lo"]
    f = api.cascade("", [("a", "x >= 3"), ("b", "x >= 5")], mode="exclusive_flags")
    assert [(r.a, r.b) for r in f.apply(df).collect()] == [(True, False), (True, False)]


def test_rows_per_task_from_session_conf(spark):
    from tessera.operators.groups import ROWS_PER_TASK_CONF
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    spark.conf.set(ROWS_PER_TASK_CONF, "10")
    try:
        heavy = {r["k"]: r["__buckets"] for r in SaltPlan.for_fact(df, ["k"]).heavy.collect()}
    finally:
        spark.conf.unset(ROWS_PER_TASK_CONF)
    assert heavy == {0: 5, 1: 5}
    assert SaltPlan.for_fact(df, ["k"]).heavy.count() == 0
