"""Catalogue: entry point, oracle agreement on the small data set, plan shape."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events".split()

# a spread of operators across the layers; the whole catalogue runs in tools/check_oracle.py
SAMPLE = ["a20_segment_pyramid", "v1_scored_view", "x9_segment_cascade", "j8_unmatched_keys", "a5_density_top10",
          "a12_having_then_share", "a21_score_percentiles", "a23_target_concentration", "p3_latest_period",
          "p12_lambert_to_wgs84", "d2_one_row_per_key", "v6_version_migration", "v7_top_targets_per_segment",
          "q9_one_segment_per_entity", "s18_freshness_gate", "x17_rules_v15_exclusive", "w4_running_share"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert set(df.columns) >= {"segment_entreprise", "nb_entreprises", "nb_etablissements"}
    assert df.count() >= 1


def test_every_query_has_a_name_and_most_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 120 and set(o) <= set(q)
    assert [n for n in set(q) - set(o) if not n.startswith("op") and n != "pipeline"] == []


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    cols = df.columns
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=repr)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == exp


def test_view_plan_shape(spark, sf_small):
    """Dimensions are broadcast, no Python runs per row, and the entity mean needs no window: the
    fact is read twice, once for its rows and once for the entities' counts and points."""
    df = entry.queries()["v1_scored_view"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("BroadcastHashJoin") >= 5
    assert "Window [" not in plan
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]     # the adaptive plan as it ran
    assert sum("FileScan parquet [o_" in line for line in ran.split("\n")) <= 2


def test_view_does_not_depend_on_hot_entities(spark, sf_small):
    """Every entity split into buckets gives the same rows."""
    want = sorted(map(str, entry.queries()["v1_scored_view"](spark, sf_small).collect()))
    spark.conf.set("tessera.salt.rowsPerTask", "2")
    try:
        got = sorted(map(str, entry.queries()["v1_scored_view"](spark, sf_small).collect()))
    finally:
        spark.conf.unset("tessera.salt.rowsPerTask")
    assert got == want
