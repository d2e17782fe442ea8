"""Data-quality checks as DataFrames.

Every check is a one-row-per-check frame ``(controle, valeur, attendu, statut)``
computed from aggregates (no collect); ``checks`` unions them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, KO, MINOR = "OK", "ANOMALIE", "ECART MINEUR"
NO_DATA = "AUCUNE DONNEE"


def check(agg: DataFrame, name: str, value: Column, expected: Column, ok: Column,
          minor: Column | None = None) -> DataFrame:
    """Turn a one-row aggregate into a check row."""
    # a value that could not be computed (no rows) is neither right nor wrong
    status = F.when(value.isNull(), F.lit(NO_DATA)).when(ok, F.lit(OK))
    if minor is not None:
        status = status.when(minor, F.lit(MINOR))
    status = status.otherwise(F.lit(KO))
    return agg.select(F.lit(name).alias("controle"), value.cast("double").alias("valeur"),
                      expected.cast("string").alias("attendu"), status.alias("statut"))


def checks(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def coverage_checks(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Non-null rate per column against a threshold (percent)."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(f"__c_{c}") for c in cols])
    frames = []
    for c in cols:
        rate = F.try_divide(F.col(f"__c_{c}") * F.lit(100.0), F.col("__n"))
        frames.append(check(agg, f"couverture_{c}", rate, F.lit(f">= {threshold}"), rate >= threshold))
    return checks(frames)


def row_count_check(actual: DataFrame, expected: DataFrame, name: str, band_pct: float = 1.0) -> DataFrame:
    """Row count vs an expected count: equal -> OK, within ``band_pct`` -> minor."""
    a = actual.agg(F.count(F.lit(1)).alias("__a"))
    e = expected.agg(F.count(F.lit(1)).alias("__e"))
    j = a.select("__a", e.scalar().alias("__e"))   # one-row aggregate as a scalar subquery
    diff = F.abs(F.col("__a") - F.col("__e"))
    return check(j, name, F.col("__a"), F.col("__e"), diff == 0,
                 diff * F.lit(100.0) <= F.col("__e") * F.lit(band_pct))


def unique_key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys appearing more than once (expected 0). The per-key counts
    are partially aggregated; only the final count reaches one task."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    agg = dup.agg(F.count(F.lit(1)).alias("__d"))
    return check(agg, name, F.col("__d"), F.lit(0), F.col("__d") == 0)


def null_check(df: DataFrame, cols: Sequence[str], prefix: str = "nulls_") -> DataFrame:
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"__z_{c}") for c in cols])
    return checks([check(agg, prefix + c, F.col(f"__z_{c}"), F.lit(0), F.col(f"__z_{c}") == 0) for c in cols])


def bounds_check(df: DataFrame, col: str, lo: float, hi: float, name: str) -> DataFrame:
    """Min/max inside [lo, hi], no nulls, no out-of-range rows: one status."""
    agg = df.agg(F.min(col).alias("__mn"), F.max(col).alias("__mx"),
                 F.count(F.when(F.col(col).isNull(), F.lit(1))).alias("__z"),
                 F.count(F.when((F.col(col) < lo) | (F.col(col) > hi), F.lit(1))).alias("__o"))
    ok = (F.col("__mn") >= lo) & (F.col("__mx") <= hi) & (F.col("__z") == 0) & (F.col("__o") == 0)
    return check(agg, name, F.col("__o") + F.col("__z"), F.lit(f"[{lo}, {hi}]"), ok)


def group_consistency_check(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Groups where ``col`` takes more than one value (expected 0). Distinct
    (key, value) pairs are found by aggregation, never by collecting a group."""
    pairs = df.groupBy(key, col).agg(F.count(F.lit(1)).alias("__n"))
    multi = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("__v")).where(F.col("__v") > 1)
    agg = multi.agg(F.count(F.lit(1)).alias("__m"))
    return check(agg, name, F.col("__m"), F.lit(0), F.col("__m") == 0)


def distribution_check(df: DataFrame, col: str, expected: DataFrame, name: str) -> DataFrame:
    """Counts per value of ``col`` equal ``expected`` (columns ``col``, ``n``):
    the number of differing (value, count) rows, both directions (expected 0)."""
    got = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    exp = expected.select(col, F.col("n").cast("long"))
    diff = got.exceptAll(exp).unionByName(exp.exceptAll(got))
    agg = diff.agg(F.count(F.lit(1)).alias("__d"))
    return check(agg, name, F.col("__d"), F.lit("0"), F.col("__d") == 0)
