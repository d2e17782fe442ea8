"""Column-set operators: drop all-null columns, strict and tolerant allow-lists,
prefixed struct spreading, suffix drops, per-column validity profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row. One aggregate job computes all
    non-null counts at once (a single row reaches the driver)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    empty = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] == 0]
    return df.drop(*empty)


def select_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Allow-list; a missing column is an error (``AnalysisException``)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def select_tolerant(df: DataFrame, cols: Sequence[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Allow-list keeping only what exists; missing columns come back as typed
    nulls so downstream steps keep a stable schema."""
    types = types or {}
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
                       for c in cols])


def spread_struct(df: DataFrame, col: str, prefix: str, drop: bool = True) -> DataFrame:
    """Struct fields as top-level columns named ``prefix + field``."""
    fields = df.schema[col].dataType.fieldNames()
    out = df.select("*", *[F.col(f"`{col}`")[f].alias(prefix + f) for f in fields])
    return out.drop(col) if drop else out


def drop_suffix(df: DataFrame, suffix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def left_join_keep_left(left: DataFrame, right: DataFrame, key: str, suffix: str = "_siren_dup") -> DataFrame:
    """Left join where the left side wins on name clashes: clashing right
    columns are suffixed, then dropped."""
    clash = [c for c in right.columns if c in left.columns and c != key]
    r = right.select(*[F.col(c).alias(c + suffix) if c in clash else F.col(c) for c in right.columns])
    return drop_suffix(left.join(r, key, "left"), suffix)


def validity_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null count and rate per column, one pass; one row per column."""
    aggs = [F.count(F.lit(1)).alias("__total")] + [F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {stack}) AS (colonne, nb_valides)", "__total AS nb_total") \
        .withColumn("pct_valides", F.try_divide(F.col("nb_valides") * F.lit(100.0), F.col("nb_total")))
