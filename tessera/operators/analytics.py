"""Reusable analytics: coverage, density, distributions, percent of total,
running shares, top-k, distinct string lists, concentration.

Every operator aggregates first (partial aggregation on the map side) and only
then applies windows, which therefore run over small aggregated frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_sums

HUNDRED = 100.0


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` holds (null counts as false)."""
    return F.count(F.when(cond, F.lit(1)))


def pct(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` as a double; null when ``whole`` is 0."""
    return F.try_divide(part * F.lit(HUNDRED), whole)


def coverage(df: DataFrame, cols: Sequence[str], total: str = "nb_total") -> DataFrame:
    """One row: total rows, and for each column its non-null count and rate."""
    aggs = [F.count(F.lit(1)).alias(total)]
    for c in cols:
        aggs.append(F.count(c).alias(f"nb_avec_{c}"))
    out = df.agg(*aggs)
    return out.select("*", *[pct(F.col(f"nb_avec_{c}"), F.col(total)).alias(f"taux_{c}") for c in cols])


def with_share(agg: DataFrame, count_col: str, name: str = "pourcentage",
               within: Sequence[str] = ()) -> DataFrame:
    """Percent of total (or of a group) on an already aggregated frame."""
    w = Window.partitionBy(*within)
    return agg.withColumn(name, pct(F.col(count_col), F.sum(count_col).over(w)))


def with_running_share(agg: DataFrame, count_col: str, order: Column, name: str = "pct_cumul") -> DataFrame:
    """Cumulative percent in ``order`` (RANGE frame: peers included, as in SQL
    without a frame clause; nulls first). Counts are summed by value of ``order`` first, so peers share
    one row of the running sum."""
    per = agg.groupBy(order.alias("__order")).agg(F.sum(count_col).alias("__n"))
    run = running_sums(per, [F.col("__order").asc_nulls_first()], {"__run": "__n"}, totals={"__all": "__n"}) \
        .select("__order", pct(F.col("__run"), F.col("__all")).alias(name))
    return agg.join(run, order.eqNullSafe(run["__order"])).drop("__order")


def density(counts: DataFrame, count_col: str, group: Sequence[str],
            population: str = "population_2022", per: float = 10000.0) -> DataFrame:
    """Establishments per ``per`` inhabitants by dimension group, from counts a dimension row
    (unmatched fact keys are left out before, as in the source)."""
    agg = counts.groupBy(*group, population).agg(F.sum(count_col).alias("nb_etablissements"))
    return agg.withColumn("densite_pour_10k_hab",
                          F.try_divide(F.col("nb_etablissements"), F.col(population)) * F.lit(per))


def distinct_list(col: str, n: int | None = None, sep: str = ",") -> Column:
    """Sorted distinct non-null values joined by ``sep``; the first ``n`` when
    given (the source's ``STRING_AGG(DISTINCT x LIMIT n)`` order is arbitrary)."""
    s = F.array_sort(F.collect_set(col))
    if n is not None:
        s = F.slice(s, 1, n)
    return F.array_join(s, sep)


def grouped_with_list(df: DataFrame, group: Sequence[str], col: str, n: int, sums: dict[str, Column], name: str,
                      sep: str = ",", buckets: int | None = None) -> DataFrame:
    """Per group the sums of ``sums`` (additive columns, null counts 0) and, as ``name``, its ``n`` first distinct
    values of ``col`` joined by ``sep``.

    Distinct values are found by a partial aggregate; those of a group are dealt to ``buckets`` (the session's shuffle
    partitions by default), of which each keeps ``n``, so no task ever holds more than ``n`` x ``buckets`` of a group."""
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    pre = df.groupBy(*group, col).agg(*[F.sum(c).alias(k) for k, c in sums.items()])
    pre = pre.withColumn("__bucket", F.pmod(F.xxhash64(col), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy(F.col(col).asc_nulls_last()))
    pre = pre.withColumn("__kept", F.when(place <= n, F.col(col)))
    some = pre.groupBy(*group, "__bucket").agg(*[F.sum(k).alias(k) for k in sums], F.collect_list("__kept").alias("__list"))
    out = some.groupBy(*group).agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in sums],
                                   F.slice(F.array_sort(F.flatten(F.collect_list("__list"))), 1, n).alias("__list"))
    return out.withColumn(name, F.array_join("__list", sep)).drop("__list")


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (give a total order); planned as
    TakeOrderedAndProject: each task keeps k rows, the driver merges them."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, part: Sequence[str], k: int, order: Sequence[Column],
                    rank: str = "rang", salt_from: Sequence[str] | None = None,
                    buckets: int | None = None) -> DataFrame:
    """First ``k`` rows per group by ``order`` (give a total order).

    With ``salt_from`` the ranking runs in two stages so that a large group
    (a segment can hold most rows) is never sorted by one task: first the top
    ``k`` within each (group, hash bucket), then the top ``k`` among those
    ``k * buckets`` candidates per group. ``buckets`` defaults to the session's
    shuffle partition count, so it grows with the cluster."""
    if salt_from:
        if buckets is None:
            buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        b = "__topk_bucket"
        pre = df.withColumn(b, F.pmod(F.xxhash64(*salt_from), F.lit(buckets)))
        w1 = Window.partitionBy(*part, b).orderBy(*order)
        df = pre.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop("__r1", b)
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def value_counts(df: DataFrame, col: str, k: int | None = None, name: str = "nb_lignes") -> DataFrame:
    """Counts per value, nulls included; optionally the top ``k`` (count
    descending, then value ascending with nulls first)."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return out if k is None else out.orderBy(F.col(name).desc(), F.col(col).asc_nulls_first()).limit(k)


def concentration(counts: DataFrame, key: str, count_col: str, threshold: float = 70.0) -> DataFrame:
    """Rank keys by count (desc, key asc), cumulative share, and whether the key
    is among the smallest set reaching ``threshold`` percent. One row a key, as many
    as there are (``running_sums``: no task sees them all)."""
    out = running_sums(counts, [F.col(count_col).desc(), F.col(key).asc_nulls_first()], {"__run": count_col}, "rang", {"__all": count_col})
    before = pct(F.col("__run") - F.coalesce(F.col(count_col), F.lit(0)), F.col("__all"))
    return out.select(*counts.columns, F.col("rang").cast("int").alias("rang"), pct(F.col("__run"), F.col("__all")).alias("part_cumulee"),
                      (F.coalesce(before, F.lit(0.0)) < F.lit(threshold)).alias("dans_noyau"))


def histogram(df: DataFrame, col: str, edges: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """One row, one count per bucket ``[lo, hi)`` (open ends with None)."""
    aggs = []
    for name, lo, hi in edges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(col) >= lo)
        if hi is not None:
            cond = cond & (F.col(col) < hi)
        aggs.append(count_if(cond).alias(name))
    return df.agg(*aggs)
