"""Writers: partitioned, clustered publication of the three grains and exports.

Layout: one dataset per grain partitioned by ``code_ape`` (partition pruning for
per-code reads), rows range-partitioned on (code_ape, cluster columns) and
sorted within files, so Parquet min/max statistics skip row groups for
department/activity filters. Range partitioning samples the keys, so a large
code is spread over several tasks instead of landing in one. Without cluster columns
the few codes are no ranges to spread rows by: each code is then dealt by a hash of the row,
and adaptive execution splits and joins the parts by their size.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import SALT_COLUMNS
from ..session import compiled_code

GRAINS = ("siret", "siren", "full")
# Parts that the rows of one partition are dealt over, at most.
_DEALT, _DEALS = "__dealt", 256
DEFAULT_CLUSTER = ("departement", "type_activite_etab", "categorie_effectifs_etab")


def publish(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ("code_ape",),
            cluster_by: Sequence[str] = (), num_files: int | None = None, day_partition: str | None = None) -> None:
    """Write ``df`` as Parquet. ``overwrite`` replaces only the partitions
    present in ``df`` (dynamic partition overwrite), so re-publishing one code
    leaves the others intact; ``append`` adds files. ``day_partition`` names a
    date/timestamp column whose day becomes an extra partition column
    ``<column>_jour``. Clustering columns that do not exist are ignored."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    df = df.drop(*[c for c in SALT_COLUMNS if c in df.columns])   # internal partitioning columns
    if day_partition:
        day_col = f"{day_partition}_jour"
        df = df.withColumn(day_col, F.to_date(F.col(day_partition)))
        partition_by = tuple(partition_by) + (day_col,)
    cluster = [c for c in cluster_by if c in df.columns]
    keys = [c for c in partition_by if c in df.columns] + cluster
    out = df
    if keys:
        if cluster or num_files:
            out = out.repartitionByRange(num_files, *keys) if num_files else out.repartitionByRange(*keys)
        else:
            out = out.withColumn(_DEALT, F.pmod(F.xxhash64(*[c for c, t in out.dtypes if "map<" not in t]), F.lit(_DEALS))) \
                .hint("rebalance", *[F.col(c) for c in keys], F.col(_DEALT)).drop(_DEALT)
        if cluster:
            out = out.sortWithinPartitions(*keys)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    with compiled_code(df.sparkSession):
        w.parquet(path)


def save_split(siret: DataFrame, siren: DataFrame, full: DataFrame, root: str, mode: str = "overwrite",
               cluster_by: Sequence[str] = DEFAULT_CLUSTER) -> dict[str, str]:
    """Write the three grains under ``root/{siret,siren,full}``."""
    paths = {}
    for name, df in zip(GRAINS, (siret, siren, full)):
        paths[name] = os.path.join(root, name)
        publish(df, paths[name], mode, ("code_ape",), cluster_by if name != "siren" else ())
    return paths


def export_final(df: DataFrame, path: str, drop: Sequence[str] = (), rename: dict[str, str] | None = None,
                 partition_by: Sequence[str] = ()) -> DataFrame:
    """Drop helper columns, rename for the consumer, write; returns the exported frame."""
    out = df.drop(*drop).withColumnsRenamed(rename or {})
    publish(out, path, "overwrite", partition_by)
    return out


# FIXED VALUES: clustering field of each published dimension.
DIMENSION_CLUSTERING = {
    "dim_departements": ("region",),
    "dim_codes_ape": ("division_ape",),
    "dim_categories_effectifs": (),
    "dim_categories_juridiques": ("famille_juridique",),
    "dim_anciennete": (),
}


def load_dimensions(dims: dict[str, DataFrame], root: str) -> DataFrame:
    """Publish each dimension (sorted on its clustering field) under ``root`` and
    report ``(table_name, nb_lignes, statut)`` read back from what was written.
    A dimension that fails to write is reported as ``error`` with no rows."""
    spark = next(iter(dims.values())).sparkSession
    out = None
    for name, df in dims.items():
        path = os.path.join(root, name)
        try:
            cl = [c for c in DIMENSION_CLUSTERING.get(name, ()) if c in df.columns]
            one = df.coalesce(1)              # sort after coalescing: the file itself is sorted
            (one.sortWithinPartitions(*cl) if cl else one).write.mode("overwrite").parquet(path)
            row = (spark.read.parquet(path).groupBy().count()
                   .selectExpr(f"'{name}' AS table_name", "count AS nb_lignes", "'success' AS statut"))
        except Exception:  # noqa: BLE001 - reported as a row, as the source's per-table status
            row = spark.createDataFrame([(name, None, "error")], "table_name string, nb_lignes long, statut string")
        out = row if out is None else out.unionByName(row)
    return out
