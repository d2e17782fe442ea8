"""Publication of the three grains in one step: all of them are seen, or none.

A publication writes its grains under ``root/version=v/grain=g/code_ape=c`` and then replaces one small
file, ``root/current.json``, which says for each grain and code the version that holds it. Readers take the paths from
that file, so a publication that fails half-way changes nothing for them, and a reader sees the grains
of one publication together. A publication replaces the codes that any of its grains has, in all grains; other codes
keep their version. One publisher at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import path_exists
from .writers import DEFAULT_CLUSTER, GRAINS, publish

POINTER = "current.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """grain -> folder of a code -> version; empty where nothing is published."""
    path = f"{root.rstrip('/')}/{POINTER}"
    if not path_exists(spark, path):
        return {g: {} for g in GRAINS}
    lines = spark.read.text(path, wholetext=True).first()
    return json.loads(lines[0])


def _point(spark: SparkSession, root: str, pointer: dict[str, dict[str, str]]) -> None:
    """Replace the pointer: the new file is complete before it takes the old one's name."""
    jvm = spark.sparkContext._jvm
    new, fs = _fs(spark, f"{root.rstrip('/')}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    finally:
        out.close()
    at = fs.makeQualified(new)
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(at, fs.makeQualified(_fs(spark, f"{root.rstrip('/')}/{POINTER}")[0]), options)


def publish_grains(siret: DataFrame, siren: DataFrame, full: DataFrame, root: str,
                   cluster_by: Sequence[str] = DEFAULT_CLUSTER) -> str:
    """Publish the grains (each with ``code_ape``) as one version and return its name."""
    spark, root = full.sparkSession, root.rstrip("/")
    missing = [c for c in cluster_by if c not in full.columns]
    if missing:
        raise ValueError(f"no such clustering columns: {missing}")
    version = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    held: dict[str, list[str]] = {}
    for grain, df in zip(GRAINS, (siret, siren, full), strict=True):
        path = f"{root}/version={version}/grain={grain}"
        publish(df, path, "overwrite", ("code_ape",), [c for c in cluster_by if c in df.columns] if grain != "siren" else ())
        folder, fs = _fs(spark, path)
        held[grain] = [s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("code_ape=")]
    pointer, replaced = current(spark, root), {c for codes in held.values() for c in codes}
    for grain in GRAINS:
        kept = {c: v for c, v in pointer[grain].items() if c not in replaced}
        pointer[grain] = kept | dict.fromkeys(held[grain], version)
    _point(spark, root, pointer)
    return version


def read_published(spark: SparkSession, root: str, grain: str, code_ape: str | None = None) -> DataFrame:
    """A grain as last published, or one code of it; ``FileNotFoundError`` where there is none."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    root = root.rstrip("/")
    parts = current(spark, root)[grain]
    if code_ape is not None:
        name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(code_ape)
        parts = {c: v for c, v in parts.items() if c == f"code_ape={name}"}
    if not parts:
        raise FileNotFoundError(f"no {grain} published under {root}" + (f" for code {code_ape}" if code_ape else ""))
    paths = [f"{root}/version={v}/grain={grain}/{c}" for c, v in sorted(parts.items())]
    return spark.read.option("basePath", root).parquet(*paths).drop("version", "grain") \
        .withColumn("code_ape", F.col("code_ape").cast("string"))


def remove_unused(spark: SparkSession, root: str, keep_seconds: float = 7 * 86_400) -> list[str]:
    """Remove the versions that no grain points to and that began more than ``keep_seconds`` ago
    (readers may still be on younger ones); returns their names."""
    used = {v for codes in current(spark, root).values() for v in codes.values()}
    folder, fs = _fs(spark, root)
    gone = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        version = name.removeprefix("version=")
        if name != version and version not in used and int(version.split("-")[0]) < time.time_ns() - keep_seconds * 1e9:
            fs.delete(status.getPath(), True)
            gone.append(version)
    return gone
