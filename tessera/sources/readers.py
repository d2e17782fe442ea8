"""Readers: driver tables, raw registry JSON, partitioned raw/processed tables,
dimension CSVs. All with explicit schemas; all lazy."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_code_text, safe_name, try_date, try_double
from . import schemas

TABLE_KINDS = ("siret", "siren", "full")


def read_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (schema from the Parquet footer)."""
    return spark.read.parquet(os.path.join(d, f"{name}.parquet"))


def flatten_structs(df: DataFrame, sep: str = "_", keep_arrays: bool = True) -> DataFrame:
    """Flatten nested structs into top-level columns named ``parent<sep>child``
    (recursively); arrays are kept as they are. Pure projection, no shuffle."""
    def walk(t: T.StructType, path: list[str]):
        for f in t.fields:
            p = path + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, p)
            else:
                yield p
    cols = [F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p)) for p in walk(df.schema, [])]
    return df.select(*cols)


def read_raw_json(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_ESTABLISHMENT,
                  flatten: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """Nested establishment records (JSON lines) read with an explicit schema.
    With ``corrupt_column`` malformed lines are kept (PERMISSIVE) for quarantine."""
    r = spark.read.schema(schema if corrupt_column is None
                          else T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)]))
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    df = r.json(path)
    return flatten_structs(df) if flatten else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system that holds it (any scheme, or the default one)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def partition_path(spark: SparkSession, root: str, column: str, value: str) -> str:
    """The folder of one partition, its value escaped as the writer does."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return f"{root.rstrip('/')}/{column}={name}"


def read_partitioned(spark: SparkSession, root: str, code_ape: str | None = None,
                     schema: T.StructType | None = None) -> DataFrame:
    """Read a dataset partitioned by ``code_ape``; a code filter prunes partitions.
    A missing dataset or code raises ``FileNotFoundError``, on any file system."""
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no dataset at {root}")
    r = spark.read.schema(schema) if schema is not None else spark.read
    df = r.parquet(root)
    if code_ape is None:
        return df
    if not path_exists(spark, partition_path(spark, root, "code_ape", code_ape)):
        raise FileNotFoundError(f"no data for code {code_ape} under {root}")
    return df.where(F.col("code_ape") == code_ape)


def read_processed(spark: SparkSession, root: str, table_type: str, code_ape: str | None = None) -> DataFrame:
    """Processed table of one grain (``siret``, ``siren`` or ``full``)."""
    if table_type not in TABLE_KINDS:
        raise ValueError(f"table_type must be one of {TABLE_KINDS}, got {table_type!r}")
    return read_partitioned(spark, os.path.join(root, table_type), code_ape)


def read_dimension_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Dimension CSV with header and an explicit schema; a blank header column
    (read as ``_blank``) is dropped."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return df.drop("_blank") if "_blank" in df.columns else df


def read_dimensions(spark: SparkSession, folder: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Load every dimension of ``schemas.DIMENSION_SCHEMAS`` from ``folder``."""
    files = files or {
        "dim_departements": "departements.csv", "dim_codes_ape": "codes_ape.csv",
        "dim_categories_effectifs": "categories_effectifs.csv",
        "dim_categories_juridiques": "categories_juridiques.csv", "dim_anciennete": "anciennete.csv",
    }
    return {k: read_dimension_csv(spark, os.path.join(folder, v), schemas.DIMENSION_SCHEMAS[k])
            for k, v in files.items()}


def force_string_schema(df: DataFrame) -> DataFrame:
    """Every column as string (the repaired legal-category dimension)."""
    return df.select(*[clean_code_text(F.col(c)).alias(c) if not isinstance(t, T.StringType) else F.col(c)
                       for c, t in zip(df.columns, [f.dataType for f in df.schema.fields])])


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Warehouse-safe names; a collision after renaming is an error."""
    new = [safe_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"column names collide after sanitising: {dup}")
    return df.toDF(*new)


INT_COLUMNS = ("anneeEffectifsEtablissement", "nombrePeriodesEtablissement", "anciennete_etab_annees",
               "anciennete_ul_annees", "anneeEffectifsUniteLegale")
DOUBLE_COLUMNS = ("longitude", "latitude")
BOOL_COLUMNS = ("etablissementSiege", "dept_anomaly")


def coerce_types(df: DataFrame) -> DataFrame:
    """Name-driven tolerant typing (what does not parse as a whole is null):
    ``*date*`` (not ``datetime``/``traitement``) -> date; ``*traitement*`` ->
    timestamp; listed names (exact) -> int; longitude/latitude -> double;
    listed flags -> boolean."""
    out = []
    for c in df.columns:
        q = f"`{c}`"
        low = c.lower()
        if "traitement" in low:
            e = F.expr(f"try_cast({q} AS TIMESTAMP)")
        elif "date" in low and "datetime" not in low:
            e = try_date(F.col(q))
        elif c in INT_COLUMNS:
            e = try_double(F.col(q)).try_cast("int")
        elif c in DOUBLE_COLUMNS:
            e = try_double(F.col(q))
        elif c in BOOL_COLUMNS:
            e = F.expr(f"try_cast({q} AS BOOLEAN)")
        else:
            out.append(F.col(q))
            continue
        out.append(e.alias(c))
    return df.select(*out)
