"""Sources, sinks, manifest and streaming queries (S1..S20, ST1..ST3).

Queries that write do so under a fresh folder of the session's checkpoint dir
(``spark.checkpoint.dir``, the cluster's shared folder) and return the
read-back DataFrame, so the write path is exercised end to end.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.groups import SALT_COLUMNS, SaltPlan, group_size
from ..session import compiled_code, freed_shuffles, scratch_path
from ..sources import manifest as mf
from ..sources import schemas
from ..sources.readers import (
    flatten_structs, force_string_schema, read_dimension_csv, read_partitioned, read_processed, read_raw_json,
    read_table,
)
from ..sources.manifest import publish_report
from ..sources.publication import publish_grains, read_published
from ..sources.writers import export_final, load_dimensions, publish, save_split
from ..streaming.ingest import ingest_pages, latest_scored, score_stream
from . import model, views
from .catalog import query
from .oracle import _pmod, with_model
from .q_core import context


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"tessera-{name}-{uuid.uuid4().hex[:12]}")


def _grains(spark, d):
    raw = model.enriched_siret(model.with_geo(model.raw_siret(spark, d)))
    active = raw.where(F.col("periode_etatAdministratifEtablissement") == "A")
    ent = model.siren_table(spark, d, active)
    full, plan = model.full(spark, d)
    code = ent.select("siren", F.col("uniteLegale_activitePrincipaleUniteLegale").alias("code_ape"))
    siret = plan.join(active, code, "inner", salt_from=["siret"]).drop(*SALT_COLUMNS)
    siren = ent.withColumn("code_ape", F.col("uniteLegale_activitePrincipaleUniteLegale"))
    return siret, siren, full.drop(*SALT_COLUMNS)


# Nested JSON -> flat columns --------------------------------------------------------
@query("s1_json_flatten", """
SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k FROM events""")
def s1_json_flatten(spark, d):
    e = read_table(spark, d, "events")
    parsed = e.select("event_id", "event_type",
                      F.from_json("props", T.StructType([T.StructField("k", T.IntegerType())])).alias("props"))
    return flatten_structs(parsed)


_NESTED_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS siret, CAST(o_custkey AS VARCHAR) AS siren,
       strftime(o_orderdate, '%Y-%m-%d') AS dateCreationEtablissement,
       o_orderpriority AS uniteLegale_categorieJuridiqueUniteLegale,
       lpad(CAST({_pmod('o_custkey', 25)} AS VARCHAR), 2, '0') AS adresseEtablissement_codeCommuneEtablissement,
       {_pmod('o_orderkey', 7)} = 0 AS etablissementSiege
FROM orders"""


def _write_nested(spark, d, path):
    o = read_table(spark, d, "orders")
    rec = o.select(
        F.col("o_orderkey").cast("string").alias("siret"), F.col("o_custkey").cast("string").alias("siren"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateCreationEtablissement"),
        (F.pmod("o_orderkey", F.lit(7)) == 0).alias("etablissementSiege"),
        F.struct(F.col("o_orderpriority").alias("categorieJuridiqueUniteLegale")).alias("uniteLegale"),
        F.struct(F.lpad(F.pmod("o_custkey", F.lit(25)).cast("string"), 2, "0").alias("codeCommuneEtablissement"))
        .alias("adresseEtablissement"))
    rec.write.mode("overwrite").json(path)


@query("s1_nested_records_roundtrip", _NESTED_SQL)
def s1_nested_records_roundtrip(spark, d):
    path = _scratch(spark, "json")
    _write_nested(spark, d, path)
    flat = read_raw_json(spark, path)
    return flat.select("siret", "siren", "dateCreationEtablissement", "uniteLegale_categorieJuridiqueUniteLegale",
                       "adresseEtablissement_codeCommuneEtablissement", "etablissementSiege")


# Publish the grains, read back --------------------------------
def _published(spark, d):
    root = _scratch(spark, "publish")
    siret, siren, full = _grains(spark, d)
    return save_split(siret, siren, full, root), root


@query("s8_save_three_grains", with_model("""
SELECT 'siret' AS grain, code_ape, COUNT(*) AS nb_lignes FROM full_t GROUP BY code_ape
UNION ALL SELECT 'siren', uniteLegale_activitePrincipaleUniteLegale, COUNT(*) FROM siren_t GROUP BY 2
UNION ALL SELECT 'full', code_ape, COUNT(*) FROM full_t GROUP BY code_ape"""))
def s8_save_three_grains(spark, d):
    paths, root = _published(spark, d)
    out = None
    for g in ("siret", "siren", "full"):
        c = (spark.read.parquet(paths[g]).groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_lignes"))
             .select(F.lit(g).alias("grain"), "code_ape", "nb_lignes"))
        out = c if out is None else out.unionByName(c)
    return out


_KEPT = f"(code_ape <> '{model.FOCUS_CODE}' OR siret % 2 = 0)"


@query("s8_atomic_publication", with_model(f"""
SELECT 'siret' AS grain, code_ape, COUNT(*) AS nb_lignes, COUNT(DISTINCT siren) AS nb_siren FROM full_t WHERE {_KEPT} GROUP BY code_ape
UNION ALL SELECT 'siren', uniteLegale_activitePrincipaleUniteLegale, COUNT(*), COUNT(DISTINCT siren) FROM siren_t GROUP BY 2
UNION ALL SELECT 'full', code_ape, COUNT(*), COUNT(DISTINCT siren) FROM full_t WHERE {_KEPT} GROUP BY code_ape"""))
def s8_atomic_publication(spark, d):
    """All codes, then one of them anew with half of its sites, then a publication that fails in its third grain, of which nothing shows."""
    siret, siren, full = _grains(spark, d)
    root = _scratch(spark, "atomic")
    publish_grains(siret, siren, full, root, ("departement",))
    one = F.col("code_ape") == model.FOCUS_CODE
    half = one & (F.pmod("siret", F.lit(2)) == 0)
    publish_grains(siret.where(half), siren.where(one), full.where(half), root, ("departement",))
    broken = full.where(one).withColumn("siren", F.when(F.col("siren") > 0, F.raise_error(F.lit("disk full")).cast("long")))
    try:
        publish_grains(siret.where(one), siren.where(one).limit(1), broken, root, ("departement",))
        raise AssertionError("the publication must fail")
    except SparkRuntimeException:
        pass
    out = None
    for g in ("siret", "siren", "full"):
        c = read_published(spark, root, g).groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_lignes"), F.count_distinct("siren").alias("nb_siren"))
        c = c.select(F.lit(g).alias("grain"), "code_ape", "nb_lignes", "nb_siren")
        out = c if out is None else out.unionByName(c)
    return out


@query("s2_read_one_code", with_model(
    f"SELECT siret, siren FROM full_t WHERE code_ape = '{model.FOCUS_CODE}'"))
def s2_read_one_code(spark, d):
    paths, root = _published(spark, d)
    try:
        read_partitioned(spark, paths["full"], "NO-SUCH-CODE")
        raise AssertionError("a missing code must raise")
    except FileNotFoundError:
        pass
    return read_partitioned(spark, paths["full"], model.FOCUS_CODE).select("siret", "siren")


@query("s3_read_processed_kind", with_model("SELECT siren, nb_etablissements FROM siren_t"))
def s3_read_processed_kind(spark, d):
    paths, root = _published(spark, d)
    try:
        read_processed(spark, root, "other")
        raise AssertionError("an unknown table kind must raise")
    except ValueError:
        pass
    return read_processed(spark, root, "siren").select("siren", "nb_etablissements")


@query("s14_publish_all_codes_report", with_model("""
SELECT code_ape, COUNT(*) AS nb_siret, COUNT(DISTINCT siren) AS nb_siren, 'success' AS statut,
       CAST(NULL AS VARCHAR) AS erreur FROM full_t GROUP BY code_ape
UNION ALL SELECT 'NO-SUCH-CODE', 0, 0, 'error', 'aucune donnée publiée'
UNION ALL SELECT 'TOTAL', (SELECT COUNT(*) FROM full_t), (SELECT COUNT(DISTINCT siren) FROM full_t),
       '1 en erreur sur ' || (1 + (SELECT COUNT(DISTINCT code_ape) FROM full_t)), NULL"""))
def s14_publish_all_codes_report(spark, d):
    full, _ = model.full(spark, d)
    path = _scratch(spark, "all-codes")
    publish(full.drop(*SALT_COLUMNS), path, "overwrite", ("code_ape",), ("departement",))
    back = spark.read.parquet(path)
    # the wanted codes, one of which has no data
    wanted = full.select("code_ape").distinct().unionByName(spark.createDataFrame([("NO-SUCH-CODE",)], "code_ape string"))
    return publish_report(wanted, back)


# Overwrite vs append, dynamic partition overwrite ------------------------------------
@query("s12_write_modes", with_model("""
SELECT code_ape, COUNT(*) AS nb_lignes FROM (
  SELECT code_ape FROM full_t
  UNION ALL SELECT code_ape FROM full_t WHERE code_ape = 'BUILDING') t GROUP BY code_ape"""))
def s12_write_modes(spark, d):
    full, _ = model.full(spark, d)
    full = full.drop(*SALT_COLUMNS)
    path = _scratch(spark, "modes")
    publish(full, path, "overwrite", ("code_ape",), ("departement",))
    one = full.where(F.col("code_ape") == model.FOCUS_CODE)
    publish(one, path, "overwrite", ("code_ape",))      # replaces only that partition
    publish(one, path, "append", ("code_ape",))         # then adds its rows again
    return spark.read.parquet(path).groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_lignes"))


# Final export with drop + rename ------------------------------------------------------
@query("s15_final_export", with_model("""
SELECT siret AS id_etablissement, siren AS id_entreprise, departement AS code_departement,
       nb_etablissements AS nombre_sites FROM full_t"""))
def s15_final_export(spark, d):
    full, _ = model.full(spark, d)
    sel = full.select("siret", "siren", "departement", "nb_etablissements", "dept_anomaly", "__salt", "__heavy")
    path = _scratch(spark, "export")
    export_final(sel, path, drop=["dept_anomaly", *SALT_COLUMNS],
                 rename={"siret": "id_etablissement", "siren": "id_entreprise", "departement": "code_departement",
                         "nb_etablissements": "nombre_sites"})
    return spark.read.parquet(path)


# Dimension CSVs --------------------------------------------------------------
def _dims_to_csv(spark, d):
    root = _scratch(spark, "dims")
    dims = model.dimensions(spark, d)
    files = {}
    for name in ("dim_departements", "dim_codes_ape", "dim_categories_effectifs", "dim_categories_juridiques",
                 "dim_anciennete"):
        df = dims[name]
        if name == "dim_codes_ape":  # the source file has a blank column before the score
            df = df.select(*[c for c in df.columns if c != "score_priorite"], F.lit(None).cast("string").alias("_blank"),
                           "score_priorite")
        p = os.path.join(root, name)
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(p)
        files[name] = p
    return files


@query("s4_read_dimension_csv", with_model("SELECT dep, dep_name, population_2022, profil_territorial FROM dim_departements"))
def s4_read_dimension_csv(spark, d):
    files = _dims_to_csv(spark, d)
    return read_dimension_csv(spark, files["dim_departements"], schemas.DIM_DEPARTEMENTS) \
        .select("dep", "dep_name", "population_2022", "profil_territorial")


@query("s5_load_all_dimensions", with_model("""
SELECT 'dim_departements' AS table_name, COUNT(*) AS nb_lignes, 'success' AS statut FROM dim_departements
UNION ALL SELECT 'dim_codes_ape', COUNT(*), 'success' FROM dim_codes_ape
UNION ALL SELECT 'dim_categories_effectifs', COUNT(*), 'success' FROM dim_categories_effectifs
UNION ALL SELECT 'dim_categories_juridiques', COUNT(*), 'success' FROM dim_categories_juridiques
UNION ALL SELECT 'dim_anciennete', COUNT(*), 'success' FROM dim_anciennete"""))
def s5_load_all_dimensions(spark, d):
    files = _dims_to_csv(spark, d)
    dims = {name: read_dimension_csv(spark, p, schemas.DIMENSION_SCHEMAS[name]) for name, p in files.items()}
    return load_dimensions(dims, _scratch(spark, "warehouse"))


@query("s6_force_string_schema", """
SELECT CAST(n_nationkey AS VARCHAR) AS categorie_juridique_ul_niv2, n_name AS famille_juridique FROM nation""")
def s6_force_string_schema(spark, d):
    n = read_table(spark, d, "nation").select(F.col("n_nationkey").cast("double").alias("categorie_juridique_ul_niv2"),
                                              F.col("n_name").alias("famille_juridique"))
    return force_string_schema(n)


# Raw write, manifest, freshness, outcomes ---------------------------
_REF_TS = "2024-03-01 00:00:00"


def _manifest_case(spark, d):
    """Codes of the model and an extraction history built from the data: one
    attempt per (code, month of the customers' orders)."""
    root = _scratch(spark, "manifest")
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("code_ape"), "o_orderkey",
                                                      "o_orderdate")
    # attempts: one per code and order year, dated by the latest order of the year shifted into the
    # reference period; the status depends on the year
    att = (j.groupBy("code_ape", F.year("o_orderdate").alias("y"))
           .agg(F.count(F.lit(1)).alias("nb_etablissements"), F.max("o_orderdate").alias("last"))
           .select("code_ape", (F.col("last").cast("timestamp") + F.expr("INTERVAL 8400 DAYS")).alias("extraction_date"),
                   F.when(F.col("y") % 3 == 0, F.lit(mf.PARTIAL)).otherwise(F.lit(mf.COMPLETED)).alias("status"),
                   "nb_etablissements"))
    mf.append_manifest(att, os.path.join(root, "manifest"))
    return root, j


@query("s17_manifest_latest", """
SELECT code_ape, extraction_date, status, nb_etablissements FROM (
  SELECT code_ape, CAST(last AS TIMESTAMP) + INTERVAL 8400 DAYS AS extraction_date,
         CASE WHEN y % 3 = 0 THEN 'partial' ELSE 'completed' END AS status, nb_etablissements,
         row_number() OVER (PARTITION BY code_ape ORDER BY CAST(last AS TIMESTAMP) DESC) AS rn
  FROM (SELECT c_mktsegment AS code_ape, year(o_orderdate) AS y, COUNT(*) AS nb_etablissements,
               MAX(o_orderdate) AS last
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) a) b WHERE rn = 1""")
def s17_manifest_latest(spark, d):
    root, _ = _manifest_case(spark, d)
    return mf.latest_per_code(mf.read_manifest(spark, os.path.join(root, "manifest")))


def _fresh(spark, d):
    root, j = _manifest_case(spark, d)
    latest = mf.latest_per_code(mf.read_manifest(spark, os.path.join(root, "manifest")))
    codes = j.select("code_ape").distinct().unionByName(spark.createDataFrame([("NEW-CODE",)], "code_ape string"))
    # data present for every code but one
    present = j.select("code_ape").distinct().where(F.col("code_ape") != "HOUSEHOLD")
    return mf.freshness(codes, latest, present, F.lit(_REF_TS).cast("timestamp"), 30)


_FRESH_SQL = f"""
WITH latest AS (
  SELECT code_ape, extraction_date, status FROM (
    SELECT code_ape, CAST(last AS TIMESTAMP) + INTERVAL 8400 DAYS AS extraction_date,
           CASE WHEN y % 3 = 0 THEN 'partial' ELSE 'completed' END AS status,
           row_number() OVER (PARTITION BY code_ape ORDER BY CAST(last AS TIMESTAMP) DESC) AS rn
    FROM (SELECT c_mktsegment AS code_ape, year(o_orderdate) AS y, MAX(o_orderdate) AS last
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) a) b WHERE rn = 1),
codes AS (SELECT DISTINCT c_mktsegment AS code_ape FROM orders JOIN customer ON o_custkey = c_custkey
          UNION ALL SELECT 'NEW-CODE'),
j AS (SELECT c.code_ape, c.code_ape <> 'HOUSEHOLD' AND c.code_ape <> 'NEW-CODE' AS present,
             l.code_ape IS NOT NULL AS meta, l.status, l.extraction_date,
             CAST(floor(epoch_us(TIMESTAMP '{_REF_TS}' - l.extraction_date) / 86400000000.0) AS INTEGER) AS age
      FROM codes c LEFT JOIN latest l ON c.code_ape = l.code_ape),
dec AS (
  SELECT code_ape,
    CASE WHEN NOT present THEN TRUE WHEN NOT meta THEN TRUE WHEN status = 'partial' THEN TRUE
         WHEN extraction_date IS NULL THEN TRUE WHEN age > 30 THEN TRUE ELSE FALSE END AS should_extract,
    CASE WHEN NOT present THEN '{mf.R_NO_FILE}' WHEN NOT meta THEN '{mf.R_NO_META}'
         WHEN status = 'partial' THEN '{mf.R_PARTIAL}' WHEN extraction_date IS NULL THEN '{mf.R_BAD_DATE.replace("'", "''")}'
         WHEN age > 30 THEN 'Données anciennes (' || age || 'j > 30j)'
         ELSE 'Données récentes (' || age || 'j)' END AS reason
  FROM j)"""


@query("s18_freshness_gate", _FRESH_SQL + "\nSELECT * FROM dec")
def s18_freshness_gate(spark, d):
    return _fresh(spark, d)


@query("s19_extraction_outcomes", _FRESH_SQL + """,
res AS (SELECT c_mktsegment AS code_ape, COUNT(*) AS nb_extraits FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1),
o AS (SELECT d.code_ape, CASE WHEN NOT d.should_extract THEN 'skipped'
                              WHEN COALESCE(r.nb_extraits, 0) <= 0 THEN 'errors'
                              WHEN d.reason LIKE 'Données anciennes%' THEN 'updated' ELSE 'success' END AS outcome
      FROM dec d LEFT JOIN res r ON d.code_ape = r.code_ape)
SELECT outcome, COUNT(*) AS nb_codes, array_to_string(list_sort(list(code_ape)), ',') AS codes FROM o GROUP BY outcome""")
def s19_extraction_outcomes(spark, d):
    dec = _fresh(spark, d)
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    # a code whose extraction returned nothing counts as an error
    res = (o.join(c, o.o_custkey == c.c_custkey).where(F.col("c_mktsegment") != "MACHINERY")
           .groupBy(F.col("c_mktsegment").alias("code_ape")).agg(F.count(F.lit(1)).alias("nb_extraits")))
    return mf.outcome_summary(dec, res)


@query("s9_raw_write_then_manifest", with_model("""
SELECT code_ape, 'completed' AS status, COUNT(*) AS nb_etablissements FROM full_t GROUP BY code_ape"""))
def s9_raw_write_then_manifest(spark, d):
    full, _ = model.full(spark, d)
    root = _scratch(spark, "raw")
    publish(full.drop(*SALT_COLUMNS), os.path.join(root, "raw"), "overwrite", ("code_ape",))
    # record completion only after the write succeeded, with counts read back from what was written
    written = spark.read.parquet(os.path.join(root, "raw")).groupBy("code_ape") \
        .agg(F.count(F.lit(1)).alias("nb_etablissements"))
    mf.append_manifest(written.select("code_ape", F.current_timestamp().alias("extraction_date"),
                                      F.lit(mf.COMPLETED).alias("status"), "nb_etablissements"),
                       os.path.join(root, "manifest"))
    return mf.read_manifest(spark, os.path.join(root, "manifest")).select("code_ape", "status", "nb_etablissements")


@query("s20_pipeline_report", with_model("""
SELECT code_ape, COUNT(*) AS nb_siret, COUNT(DISTINCT siren) AS nb_siren FROM full_t GROUP BY code_ape"""))
def s20_pipeline_report(spark, d):
    full, _ = model.full(spark, d)
    return full.groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_siret"), F.count_distinct("siren").alias("nb_siren"))


@query("s20_quarantine_malformed", f"""
SELECT COUNT(*) FILTER (WHERE {_pmod('o_orderkey', 97)} = 0) AS nb_quarantaine,
       COUNT(*) FILTER (WHERE {_pmod('o_orderkey', 97)} <> 0) AS nb_valides FROM orders""")
def s20_quarantine_malformed(spark, d):
    o = read_table(spark, d, "orders")
    path = _scratch(spark, "malformed")
    good = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("siret"),
                              F.col("o_custkey").cast("string").alias("siren")))
    line = F.when(F.pmod("o_orderkey", F.lit(97)) == 0, F.concat(F.lit('{"siret": '), F.col("o_orderkey").cast("string"),
                                                                 F.lit(", broken"))).otherwise(good)
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    df = read_raw_json(spark, path, flatten=False, corrupt_column="_corrupt_record")
    # (a query may not reference the corrupt-record column alone: siret is read too)
    bad = F.col("_corrupt_record").isNotNull() | F.col("siret").isNull()
    return df.agg(F.count(F.when(bad, F.lit(1))).alias("nb_quarantaine"),
                  F.count(F.when(~bad, F.lit(1))).alias("nb_valides"))


# ST1 / ST2 / ST3 -----------------------------------------------------------------------------
# Records of a landed file, at most: files are written and read by one task each.
_ROWS_PER_LANDING = 400_000


def _times(spark, d) -> int:
    """How many times as many files each landing and each trigger has as on a small table: the micro-batches
    stay as many (the rows are counted from the Parquet footers)."""
    return max(1, -(-read_table(spark, d, "orders").count() // _ROWS_PER_LANDING))


def _land(rows, path):
    """Pages land as compressed JSON lines."""
    with compiled_code(rows.sparkSession), freed_shuffles(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", "gzip").json(path)


def _land_pages(spark, d, landing, with_replays: bool):
    full, _ = model.full(spark, d)
    full = full.drop(*SALT_COLUMNS)
    n = _times(spark, d)
    _land(full.repartition(6 * n, "siret"), os.path.join(landing, "p1"))
    if with_replays:  # a re-extraction lands some records a second time
        _land(full.where(F.pmod("siret", F.lit(10)) == 0).repartition(2 * n), os.path.join(landing, "p2"))
    return full.schema


def _glob(landing):
    return os.path.join(landing, "*")


@query("st1_incremental_ingestion", with_model("SELECT siret, siren, code_ape FROM full_t"))
def st1_incremental_ingestion(spark, d):
    root = _scratch(spark, "st1")
    schema = _land_pages(spark, d, os.path.join(root, "landing"), False)
    sink = os.path.join(root, "raw")
    ingest_pages(spark, _glob(os.path.join(root, "landing")), schema, sink, os.path.join(root, "_ckpt"),
                 files_per_trigger=2 * _times(spark, d), flatten=False)
    # a second run finds nothing new: exactly once
    ingest_pages(spark, _glob(os.path.join(root, "landing")), schema, sink, os.path.join(root, "_ckpt"),
                 files_per_trigger=2 * _times(spark, d), flatten=False)
    return spark.read.parquet(sink).select("siret", "siren", "code_ape")


@query("st2_stream_dedup", with_model("SELECT siret, siren FROM full_t"))
def st2_stream_dedup(spark, d):
    root = _scratch(spark, "st2")
    schema = _land_pages(spark, d, os.path.join(root, "landing"), True)
    sink = os.path.join(root, "raw")
    # replays land after the originals; keyed on landing time they fall inside the watermark delay
    ingest_pages(spark, _glob(os.path.join(root, "landing")), schema, sink, os.path.join(root, "_ckpt"),
                 files_per_trigger=2 * _times(spark, d), flatten=False, dedup_key="siret")
    return spark.read.parquet(sink).select("siret", "siren")


# a backfilled file: its time is far before that of files read earlier, its records are new
@query("st2_late_file", with_model("SELECT siret, siren FROM full_t"))
def st2_late_file(spark, d):
    root = _scratch(spark, "st2-late")
    full = model.full(spark, d)[0].drop(*SALT_COLUMNS)
    landing, sink = f"{root}/landing", f"{root}/raw"
    part, n = F.pmod(F.xxhash64("siret"), F.lit(3)), _times(spark, d)
    for k, days in enumerate((0, 60, 0)):
        # each file repeats a few records of the one before
        rows = full.where((part == k) | ((part == k - 1) & (F.pmod("siret", F.lit(7)) == 0)))
        path = f"{landing}/p{k}"
        _land(rows.coalesce(n), path)
        _set_age(spark, path, days)
        ingest_pages(spark, f"{landing}/*", full.schema, sink, f"{root}/_ckpt", files_per_trigger=n, flatten=False, dedup_key="siret")
    return spark.read.parquet(sink).select("siret", "siren")


def _set_age(spark, folder: str, days: int) -> None:
    """Set the modification time of the files in ``folder`` to so many days ago."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    at = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - days * 86_400_000
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), at, -1)


# re-extractions 31 and 90 days later, each with a third of the records and with some new ones between
@query("st2_replay_after_the_delay", with_model("SELECT siret, siren FROM full_t"))
def st2_replay_after_the_delay(spark, d):
    """Keys are remembered in a table, not in a window of time: nothing that lands again is taken."""
    root = _scratch(spark, "st2-replay")
    full = model.full(spark, d)[0].drop(*SALT_COLUMNS)
    part, n = F.pmod(F.xxhash64("siret"), F.lit(3)), _times(spark, d)
    for k, days in enumerate((90, 59, 0)):            # ages of the files: 31 and 59 days between them
        rows = full.where((part == k) | ((part < k) & (F.pmod("siret", F.lit(3)) == 0)))
        _land(rows.coalesce(2 * n), f"{root}/landing/p{k}")
        _set_age(spark, f"{root}/landing/p{k}", days)
        ingest_pages(spark, _glob(f"{root}/landing"), full.schema, f"{root}/raw", f"{root}/_ckpt", files_per_trigger=4 * n,
                     flatten=False, dedup_key="siret", key_index=f"{root}/keys", buckets=8)
    return spark.read.parquet(f"{root}/raw").select("siret", "siren")


def _entity_scorer(dims):
    def score_entities(rows):
        # one salt plan per micro-batch: the site count and the entity mean are
        # windows over the same (siren, salt) partitioning
        plan = SaltPlan.for_fact(rows, ["siren"])
        base = group_size(rows.drop("nb_etablissements"), ["siren"], "nb_etablissements", salt_from=["siret"],
                          plan=plan, keep_salt=True)
        return views.scored_view(base, dims, plan, model.RETAINED_SEGMENTS).select(
            "siret", "siren", "nb_etablissements", "score_total", "score_moyen_siren", "segment_entreprise")
    return score_entities


_ACTIVE = "periode_etatAdministratifEtablissement = 'A'"
# What the scorer and the condition read of a record.
_SCORED_FROM = ("code_ape", "departement", "trancheEffectifsEtablissement", "uniteLegale_trancheEffectifsUniteLegale",
                "uniteLegale_categorieJuridiqueUniteLegaleNiv2", "periode_etatAdministratifEtablissement")


@query("st3_stream_scoring", with_model(
    "SELECT siret, siren, nb_etablissements, score_total, score_moyen_siren, segment_entreprise FROM scored"))
def st3_stream_scoring(spark, d):
    root = _scratch(spark, "st3")
    schema = _land_pages(spark, d, f"{root}/landing", True)
    _, _, dims = context(spark, d)
    score_stream(spark, _glob(f"{root}/landing"), schema, f"{root}/out", _entity_scorer(dims), active=_ACTIVE, reads=_SCORED_FROM,
                 files_per_trigger=4 * _times(spark, d), buckets=8)
    return latest_scored(spark, f"{root}/out")


def _moved_and_closed_sql() -> str:
    """The batch view on the final state: establishments with siret % 11 = 0 closed, those with
    siret % 13 = 0 moved to entity (siren * 7) % 1000 + 1 where there is one."""
    final = """
moves AS (SELECT s.siret, e.siren AS new_siren FROM active_siret s JOIN siren_t e ON e.siren = (s.siren * 7) % 1000 + 1
  WHERE s.siret % 13 = 0),
final_sites AS (SELECT s.* EXCLUDE (siren), COALESCE(m.new_siren, s.siren) AS siren FROM active_siret s
  LEFT JOIN moves m ON s.siret = m.siret WHERE s.siret % 11 <> 0 OR m.siret IS NOT NULL),
full_t AS (SELECT s.*, e.* EXCLUDE (siren, nb_etablissements), e.uniteLegale_activitePrincipaleUniteLegale AS code_ape,
  COUNT(*) OVER (PARTITION BY s.siren) AS nb_etablissements FROM final_sites s JOIN siren_t e ON s.siren = e.siren),
scored_base AS ("""
    sql = with_model("SELECT siret, siren, nb_etablissements, score_total, score_moyen_siren, segment_entreprise FROM scored")
    assert sql.count("full_t AS (") == 1 and sql.count("scored_base AS (") == 1
    return sql.replace("full_t AS (", "full_0 AS (").replace("\nscored_base AS (", final)


@query("st3_closed_and_moved", _moved_and_closed_sql())
def st3_closed_and_moved(spark, d):
    root = _scratch(spark, "st3-moves")
    full = model.full(spark, d)[0].drop(*SALT_COLUMNS)
    _, _, dims = context(spark, d)
    landing, n = f"{root}/landing", _times(spark, d)

    def land(rows, name):
        _land(rows.select(*full.columns).coalesce(2 * n), f"{landing}/{name}")
        score_stream(spark, f"{landing}/*", full.schema, f"{root}/out", _entity_scorer(dims), active=_ACTIVE, reads=_SCORED_FROM, files_per_trigger=8 * n, buckets=8)

    ent = model.siren_table(spark, d, model.raw_siret(spark, d).where(F.col("periode_etatAdministratifEtablissement") == "A"))
    moved = full.where(F.pmod("siret", F.lit(13)) == 0)
    target = ent.withColumn("code_ape", F.col("uniteLegale_activitePrincipaleUniteLegale"))
    sites = moved.drop(*[c for c in target.columns if c != "siren"]).withColumn("siren", F.pmod(F.col("siren") * 7, F.lit(1000)) + 1)
    moved = sites.join(target, "siren")
    closed = full.join(moved.select("siret"), "siret", "left_anti").where(F.pmod("siret", F.lit(11)) == 0) \
        .withColumn("periode_etatAdministratifEtablissement", F.lit("F"))
    land(full, "p1")
    land(moved.unionByName(full.where(F.pmod("siret", F.lit(17)) == 1).where(F.pmod("siret", F.lit(13)) != 0)), "p2")   # and some replays
    land(closed, "p3")
    return latest_scored(spark, f"{root}/out")


@query("st3_backfill_changes_nothing", _moved_and_closed_sql())
def st3_backfill_changes_nothing(spark, d):
    """Closed and moved establishments as above, then files that are 60 days old with the states of before: the result
    stays. The state's buckets are merged every second batch."""
    root = _scratch(spark, "st3-backfill")
    full = model.full(spark, d)[0].drop(*SALT_COLUMNS)
    _, _, dims = context(spark, d)
    landing, n = f"{root}/landing", _times(spark, d)

    def land(rows, name, days=0):
        _land(rows.select(*full.columns).coalesce(2 * n), f"{landing}/{name}")
        _set_age(spark, f"{landing}/{name}", days)
        score_stream(spark, f"{landing}/*", full.schema, f"{root}/out", _entity_scorer(dims), active=_ACTIVE, reads=_SCORED_FROM, files_per_trigger=8 * n,
                     buckets=8, compact_every=2)

    ent = model.siren_table(spark, d, model.raw_siret(spark, d).where(F.col("periode_etatAdministratifEtablissement") == "A"))
    target = ent.withColumn("code_ape", F.col("uniteLegale_activitePrincipaleUniteLegale"))
    sites = full.where(F.pmod("siret", F.lit(13)) == 0).drop(*[c for c in target.columns if c != "siren"]) \
        .withColumn("siren", F.pmod(F.col("siren") * 7, F.lit(1000)) + 1)
    moved = sites.join(target, "siren")
    closed = full.join(moved.select("siret"), "siret", "left_anti").where(F.pmod("siret", F.lit(11)) == 0) \
        .withColumn("periode_etatAdministratifEtablissement", F.lit("F"))
    land(full, "p1", 30)
    land(moved, "p2", 20)
    land(closed, "p3", 10)
    # the old states of all that moved or closed, and of others
    land(full.where((F.pmod("siret", F.lit(13)) == 0) | (F.pmod("siret", F.lit(11)) == 0) | (F.pmod("siret", F.lit(17)) == 1)), "p4", 60)
    return latest_scored(spark, f"{root}/out")


# Publish the three tables of one code with clustering, read back ---------------------------
@query("s13_publish_one_code", with_model(f"""
SELECT 'full' AS grain, COUNT(*) AS nb_lignes, COUNT(DISTINCT departement) AS nb_departements
FROM full_t WHERE code_ape = '{model.FOCUS_CODE}'
UNION ALL SELECT 'siret', COUNT(*), COUNT(DISTINCT departement) FROM full_t WHERE code_ape = '{model.FOCUS_CODE}'
UNION ALL SELECT 'siren', COUNT(*), CAST(NULL AS BIGINT) FROM siren_t
WHERE uniteLegale_activitePrincipaleUniteLegale = '{model.FOCUS_CODE}'"""))
def s13_publish_one_code(spark, d):
    siret, siren, full = _grains(spark, d)
    root = _scratch(spark, "one-code")
    one = lambda df: df.where(F.col("code_ape") == model.FOCUS_CODE)
    paths = save_split(one(siret), one(siren), one(full), root)
    out = []
    for grain in ("full", "siret", "siren"):
        back = read_partitioned(spark, paths[grain], model.FOCUS_CODE)
        deps = F.count_distinct("departement") if "departement" in back.columns else F.lit(None).cast("long")
        out.append(back.agg(F.count(F.lit(1)).alias("nb_lignes"), deps.alias("nb_departements"))
                   .select(F.lit(grain).alias("grain"), "nb_lignes", "nb_departements"))
    return out[0].unionByName(out[1]).unionByName(out[2])


# The registry batch pipeline on nested records ---------------------------------------
def _write_registry_records(spark, d, path):
    """Nested registry-shaped records built row by row from the model's
    establishments ⋈ customer: each carries a short state history (2 or 3
    periods, one of them a tie)."""
    raw = model.raw_siret(spark, d)
    c = read_table(spark, d, "customer")
    j = raw.join(c, raw.siren == c.c_custkey)
    day = F.date_format("dateCreationEtablissement", "yyyy-MM-dd")

    def period(date, etat):
        return F.struct(date.alias("dateDebut"), F.lit(None).cast("string").alias("dateFin"),
                        F.col("c_mktsegment").alias("activitePrincipaleEtablissement"),
                        etat.alias("etatAdministratifEtablissement"))
    hist = F.array(period(F.date_format(F.date_sub("dateCreationEtablissement", 400), "yyyy-MM-dd"), F.lit("F")),
                   period(day, F.col("periode_etatAdministratifEtablissement")))
    hist = F.when(F.pmod("siret", F.lit(5)) == 0, F.concat(hist, F.array(period(day, F.lit("X"))))).otherwise(hist)
    addr = F.struct(*[F.col(f"adresseEtablissement_{k}").alias(k) for k in
                      ("numeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement",
                       "codePostalEtablissement", "libelleCommuneEtablissement", "codeCommuneEtablissement",
                       "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement")])
    rec = j.select(
        F.col("siret").cast("string").alias("siret"), F.col("siren").cast("string").alias("siren"),
        day.alias("dateCreationEtablissement"), "trancheEffectifsEtablissement", "etablissementSiege",
        F.struct(F.col("uniteLegale_categorieJuridiqueUniteLegale").alias("categorieJuridiqueUniteLegale"),
                 F.col("c_name").alias("denominationUniteLegale"),
                 F.col("c_mktsegment").alias("activitePrincipaleUniteLegale")).alias("uniteLegale"),
        addr.alias("adresseEtablissement"), hist.alias("periodesEtablissement"))
    _land(rec.repartition(6 * _times(spark, d)), path)      # a compressed file is read by one task


@query("s20_registry_pipeline", with_model("""
SELECT code_ape, COUNT(*) AS nb_siret, COUNT(DISTINCT siren) AS nb_siren,
       COUNT(CASE WHEN dept_anomaly THEN 1 END) AS nb_anomalies_dept,
       COUNT(CASE WHEN nb_etablissements > 1 THEN 1 END) AS nb_siret_multi_sites
FROM full_t GROUP BY code_ape"""))
def s20_registry_pipeline(spark, d):
    from . import cleaning
    path = _scratch(spark, "registry")
    _write_registry_records(spark, d, path)
    out = cleaning.run(read_raw_json(spark, path), model.REF_DATE, model.RETAINED_SEGMENTS)
    return (out["full"].groupBy("code_ape")
            .agg(F.count(F.lit(1)).alias("nb_siret"), F.count_distinct("siren").alias("nb_siren"),
                 F.count(F.when(F.col("dept_anomaly"), F.lit(1))).alias("nb_anomalies_dept"),
                 F.count(F.when(F.col("nb_etablissements") > 1, F.lit(1))).alias("nb_siret_multi_sites")))


_FAILING = "MACHINERY"


_REJECTED = f"(siret % 97 = 0 OR (code = '{_FAILING}' AND siret % 3 <> 0))"


@query("s20_report_by_code", with_model(f"""
SELECT * FROM (WITH
landed AS (SELECT o_orderkey AS siret, c_mktsegment AS code FROM orders JOIN customer ON o_custkey = c_custkey),
counted AS (SELECT code, COUNT(*) AS lus, COUNT(*) FILTER (WHERE {_REJECTED}) AS nb_rejets FROM landed GROUP BY code
  UNION ALL SELECT 'NO-SUCH-CODE', 0, 0),
kept AS (SELECT code_ape, COUNT(*) AS nb_siret, COUNT(DISTINCT siren) AS nb_siren FROM full_t
  WHERE siret % 97 <> 0 AND code_ape <> '{_FAILING}' GROUP BY code_ape),
by_code AS (SELECT code, nb_rejets, COALESCE(nb_siret, 0) AS nb_siret, COALESCE(nb_siren, 0) AS nb_siren,
  CASE WHEN lus = 0 THEN 'aucune donnée' WHEN nb_rejets > lus * 0.5 THEN nb_rejets || ' enregistrements rejetés sur ' || lus
       WHEN COALESCE(nb_siret, 0) = 0 THEN 'aucun établissement actif' END AS erreur
  FROM counted LEFT JOIN kept ON code_ape = code)
SELECT code AS code_ape, erreur IS NULL AS success, erreur, nb_siret, nb_siren, nb_rejets FROM by_code
UNION ALL SELECT 'TOTAL', COUNT(erreur) = 0, COUNT(erreur) || ' en erreur sur ' || COUNT(*), CAST(SUM(nb_siret) AS BIGINT),
  CAST(SUM(nb_siren) AS BIGINT), CAST(SUM(nb_rejets) AS BIGINT) FROM by_code) report"""))
def s20_report_by_code(spark, d):
    """Records landed by code, a few lines of each broken, most of one code's, and a wanted code without any."""
    from . import cleaning
    root = _scratch(spark, "by-code")
    _write_registry_records(spark, d, f"{root}/records")
    records = spark.read.text(f"{root}/records")
    siret = F.get_json_object("value", "$.siret").cast("long")
    code = F.get_json_object("value", "$.uniteLegale.activitePrincipaleUniteLegale")
    broken = (F.pmod(siret, F.lit(97)) == 0) | ((code == _FAILING) & (F.pmod(siret, F.lit(3)) != 0))
    lines = records.select(F.when(broken, F.concat(F.substring("value", 1, 40), F.lit("..."))).otherwise(F.col("value")).alias("value"),
                           code.alias("code_extraction"))
    lines.write.partitionBy("code_extraction").option("compression", "gzip").text(f"{root}/landing")
    flat = read_raw_json(spark, f"{root}/landing", corrupt_column="_corrupt_record")
    wanted = lines.select(F.col("code_extraction").alias("code_ape")).distinct() \
        .unionByName(spark.createDataFrame([("NO-SUCH-CODE",)], "code_ape string"))
    _, report = cleaning.run_by_code(flat, wanted, model.REF_DATE, model.RETAINED_SEGMENTS)
    return report


# V1 on the published table: the production path -----------------------------------------------
@query("v1_on_published_full", with_model("SELECT * FROM scored"))
def v1_on_published_full(spark, d):
    """Publish the grains, then score from the published ``full`` table: partition
    pruning on the retained codes, column pruning, heavy keys from one counting
    pass, the entity mean as a salted window."""
    _, _, dims = context(spark, d)
    paths, root = _published(spark, d)
    full = read_processed(spark, root, "full")
    return views.scored_view(full, dims, None, model.RETAINED_SEGMENTS)
