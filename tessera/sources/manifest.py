"""Extraction manifest and freshness gate.

The manifest is an append-only table of extraction attempts
``(code_ape, extraction_date, status, nb_etablissements)``. The latest attempt
per code is an aggregate (``max_by``), the freshness decision a column
expression over codes ⟕ latest manifest ⟕ present data: no per-code loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

# FIXED VALUES: decision reasons (the age ones carry the numbers).
R_NO_FILE = "Fichier absent"
R_NO_META = "Métadonnées absentes"
R_PARTIAL = "Extraction incomplète (checkpoint)"
R_BAD_DATE = "Date d'extraction invalide"
COMPLETED, PARTIAL = "completed", "partial"


def append_manifest(rows: DataFrame, path: str) -> None:
    """Append attempts; only complete units should be recorded as ``completed``."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.MANIFEST.fields]) \
        .write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).parquet(path)


def latest_per_code(manifest: DataFrame) -> DataFrame:
    """Latest attempt per code (by extraction date; on a tie a completed one, then the one with more rows)."""
    m = manifest.groupBy("code_ape").agg(
        F.max_by(F.struct("extraction_date", "status", "nb_etablissements"),
                 F.struct("extraction_date", F.col("status") == COMPLETED, "nb_etablissements")).alias("m"))
    return m.select("code_ape", "m.extraction_date", "m.status", "m.nb_etablissements")


def freshness(codes: DataFrame, latest: DataFrame | None, present: DataFrame, ref_ts: Column,
              max_age_days: int = 30, raw_date: str | None = None) -> DataFrame:
    """Per code: ``should_extract`` and ``reason``, in the order file absent ->
    metadata absent -> partial -> unreadable date -> too old -> fresh.

    ``codes``: code_ape; ``present``: code_ape of codes whose data exists;
    ``latest``: latest manifest row per code (date may be a string column named
    by ``raw_date`` when it comes from a loosely typed source)."""
    p = present.select("code_ape", F.lit(True).alias("__present")).distinct()
    j = codes.select("code_ape").join(p, "code_ape", "left")
    if latest is not None:
        lat = latest.select("code_ape", F.lit(True).alias("__meta"), "status",
                            (F.col(raw_date) if raw_date else F.col("extraction_date")).alias("__d"))
        j = j.join(lat, "code_ape", "left")
    else:
        j = j.withColumns({"__meta": F.lit(None).cast("boolean"), "status": F.lit(None).cast("string"),
                           "__d": F.lit(None).cast("string")})
    d = F.expr("try_cast(__d AS TIMESTAMP)") if dict(j.dtypes)["__d"] == "string" else F.col("__d")
    age = F.floor((F.unix_micros(ref_ts) - F.unix_micros(d)) / F.lit(86_400_000_000)).cast("int")
    reason = (F.when(F.col("__present").isNull(), F.lit(R_NO_FILE))
              .when(F.col("__meta").isNull(), F.lit(R_NO_META))
              .when(F.col("status") == PARTIAL, F.lit(R_PARTIAL))
              .when(d.isNull(), F.lit(R_BAD_DATE))
              .when(age > max_age_days, F.format_string("Données anciennes (%dj > %dj)", age, F.lit(max_age_days)))
              .otherwise(F.format_string("Données récentes (%dj)", age)))
    should = (F.col("__present").isNull() | F.col("__meta").isNull() | (F.col("status") == PARTIAL)
              | d.isNull() | (age > max_age_days))
    return j.select("code_ape", F.coalesce(should, F.lit(True)).alias("should_extract"), reason.alias("reason"))


def publish_report(wanted: DataFrame, published: DataFrame) -> DataFrame:
    """Per wanted code: rows and entities read back, ``success`` or ``error`` with its reason;
    then one ``TOTAL`` row. A code without published rows is an error, not a missing line."""
    counts = published.groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_siret"), F.count_distinct("siren").alias("nb_siren"))
    rows = wanted.select("code_ape").distinct().join(counts, "code_ape", "left").fillna(0, ["nb_siret", "nb_siren"])
    failed = F.col("nb_siret") == 0
    rows = rows.withColumns({"statut": F.when(failed, F.lit("error")).otherwise(F.lit("success")),
                             "erreur": F.when(failed, F.lit("aucune donnée publiée"))})
    entities = published.join(wanted.select("code_ape").distinct(), "code_ape", "left_semi") \
        .agg(F.count_distinct("siren").alias("n"))
    total = rows.agg(F.sum("nb_siret").alias("nb_siret"), F.count(F.when(failed, F.lit(1))).alias("bad"), F.count(F.lit(1)).alias("all"))
    total = total.select(F.lit("TOTAL").alias("code_ape"), "nb_siret", entities.scalar().alias("nb_siren"),
                         F.format_string("%d en erreur sur %d", "bad", "all").alias("statut"), F.lit(None).cast("string").alias("erreur"))
    return rows.select(*total.columns).unionByName(total)


def outcome_summary(decisions: DataFrame, results: DataFrame, force: bool = False) -> DataFrame:
    """Extraction outcome per code (skipped / updated / success / errors) and
    the per-outcome code lists. ``results``: code_ape, nb_extraits (0 = error).
    The list per outcome is bounded by the number of codes."""
    j = decisions.join(results, "code_ape", "left")
    outcome = (F.when(~F.lit(force) & ~F.col("should_extract"), F.lit("skipped"))
               .when(F.coalesce(F.col("nb_extraits"), F.lit(0)) <= 0, F.lit("errors"))
               .when(F.col("reason").startswith("Données anciennes"), F.lit("updated"))
               .otherwise(F.lit("success")))
    return (j.withColumn("outcome", outcome).groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("nb_codes"), F.array_join(F.array_sort(F.collect_list("code_ape")), ",")
                 .alias("codes")))
