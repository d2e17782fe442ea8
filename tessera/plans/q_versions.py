"""Rule versions and named result sets (X11..X18, V2..V7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.analytics import count_if, top_k_per_group
from ..operators.cascade import ScoreSet
from ..rules import scoring
from . import model, views
from .catalog import query
from .oracle import _scored_sql, dims_ctes, full_sql, raw_siret_sql, with_model
from .q_analytics import focus_counts
from .q_core import context, v1

H = "CAST(100 AS DOUBLE)"


def v2(spark, d):
    return views.single_code_view(model.enriched_full(spark, d), context(spark, d)[2], model.FOCUS_CODE)


@query("v2_single_code_view", with_model("SELECT * FROM v2", versions=("1.6", "v2")))
def v2_single_code_view(spark, d):
    return v2(spark, d)


@query("x11_score_100_points", with_model("""
SELECT score_territoire, score_taille, score_juridique, score_total, categorie_potentiel, COUNT(*) AS nb_lignes
FROM v2 GROUP BY ALL""", versions=("1.6", "v2")))
def x11_score_100_points(spark, d):
    return (v2(spark, d).groupBy("score_territoire", "score_taille", "score_juridique", "score_total",
                                 "categorie_potentiel").agg(F.count(F.lit(1)).alias("nb_lignes")))


# X12 ------------------------------------------------------------------------------
@query("x12_territory_only_score", with_model(f"""
SELECT d.dep, d.profil_territorial, {scoring.TERRITORY_ONLY.sql()}, COUNT(*) AS nb_lignes
FROM full_t f JOIN dim_departements d ON f.departement = d.dep
WHERE f.code_ape = '{model.FOCUS_CODE}' GROUP BY ALL"""))
def x12_territory_only_score(spark, d):
    counts, _ = focus_counts(spark, d)
    return (scoring.TERRITORY_ONLY.apply(counts).groupBy("dep", "profil_territorial", "score_territoire")
            .agg(F.sum("nb").alias("nb_lignes")))


# X13..X17: flag versions ------------------------------------------------------------
def _flag_counts(v, flags):
    # one aggregate an entity gives both counts: no row is expanded for the distinct ones
    names = [n for n, _ in flags.flags]
    per = v.groupBy("siren").agg(F.count(F.lit(1)).alias("n"), *[count_if(F.col(n)).alias(n) for n in names])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.agg(total("n").alias("nb_lignes"), *[total(n).alias(f"nb_{n}") for n in names],
                   *[F.count(F.when((F.col(n) > 0) & F.col("siren").isNotNull(), F.lit(1))).alias(f"nb_siren_{n}") for n in names])


def _flag_sql(version, flags):
    names = [n for n, _ in flags.flags]
    tbl = "scored_v" + version.replace(".", "")
    cols = ", ".join([f"COUNT(CASE WHEN {n} THEN 1 END) AS nb_{n}" for n in names]
                     + [f"COUNT(DISTINCT CASE WHEN {n} THEN siren END) AS nb_siren_{n}" for n in names])
    return with_model(f"SELECT COUNT(*) AS nb_lignes, {cols} FROM {tbl}", versions=(version,))


for _qid, _ver in (("x13_rules_v11", "1.1"), ("x14_rules_v12", "1.2"), ("x15_rules_v13", "1.3"),
                   ("x16_rules_v14", "1.4"), ("x17_rules_v15_exclusive", "1.5")):
    _flags = scoring.VERSIONS[_ver][1]

    def _make(ver=_ver, flags=_flags):
        def fn(spark, d):
            return _flag_counts(v1(spark, d, ver), flags)
        fn.__name__ = f"rules_{ver.replace('.', '')}"
        return fn
    query(_qid, _flag_sql(_ver, _flags))(_make())


@query("x13_size_map_v11", with_model(
    "SELECT code_effectifs_etablissement, score_taille_entreprise, COUNT(*) AS nb_lignes FROM scored_v11 GROUP BY ALL",
    versions=("1.1",)))
def x13_size_map_v11(spark, d):
    return (v1(spark, d, "1.1").groupBy("code_effectifs_etablissement", "score_taille_entreprise")
            .agg(F.count(F.lit(1)).alias("nb_lignes")))


# Documented variant of the points -----------------------------------------------
def _readme_sql() -> str:
    rv = scoring.README_VARIANT
    return with_model(f"""
SELECT score_total_doc, COUNT(*) AS nb_lignes FROM (
  SELECT {rv.total_sql()} AS score_total_doc FROM (
    SELECT {", ".join(rv.sql_columns())} FROM scored_base) a) b GROUP BY 1""")


@query("x18_readme_variant", _readme_sql())
def x18_readme_variant(spark, d):
    full, plan, dims = context(spark, d)
    base = views.scoring_base(full, dims, model.RETAINED_SEGMENTS)
    rv: ScoreSet = scoring.README_VARIANT
    s = ScoreSet(rv.dimensions, "score_total_doc").apply(base)
    return s.groupBy("score_total_doc").agg(F.count(F.lit(1)).alias("nb_lignes"))


# V3: premium subset ----------------------------------------------------------------------
_PREMIUM = ("Multi-Sites Qualifiés", "Premium Mono-Site")


@query("v3_premium_view", with_model(
    "SELECT siret, siren, nom_entreprise, code_departement, segment_entreprise, score_total, score_moyen_siren "
    f"FROM scored WHERE segment_entreprise IN ({', '.join(repr(s) for s in _PREMIUM)})"))
def v3_premium_view(spark, d):
    return (v1(spark, d).where(F.col("segment_entreprise").isin(*_PREMIUM))
            .select("siret", "siren", "nom_entreprise", "code_departement", "segment_entreprise", "score_total",
                    "score_moyen_siren"))


# V4: key accounts at entity grain -------------------------------------------------------
@query("v4_key_accounts", with_model("""
SELECT siren, MIN(nom_entreprise) AS nom_entreprise, COUNT(*) AS nb_sites, COUNT(DISTINCT code_departement) AS nb_departements,
       MIN(score_total) AS score_min, MAX(score_total) AS score_max, AVG(score_total) AS score_moyen
FROM scored WHERE segment_entreprise = 'Grands Comptes' GROUP BY siren"""))
def v4_key_accounts(spark, d):
    return (v1(spark, d).where(F.col("segment_entreprise") == "Grands Comptes").groupBy("siren")
            .agg(F.min("nom_entreprise").alias("nom_entreprise"), F.count(F.lit(1)).alias("nb_sites"),
                 F.count_distinct("code_departement").alias("nb_departements"),
                 F.min("score_total").alias("score_min"), F.max("score_total").alias("score_max"),
                 F.avg("score_total").alias("score_moyen")))


# V5: territory statistics by department --------------------------------------------------
@query("v5_territory_stats", with_model(f"""
SELECT s.code_departement, d.profil_territorial, COUNT(*) AS nb_etablissements,
       COUNT(CASE WHEN s.segment_priorite <= 5 THEN 1 END) AS nb_cibles, AVG(s.score_total) AS score_moyen,
       COUNT(*) / d.population_2022 * 10000.0 AS densite_pour_10k_hab
FROM scored s JOIN dim_departements d ON s.code_departement = d.dep
GROUP BY s.code_departement, d.profil_territorial, d.population_2022"""))
def v5_territory_stats(spark, d):
    _, _, dims = context(spark, d)
    v = v1(spark, d)
    dep = (F.broadcast if "dim_departements" in dims["__checked__"] else lambda x: x)(dims["dim_departements"].select("dep", F.col("profil_territorial").alias("profil"),
                                                      "population_2022"))
    j = v.join(dep, v.code_departement == dep.dep, "inner")
    return (j.groupBy("code_departement", F.col("profil").alias("profil_territorial"), "population_2022")
            .agg(F.count(F.lit(1)).alias("nb_etablissements"), count_if(F.col("segment_priorite") <= 5).alias("nb_cibles"),
                 F.avg("score_total").alias("score_moyen"))
            .withColumn("densite_pour_10k_hab",
                        F.try_divide(F.col("nb_etablissements"), F.col("population_2022")) * F.lit(10000.0))
            .drop("population_2022"))


# V6: migration v1.5 -> v1.6 ----------------------------------------------------------------
def _v15_label_sql() -> str:
    return scoring.V15_SEGMENT.sql()


@query("v6_version_migration", "WITH " + ",".join([dims_ctes(), raw_siret_sql(), full_sql(), _scored_sql("1.6", "scored"),
                                                   _scored_sql("1.5", "scored_v15")]) + f"""
SELECT a.segment_v15, b.segment_entreprise, COUNT(*) AS nb_etablissements, COUNT(DISTINCT b.siren) AS nb_entreprises
FROM (SELECT siret, {_v15_label_sql()} FROM scored_v15) a
FULL OUTER JOIN scored b ON a.siret = b.siret
GROUP BY a.segment_v15, b.segment_entreprise""")
def v6_version_migration(spark, d):
    # Both versions score the same rows: apply both rule sets to one scored
    # frame instead of scoring twice and joining on siret (no fact join).
    v = v1(spark, d)
    both = scoring.V15_SEGMENT.apply(scoring.FLAGS_V15.apply(v))
    return (both.groupBy("segment_v15", "segment_entreprise")
            .agg(F.count(F.lit(1)).alias("nb_etablissements"), F.count_distinct("siren").alias("nb_entreprises")))


# V7: fresh targets, top k per segment ------------------------------------------------------
@query("v7_top_targets_per_segment", with_model("""
SELECT segment_entreprise, siret, score_total, rang FROM (
  SELECT segment_entreprise, siret, score_total,
         CAST(row_number() OVER (PARTITION BY segment_entreprise ORDER BY score_total DESC, siret) AS INTEGER) AS rang
  FROM scored) t WHERE rang <= 5"""))
def v7_top_targets_per_segment(spark, d):
    v = v1(spark, d).select("segment_entreprise", "siret", "score_total")
    return top_k_per_group(v, ["segment_entreprise"], 5, [F.col("score_total").desc(), F.col("siret")],
                           salt_from=["siret"])


# P25: wide renaming projection of the single-code view ---------------------------------------
@query("p25_wide_renaming_projection", with_model("SELECT * EXCLUDE (score_territoire, score_taille, score_juridique, "
                                                  "score_total, categorie_potentiel) FROM v2", versions=("1.6", "v2")))
def p25_wide_renaming_projection(spark, d):
    return v2(spark, d).select(*[name for _, name in views.SINGLE_CODE_COLUMNS])
