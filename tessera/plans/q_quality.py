"""Data-quality checks (Q1..Q11) over the model, each a DataFrame of
``(controle, valeur, attendu, statut)``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import (
    KO, MINOR, NO_DATA, OK, bounds_check, check, checks, coverage_checks, distribution_check, group_consistency_check,
    null_check,
    row_count_check, unique_key_check,
)
from ..operators.cascade import FlagSet
from ..rules import bands, scoring
from . import model
from .catalog import query
from .oracle import with_model
from .q_core import segment_pyramid, scored_rows, v1

H = "CAST(100 AS DOUBLE)"


def _status(ok: str, minor: str | None = None) -> str:
    m = f" WHEN {minor} THEN '{MINOR}'" if minor else ""
    return f"CASE WHEN {ok} THEN '{OK}'{m} ELSE '{KO}' END"


# Q1 -------------------------------------------------------------------------------
_Q1_COLS = ["profil_territorial", "famille_juridique", "libelle_ape"]
_Q1_T = 98.0


@query("q1_coverage_threshold", with_model(" UNION ALL ".join(
    f"SELECT 'couverture_{c}' AS controle, COUNT({c}) * {H} / COUNT(*) AS valeur, '>= {_Q1_T}' AS attendu, "
    f"{_status(f'COUNT({c}) * {H} / COUNT(*) >= {_Q1_T}')} AS statut FROM scored" for c in _Q1_COLS)))
def q1_coverage_threshold(spark, d):
    return coverage_checks(scored_rows(spark, d), _Q1_COLS, _Q1_T)


# Q2 -------------------------------------------------------------------------------
@query("q2_row_count_expected", with_model(f"""
SELECT 'lignes_vue' AS controle, CAST(a AS DOUBLE) AS valeur, CAST(e AS VARCHAR) AS attendu,
       {_status('a = e', 'abs(a - e) * 100.0 <= e * 1.0')} AS statut
FROM (SELECT (SELECT COUNT(*) FROM scored) AS a,
             (SELECT COUNT(*) FROM full_t WHERE code_ape IN
               ({', '.join(repr(c) for c in model.RETAINED_SEGMENTS)})) AS e) t"""))
def q2_row_count_expected(spark, d):
    full, _ = model.full(spark, d)
    expected = full.where(F.col("code_ape").isin(*model.RETAINED_SEGMENTS))
    return row_count_check(scored_rows(spark, d), expected, "lignes_vue")


# Q3 -------------------------------------------------------------------------------
@query("q3_score_bounds", with_model(f"""
SELECT 'bornes_score_total' AS controle,
       CAST(COUNT(CASE WHEN score_total < 25 OR score_total > 130 THEN 1 END)
            + COUNT(CASE WHEN score_total IS NULL THEN 1 END) AS DOUBLE) AS valeur,
       '[25.0, 130.0]' AS attendu,
       {_status('MIN(score_total) >= 25 AND MAX(score_total) <= 130 AND COUNT(CASE WHEN score_total IS NULL THEN 1 END) = 0 '
                'AND COUNT(CASE WHEN score_total < 25 OR score_total > 130 THEN 1 END) = 0')} AS statut
FROM scored"""))
def q3_score_bounds(spark, d):
    return bounds_check(scored_rows(spark, d), "score_total", 25.0, 130.0, "bornes_score_total")


# Q4: profile distribution against the expected one ---------------------------------------
# FIXED VALUES of the model: five nations per region, four profiled regions.
EXPECTED_PROFILES = tuple((p, 5) for p, _ in bands.TERRITORIAL_PROFILES)


@query("q4_profile_distribution", with_model(f"""
SELECT 'repartition_profils' AS controle, CAST(COUNT(*) AS DOUBLE) AS valeur, '0' AS attendu,
       {_status('COUNT(*) = 0')} AS statut
FROM ((SELECT profil_territorial, COUNT(*) AS n FROM dim_departements GROUP BY 1
       EXCEPT ALL SELECT * FROM (VALUES {', '.join(f"('{p}', {n})" for p, n in EXPECTED_PROFILES)}) v(p, n))
      UNION ALL
      (SELECT * FROM (VALUES {', '.join(f"('{p}', {n})" for p, n in EXPECTED_PROFILES)}) v(p, n)
       EXCEPT ALL SELECT profil_territorial, COUNT(*) AS n FROM dim_departements GROUP BY 1)) x"""))
def q4_profile_distribution(spark, d):
    exp = spark.createDataFrame(list(EXPECTED_PROFILES), "profil_territorial string, n long")
    return distribution_check(model.dim_departements(spark, d), "profil_territorial", exp, "repartition_profils")


# Q5: density bands per profile (a report: bands may fail on real data) -----------------
def _band_sql() -> str:
    arms = " ".join(f"WHEN profil_territorial = '{p}' THEN densite BETWEEN {lo} AND {hi}"
                    for p, lo, hi in bands.PROFILE_DENSITY_RANGE)
    rng = " ".join(f"WHEN profil_territorial = '{p}' THEN '[{lo}, {hi}]'" for p, lo, hi in bands.PROFILE_DENSITY_RANGE)
    return arms, rng


@query("q5_density_bands", with_model(f"""
SELECT 'densite_' || profil_territorial AS controle, densite AS valeur,
       CASE {_band_sql()[1]} END AS attendu,
       CASE WHEN CASE {_band_sql()[0]} END THEN '{OK}' ELSE '{KO}' END AS statut
FROM (SELECT d.profil_territorial,
        COUNT(DISTINCT f.siret) / (SELECT SUM(dd.population_2022) FROM dim_departements dd
          WHERE dd.profil_territorial = d.profil_territorial) * 10000.0 AS densite
      FROM full_t f JOIN dim_departements d ON f.departement = d.dep
      WHERE f.code_ape = '{model.FOCUS_CODE}' GROUP BY d.profil_territorial) t"""))
def q5_density_bands(spark, d):
    from .q_analytics import a6_density_by_profile
    a6 = a6_density_by_profile(spark, d)
    rng = spark.createDataFrame(list(bands.PROFILE_DENSITY_RANGE), "profil_territorial string, lo double, hi double")
    j = a6.join(F.broadcast(rng), "profil_territorial", "left")
    ok = F.col("densite_pour_10k_hab").between(F.col("lo"), F.col("hi"))
    return j.select(F.concat(F.lit("densite_"), F.col("profil_territorial")).alias("controle"),
                    F.col("densite_pour_10k_hab").alias("valeur"),
                    F.concat(F.lit("["), F.col("lo").cast("string"), F.lit(", "), F.col("hi").cast("string"), F.lit("]"))
                    .alias("attendu"),
                    F.when(ok, F.lit(OK)).otherwise(F.lit(KO)).alias("statut"))


# Q6: unique keys ---------------------------------------------------------------------------
@query("q6_unique_keys", with_model(" UNION ALL ".join(
    f"SELECT '{n}' AS controle, CAST(COUNT(*) AS DOUBLE) AS valeur, '0' AS attendu, "
    f"{_status('COUNT(*) = 0')} AS statut FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1) x"
    for n, k, t in (("unicite_siret", "siret", "full_t"), ("unicite_siren", "siren", "siren_t"),
                    ("unicite_dep", "dep", "dim_departements"),
                    ("unicite_lineitem", "l_orderkey, l_linenumber", "lineitem")))))
def q6_unique_keys(spark, d):
    full, _ = model.full(spark, d)
    active = model.raw_siret(spark, d).where(F.col("periode_etatAdministratifEtablissement") == "A")
    ent = model.siren_table(spark, d, active)
    from ..sources.readers import read_table
    return checks([unique_key_check(full, ["siret"], "unicite_siret"),
                   unique_key_check(ent, ["siren"], "unicite_siren"),
                   unique_key_check(model.dim_departements(spark, d), ["dep"], "unicite_dep"),
                   unique_key_check(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                                    "unicite_lineitem")])


# Q7: null critical columns ---------------------------------------------------------------
_Q7 = ["dateCreationEtablissement", "uniteLegale_dateCreationUniteLegale",
       "uniteLegale_categorieJuridiqueUniteLegaleNiv2", "departement"]


@query("q7_null_critical_columns", with_model(" UNION ALL ".join(
    f"SELECT 'nulls_{c}' AS controle, CAST(COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS DOUBLE) AS valeur, "
    f"'0' AS attendu, {_status(f'COUNT(CASE WHEN {c} IS NULL THEN 1 END) = 0')} AS statut FROM full_t" for c in _Q7)))
def q7_null_critical_columns(spark, d):
    full, _ = model.full(spark, d)
    return null_check(full, _Q7)


# Q8: flag overlap (exclusive v1.5 = 0; overlapping v1.4 reported) -----------------------------
def _overlap(version: str) -> str:
    names = [n for n, _ in scoring.VERSIONS[version][1].flags]
    s = " + ".join(f"CAST({n} AS INTEGER)" for n in names)
    tbl = "scored_v" + version.replace(".", "")
    ok = "COUNT(*) = 0" if version == "1.5" else "TRUE"
    return (f"SELECT 'chevauchement_v{version}' AS controle, CAST(COUNT(*) AS DOUBLE) AS valeur, "
            f"'{'0' if version == '1.5' else 'rapport'}' AS attendu, {_status(ok)} AS statut "
            f"FROM {tbl} WHERE {s} > 1")


@query("q8_flag_overlap", with_model(_overlap("1.5") + " UNION ALL " + _overlap("1.4"), versions=("1.4", "1.5")))
def q8_flag_overlap(spark, d):
    # v1.4 and v1.5 share the 130-point score: both flag sets on one scored frame
    v = v1(spark, d, "1.5")
    v14 = FlagSet(tuple((f"v14_{n}", p) for n, p in scoring.FLAGS_V14.flags))
    v = v14.apply(v)
    out = []
    for ver, names in (("1.5", [n for n, _ in scoring.FLAGS_V15.flags]), ("1.4", [n for n, _ in v14.flags])):
        n_flags = sum((F.col(n).cast("int") for n in names[1:]), F.col(names[0]).cast("int"))
        out.append(F.count(F.when(n_flags > 1, F.lit(1))).alias(f"__o{ver.replace('.', '')}"))
    agg = v.agg(*out)
    return checks([check(agg, "chevauchement_v1.5", F.col("__o15"), F.lit("0"), F.col("__o15") == 0),
                   check(agg, "chevauchement_v1.4", F.col("__o14"), F.lit("rapport"), F.lit(True))])


# Q9: one segment per entity ------------------------------------------------------------------
@query("q9_one_segment_per_entity", with_model(f"""
SELECT 'segment_unique_par_siren' AS controle, CAST(COUNT(*) AS DOUBLE) AS valeur, '0' AS attendu,
       {_status('COUNT(*) = 0')} AS statut
FROM (SELECT siren FROM scored GROUP BY siren HAVING COUNT(DISTINCT segment_entreprise) > 1) x"""))
def q9_one_segment_per_entity(spark, d):
    return group_consistency_check(v1(spark, d), "siren", "segment_entreprise", "segment_unique_par_siren")


# Q10: mono-site ratio of the premium mono-site segment ------------------------------------------
@query("q10_mono_site_ratio", with_model(f"""
SELECT 'ratio_premium_mono_site' AS controle, MAX(r) AS valeur, '1.0' AS attendu,
       CASE WHEN MAX(r) IS NULL THEN '{NO_DATA}' ELSE {_status('MAX(r) = 1.0')} END AS statut
FROM (SELECT COUNT(*) / NULLIF(COUNT(DISTINCT siren), 0) AS r FROM scored WHERE segment_entreprise = 'Premium Mono-Site') t"""))
def q10_mono_site_ratio(spark, d):
    pyr = segment_pyramid(v1(spark, d)).where(F.col("segment_entreprise") == "Premium Mono-Site")
    agg = pyr.agg(F.max("ratio").alias("__r"))
    return check(agg, "ratio_premium_mono_site", F.col("__r"), F.lit("1.0"), F.col("__r") == 1.0)


# Q11: reconciliation of the view with its sources ------------------------------------------------
@query("q11_reconciliation", with_model(f"""
SELECT 'categories_vs_total' AS controle, CAST(SUM(n) AS DOUBLE) AS valeur,
       CAST((SELECT COUNT(*) FROM scored) AS VARCHAR) AS attendu,
       {_status('SUM(n) = (SELECT COUNT(*) FROM scored)')} AS statut
FROM (SELECT categorie_potentiel, COUNT(*) AS n FROM scored GROUP BY 1) c
UNION ALL
SELECT 'segments_vs_entites' AS controle, CAST(SUM(n) AS DOUBLE) AS valeur,
       CAST((SELECT COUNT(DISTINCT siren) FROM scored) AS VARCHAR) AS attendu,
       {_status('SUM(n) = (SELECT COUNT(DISTINCT siren) FROM scored)')} AS statut
FROM (SELECT segment_entreprise, COUNT(DISTINCT siren) AS n FROM scored GROUP BY 1) s"""))
def q11_reconciliation(spark, d):
    # one aggregation pass over the view; every figure below reads its output
    g = (v1(spark, d).groupBy("siren", "segment_entreprise", "categorie_potentiel")
         .agg(F.count(F.lit(1)).alias("n")))
    cats = g.groupBy("categorie_potentiel").agg(F.sum("n").alias("n")).agg(F.sum("n").alias("__s"))
    tot = g.agg(F.sum("n").alias("__t"))
    ent = g.select("siren").distinct().agg(F.count(F.lit(1)).alias("__e"))
    segs = (g.select("segment_entreprise", "siren").distinct().groupBy("segment_entreprise")
            .agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("__g")))
    # one-row aggregates combined as scalar subqueries (no join)
    j = cats.select("__s", tot.scalar().alias("__t"), ent.scalar().alias("__e"), segs.scalar().alias("__g"))
    return checks([check(j, "categories_vs_total", F.col("__s"), F.col("__t"), F.col("__s") == F.col("__t")),
                   check(j, "segments_vs_entites", F.col("__g"), F.col("__e"), F.col("__g") == F.col("__e"))])
