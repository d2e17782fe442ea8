"""Core queries: the scored view, its score dimensions and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.groups import attach_group_stats, group_size
from ..operators.groups import SALT_COLUMNS
from . import model, views
from .catalog import query
from .oracle import with_model


def context(spark: SparkSession, d: str):
    full, plan = model.full(spark, d)
    return full, plan, model.dimensions(spark, d)


def v1(spark: SparkSession, d: str, version: str = "1.6") -> DataFrame:
    def build():
        full, plan, dims = context(spark, d)
        return views.scored_view(full, dims, plan, model.RETAINED_SEGMENTS, version)
    return model.memo(spark, ("v1", d, version), build)


def scored_rows(spark: SparkSession, d: str) -> DataFrame:
    """The scored establishments (v1.6) without the entity mean and what follows from it: no
    window, no second pass. For everything that reads neither the mean nor the segment."""
    def build():
        full, _, dims = context(spark, d)
        return views.score(views.scoring_base(full, dims, model.RETAINED_SEGMENTS)).drop(*SALT_COLUMNS)
    return model.memo(spark, ("scored_rows", d), build)


# --- V1: the global scored view -------------------------------------------------

@query("v1_scored_view", with_model("SELECT * FROM scored"))
def v1_scored_view(spark, d):
    return v1(spark, d)


# --- A20: segment pyramid (the flagship) -----------------------------------------

def segment_pyramid(v: DataFrame) -> DataFrame:
    agg = (v.groupBy("segment_priorite", "segment_entreprise")
           .agg(F.count_distinct("siren").alias("nb_entreprises"),
                F.count(F.lit(1)).alias("nb_etablissements"),
                F.avg("score_total").alias("score_moyen")))
    tot = Window.partitionBy()  # over the 7 aggregated rows only
    return agg.select(
        "segment_priorite", "segment_entreprise", "nb_entreprises", "nb_etablissements",
        (F.col("nb_etablissements") / F.col("nb_entreprises")).alias("ratio"),
        (F.col("nb_entreprises") * F.lit(100.0) / F.sum("nb_entreprises").over(tot)).alias("pct_base"),
        "score_moyen")


@query("a20_segment_pyramid", with_model("""
SELECT segment_priorite, segment_entreprise, nb_entreprises, nb_etablissements,
       nb_etablissements / nb_entreprises AS ratio,
       nb_entreprises * 100.0 / SUM(nb_entreprises) OVER () AS pct_base, score_moyen
FROM (SELECT segment_priorite, segment_entreprise, COUNT(DISTINCT siren) AS nb_entreprises,
             COUNT(*) AS nb_etablissements, AVG(score_total) AS score_moyen
      FROM scored GROUP BY segment_priorite, segment_entreprise) t"""))
def a20_segment_pyramid(spark, d):
    return segment_pyramid(v1(spark, d))


# --- X1..X8: one distribution per score dimension ---------------------------------

def _dist(v: DataFrame, *cols: str, n: str = "nb_lignes") -> DataFrame:
    return v.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))


def _dist_sql(*cols: str, n: str = "nb_lignes") -> str:
    c = ", ".join(cols)
    return with_model(f"SELECT {c}, COUNT(*) AS {n} FROM scored GROUP BY {c}")


@query("x1_territory_score", _dist_sql("profil_territorial", "score_profil_territorial"))
def x1_territory_score(spark, d):
    return _dist(scored_rows(spark, d), "profil_territorial", "score_profil_territorial")


@query("x2_size_score", _dist_sql("code_effectifs_etablissement", "score_taille_entreprise"))
def x2_size_score(spark, d):
    return _dist(scored_rows(spark, d), "code_effectifs_etablissement", "score_taille_entreprise")


@query("x3_legal_score", _dist_sql("famille_juridique", "score_forme_juridique"))
def x3_legal_score(spark, d):
    return _dist(scored_rows(spark, d), "famille_juridique", "score_forme_juridique")


@query("x4_activity_score", _dist_sql("code_ape", "score_priorite", "score_potentiel_ape"))
def x4_activity_score(spark, d):
    return _dist(scored_rows(spark, d), "code_ape", "score_priorite", "score_potentiel_ape")


@query("x5_multi_site_bonus", _dist_sql("type_structure", "bonus_multi_agences"))
def x5_multi_site_bonus(spark, d):
    return _dist(scored_rows(spark, d), "type_structure", "bonus_multi_agences")


@query("x6_total_score", _dist_sql("score_total"))
def x6_total_score(spark, d):
    return _dist(scored_rows(spark, d), "score_total")


@query("x7_potential_category", _dist_sql("categorie_potentiel"))
def x7_potential_category(spark, d):
    return _dist(scored_rows(spark, d), "categorie_potentiel")


@query("x8_entity_mean_score", with_model(
    "SELECT siren, nb_etablissements, MIN(score_moyen_siren) AS score_moyen_siren FROM scored "
    "GROUP BY siren, nb_etablissements"))
def x8_entity_mean_score(spark, d):
    return (v1(spark, d).groupBy("siren", "nb_etablissements")
            .agg(F.min("score_moyen_siren").alias("score_moyen_siren")))


@query("x9_segment_cascade", _dist_sql("segment_entreprise"))
def x9_segment_cascade(spark, d):
    return _dist(v1(spark, d), "segment_entreprise")


@query("x10_segment_rank", _dist_sql("segment_priorite", "segment_entreprise"))
def x10_segment_rank(spark, d):
    return _dist(v1(spark, d), "segment_priorite", "segment_entreprise")


# --- J1 / W1: group size and entity mean as explicit operators ----------------------

@query("j1_group_size", with_model(
    "SELECT siret, siren, COUNT(*) OVER (PARTITION BY siren) AS nb_sites FROM active_siret"))
def j1_group_size(spark, d):
    s = model.with_geo(model.raw_siret(spark, d)).where(F.col("periode_etatAdministratifEtablissement") == "A")
    return group_size(s.select("siret", "siren"), ["siren"], "nb_sites", salt_from=["siret"])


@query("w1_entity_mean_window", with_model(
    "SELECT siret, siren, score_total, AVG(score_total) OVER (PARTITION BY siren) AS moyenne_siren FROM scored"))
def w1_entity_mean_window(spark, d):
    full, plan, dims = context(spark, d)
    s = views.score(views.scoring_base(full, dims, model.RETAINED_SEGMENTS))
    return attach_group_stats(s.select("siret", "siren", "score_total"), ["siren"],
                              {"moyenne_siren": F.avg("score_total")}, salt_from=["siret"])


# --- U1 / P7 / P23: union of retained codes, active filter, code tag ----------------

@query("u1_retained_codes_union", with_model(
    "SELECT code_ape, COUNT(*) AS nb_etablissements, COUNT(DISTINCT siren) AS nb_entreprises "
    "FROM scored GROUP BY code_ape"))
def u1_retained_codes_union(spark, d):
    return (scored_rows(spark, d).groupBy("code_ape")
            .agg(F.count(F.lit(1)).alias("nb_etablissements"), F.count_distinct("siren").alias("nb_entreprises")))


@query("p7_active_filter", with_model(
    "SELECT periode_etatAdministratifEtablissement AS etat, COUNT(*) AS nb_etablissements "
    "FROM geo_siret WHERE periode_etatAdministratifEtablissement = 'A' GROUP BY 1"))
def p7_active_filter(spark, d):
    s = model.raw_siret(spark, d)
    return (s.where(F.col("periode_etatAdministratifEtablissement") == "A")
            .groupBy(F.col("periode_etatAdministratifEtablissement").alias("etat"))
            .agg(F.count(F.lit(1)).alias("nb_etablissements")))


@query("p22_structure_type", _dist_sql("nb_etablissements", "type_structure"))
def p22_structure_type(spark, d):
    return _dist(scored_rows(spark, d), "nb_etablissements", "type_structure")


@query("p24_lookup_default", with_model(
    "SELECT code_ape, score_priorite, COALESCE(score_priorite, 10) AS score_defaut, "
    "COALESCE(score_priorite, 0) AS score_regle, COUNT(*) AS nb_etablissements FROM scored GROUP BY 1, 2"))
def p24_lookup_default(spark, d):
    return (scored_rows(spark, d).groupBy("code_ape", "score_priorite")
            .agg(F.count(F.lit(1)).alias("nb_etablissements"))
            .select("code_ape", "score_priorite",
                    F.coalesce("score_priorite", F.lit(10)).alias("score_defaut"),
                    F.coalesce("score_priorite", F.lit(0)).alias("score_regle"), "nb_etablissements"))


# --- J3: star join with one dimension in two roles -----------------------------------

@query("j3_star_join", with_model("""
SELECT code_departement, profil_territorial, code_effectifs_etablissement, libelle_effectifs_etablissement,
       code_effectifs_unite_legale, libelle_effectifs_unite_legale, famille_juridique, libelle_ape,
       COUNT(*) AS nb_etablissements
FROM scored GROUP BY ALL"""))
def j3_star_join(spark, d):
    cols = ["code_departement", "profil_territorial", "code_effectifs_etablissement",
            "libelle_effectifs_etablissement", "code_effectifs_unite_legale", "libelle_effectifs_unite_legale",
            "famille_juridique", "libelle_ape"]
    full, plan, dims = context(spark, d)
    base = views.scoring_base(full, dims, model.RETAINED_SEGMENTS)
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias("nb_etablissements"))


# --- S16: the view registered and queried by name -------------------------------------

@query("s16_register_view", with_model(
    "SELECT segment_entreprise, COUNT(*) AS nb_etablissements FROM scored GROUP BY 1"))
def s16_register_view(spark, d):
    v1(spark, d).createOrReplaceTempView("v_etablissements_global")
    return spark.sql("SELECT segment_entreprise, COUNT(*) AS nb_etablissements "
                     "FROM v_etablissements_global GROUP BY segment_entreprise")



# --- P23: constant tag per source, union of separately stored codes ----------------------

@query("p23_tag_and_union_sources", with_model(
    "SELECT code_ape, COUNT(*) AS nb_lignes FROM full_t GROUP BY code_ape"))
def p23_tag_and_union_sources(spark, d):
    """Per-code tables as the source stores them (no code column), each read as
    its own input, tagged with a literal code and unioned by name."""
    import os
    import uuid
    from functools import reduce

    from ..operators.groups import SALT_COLUMNS
    from ..session import scratch_path
    from ..sources.writers import publish
    full, _, _ = context(spark, d)
    root = scratch_path(spark, f"tessera-p23-{uuid.uuid4().hex[:12]}")
    publish(full.drop(*SALT_COLUMNS), root, "overwrite", ("code_ape",))
    # the partition values: one per code, a bounded list (works on any file system)
    codes = sorted(r[0] for r in spark.read.parquet(root).select("code_ape").distinct().collect())
    parts = [spark.read.parquet(os.path.join(root, f"code_ape={c}")).withColumn("code_ape", F.lit(c)) for c in codes]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("code_ape").agg(F.count(F.lit(1)).alias("nb_lignes"))


# --- J2: establishment ⟕ entity, left columns win -------------------------------------------

@query("j2_establishment_entity_join", with_model("""
SELECT s.siret, s.siren, e.uniteLegale_denominationUniteLegale, e.nb_etablissements
FROM active_siret s LEFT JOIN siren_t e ON s.siren = e.siren"""))
def j2_establishment_entity_join(spark, d):
    from ..operators.projection import left_join_keep_left
    s = model.with_geo(model.raw_siret(spark, d)).where(F.col("periode_etatAdministratifEtablissement") == "A")
    e = model.siren_table(spark, d, s)
    return left_join_keep_left(s.select("siret", "siren"), e.select("siren", "uniteLegale_denominationUniteLegale",
                                                                    "nb_etablissements"), "siren")


# --- W3: percent of total over an aggregate -------------------------------------------------

@query("w3_percent_of_total", with_model(
    "SELECT categorie_potentiel, COUNT(*) AS nb_lignes, COUNT(*) * CAST(100 AS DOUBLE) / SUM(COUNT(*)) OVER () "
    "AS pourcentage FROM scored GROUP BY categorie_potentiel"))
def w3_percent_of_total(spark, d):
    from ..operators.analytics import with_share
    agg = scored_rows(spark, d).groupBy("categorie_potentiel").agg(F.count(F.lit(1)).alias("nb_lignes"))
    return with_share(agg, "nb_lignes")


# --- W1 under skew: one entity owns a third of all establishments ------------------------

HOT_ROWS_PER_TASK = 1000   # small on purpose: the hot entity is split over many buckets


@query("w1_hot_entity_mean", with_model(f"""
SELECT siret, siren_chaud, score_taille, AVG(score_taille) OVER (PARTITION BY siren_chaud) AS moyenne_entite,
       COUNT(*) OVER (PARTITION BY siren_chaud) AS nb_sites
FROM (SELECT siret, CASE WHEN siret % 3 = 0 THEN 1 ELSE siren END AS siren_chaud,
             CAST(CASE trancheEffectifsEtablissement WHEN 'NN' THEN 0 WHEN '00' THEN 0 ELSE 1 END
               + length(trancheEffectifsEtablissement) AS INTEGER) AS score_taille
      FROM active_siret) t"""))
def w1_hot_entity_mean(spark, d):
    """Entity mean and size with a hot entity (every third establishment),
    computed by the salted window and its hot-key correction."""
    s = model.raw_siret(spark, d).where(F.col("periode_etatAdministratifEtablissement") == "A")
    band = F.col("trancheEffectifsEtablissement")
    s = s.select("siret", F.when(F.pmod("siret", F.lit(3)) == 0, F.lit(1).cast("bigint")).otherwise(F.col("siren"))
                 .alias("siren_chaud"),
                 (F.when(band.isin("NN", "00"), F.lit(0)).otherwise(F.lit(1)) + F.length(band)).alias("score_taille"))
    return attach_group_stats(s, ["siren_chaud"], {"moyenne_entite": F.avg("score_taille"),
                                                   "nb_sites": F.count(F.lit(1))},
                              salt_from=["siret"], rows_per_task=HOT_ROWS_PER_TASK)
