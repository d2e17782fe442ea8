"""The registry batch pipeline: raw nested records -> clean -> establishment and
entity grains -> geography and enrichment -> ``full`` (establishment ⟕ entity).

One lazy plan for all activity codes at once; the only fact shuffles are the
entity count (partial aggregation) and the establishment ⟕ entity join (salted
on the entity key). The active filter runs before the count, so
``nb_etablissements`` counts active establishments only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    age_band, age_years, department_from_commune, first_chars, headcount_category, latest_struct, sector_type,
    try_date, try_double,
)
from ..functions.geo import with_wgs84
from ..operators.groups import SALT_COLUMNS, SaltPlan, first_per_key
from ..operators.projection import select_tolerant, spread_struct
from ..operators.star import bounded
from ..rules import bands

# FIXED VALUES: the column allow-lists of the cleaning step, in the source's order
# (flattened names: dots became underscores).
USEFUL_COLUMNS = (
    "siret", "statutDiffusionEtablissement", "dateCreationEtablissement",
    "trancheEffectifsEtablissement", "anneeEffectifsEtablissement",
    "activitePrincipaleRegistreMetiersEtablissement", "periode_activitePrincipaleEtablissement",
    "etablissementSiege", "periode_etatAdministratifEtablissement",
    "siren", "uniteLegale_statutDiffusionUniteLegale", "uniteLegale_etatAdministratifUniteLegale",
    "uniteLegale_dateCreationUniteLegale", "uniteLegale_categorieJuridiqueUniteLegale",
    "uniteLegale_categorieJuridiqueUniteLegaleNiv2", "uniteLegale_denominationUniteLegale",
    "uniteLegale_sigleUniteLegale", "uniteLegale_denominationUsuelle1UniteLegale",
    "uniteLegale_activitePrincipaleUniteLegale", "uniteLegale_categorieEntreprise",
    "uniteLegale_trancheEffectifsUniteLegale", "uniteLegale_anneeEffectifsUniteLegale",
    "adresseEtablissement_numeroVoieEtablissement", "adresseEtablissement_typeVoieEtablissement",
    "adresseEtablissement_libelleVoieEtablissement", "adresseEtablissement_codePostalEtablissement",
    "adresseEtablissement_libelleCommuneEtablissement", "adresseEtablissement_codeCommuneEtablissement",
    "adresseEtablissement_coordonneeLambertAbscisseEtablissement",
    "adresseEtablissement_coordonneeLambertOrdonneeEtablissement",
    "adresseEtablissement_libellePaysEtrangerEtablissement",
)
SIRET_COLUMNS = (
    "siret", "siren", "statutDiffusionEtablissement", "dateCreationEtablissement",
    "trancheEffectifsEtablissement", "anneeEffectifsEtablissement",
    "activitePrincipaleRegistreMetiersEtablissement", "periode_activitePrincipaleEtablissement",
    "etablissementSiege", "periode_etatAdministratifEtablissement",
    "adresseEtablissement_numeroVoieEtablissement", "adresseEtablissement_typeVoieEtablissement",
    "adresseEtablissement_libelleVoieEtablissement", "adresseEtablissement_codePostalEtablissement",
    "adresseEtablissement_libelleCommuneEtablissement", "adresseEtablissement_codeCommuneEtablissement",
    "adresseEtablissement_coordonneeLambertAbscisseEtablissement",
    "adresseEtablissement_coordonneeLambertOrdonneeEtablissement",
    "adresseEtablissement_libellePaysEtrangerEtablissement",
)
SIREN_COLUMNS = (
    "siren", "uniteLegale_statutDiffusionUniteLegale", "uniteLegale_etatAdministratifUniteLegale",
    "uniteLegale_dateCreationUniteLegale", "uniteLegale_categorieJuridiqueUniteLegale",
    "uniteLegale_categorieJuridiqueUniteLegaleNiv2", "uniteLegale_denominationUniteLegale",
    "uniteLegale_sigleUniteLegale", "uniteLegale_denominationUsuelle1UniteLegale",
    "uniteLegale_activitePrincipaleUniteLegale", "uniteLegale_categorieEntreprise",
    "uniteLegale_trancheEffectifsUniteLegale", "uniteLegale_anneeEffectifsUniteLegale",
    "nb_etablissements",
)


def clean_raw(flat: DataFrame) -> DataFrame:
    """Legal prefix, latest period spread into ``periode_*``, allow-list
    (missing columns come back as typed nulls), active rows, tolerant dates."""
    df = flat.withColumn("uniteLegale_categorieJuridiqueUniteLegaleNiv2",
                         first_chars("uniteLegale_categorieJuridiqueUniteLegale", 2))
    if "periodesEtablissement" in df.columns:
        df = df.withColumn("__p", latest_struct("periodesEtablissement", "dateDebut"))
        df = spread_struct(df, "__p", "periode_")
    df = one_per_siret(select_tolerant(df, (*USEFUL_COLUMNS, "periode_dateDebut"))).drop("periode_dateDebut")
    df = df.where(F.col("periode_etatAdministratifEtablissement") == "A")
    return df.withColumns({"dateCreationEtablissement": try_date("dateCreationEtablissement"),
                           "uniteLegale_dateCreationUniteLegale": try_date("uniteLegale_dateCreationUniteLegale")})


def one_per_siret(df: DataFrame) -> DataFrame:
    """One record per SIRET: the one with the latest period, ties by a hash of the record
    (a record landed twice must not count as two sites). Partially aggregated."""
    rest = [c for c in df.columns if c != "siret"]
    order = F.struct(F.coalesce(F.col("periode_dateDebut").cast("string"), F.lit("")), F.xxhash64(*rest))
    return (df.groupBy("siret").agg(F.max_by(F.struct(*rest), order).alias("r"))
            .select("siret", *[F.col(f"r.{c}").alias(c) for c in rest]))


def quarantine(flat: DataFrame, corrupt_column: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Records that can be used, and those that can't: malformed lines and records without a SIRET."""
    bad = F.col("siret").isNull()
    if corrupt_column in flat.columns:
        bad = bad | F.col(corrupt_column).isNotNull()
    return flat.where(~bad).drop(corrupt_column), flat.where(bad)


def split_siret_siren(clean: DataFrame, siege_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Establishment grain and entity grain. The entity row is taken from the
    head office if any, else the smallest SIRET (deterministic; file order does
    not exist in Spark), and carries the active establishment count."""
    siret = select_tolerant(clean, SIRET_COLUMNS)
    ent_cols = [c for c in SIREN_COLUMNS if c != "nb_etablissements"]
    cand = select_tolerant(clean, ent_cols + ["siret", "etablissementSiege"])
    order: list[Column] = [F.struct(F.col("etablissementSiege").isNull(), ~F.col("etablissementSiege"))] \
        if siege_first else []
    first = first_per_key(cand, ["siren"], order + [F.col("siret")]).drop("siret", "etablissementSiege")
    counts = clean.groupBy("siren").agg(F.count(F.lit(1)).alias("nb_etablissements"))
    return siret, first.join(counts, "siren", "inner")


def enrich_geo(siret: DataFrame, decimals: int | None = None, overseas: str = "project") -> DataFrame:
    """Coordinates, department and anomaly flag. Lambert-93 only covers
    mainland France and Corsica: ``overseas="null"`` leaves the coordinates of
    97x/98x departments empty instead of projecting them with the wrong grid
    (the default keeps the source behaviour)."""
    if overseas not in ("project", "null"):
        raise ValueError("overseas must be 'project' or 'null'")
    x = try_double("adresseEtablissement_coordonneeLambertAbscisseEtablissement")
    y = try_double("adresseEtablissement_coordonneeLambertOrdonneeEtablissement")
    dep = department_from_commune("adresseEtablissement_codeCommuneEtablissement")
    out = siret.withColumn("departement", dep).withColumn("dept_anomaly", F.col("departement").isNull())
    if overseas == "null":
        far = F.substring("departement", 1, 2).isin("97", "98")
        x, y = F.when(~far | F.col("departement").isNull(), x), F.when(~far | F.col("departement").isNull(), y)
    return with_wgs84(out, x, y, decimals=decimals)


def enrich_siret(siret: DataFrame, ref_date: str, codes: Sequence[str] = bands.SECTOR_CODES) -> DataFrame:
    a = age_years("dateCreationEtablissement", ref_date)
    act = F.col("periode_activitePrincipaleEtablissement")
    return siret.withColumns({
        "anciennete_etab_annees": a,
        "tranche_anciennete_etab": age_band(a),
        "categorie_effectifs_etab": headcount_category("trancheEffectifsEtablissement"),
        "division_ape_etab": first_chars(act, 2),
        "type_activite_etab": sector_type(act, codes),
    })


def enrich_siren(siren: DataFrame, ref_date: str) -> DataFrame:
    a = age_years("uniteLegale_dateCreationUniteLegale", ref_date)
    return siren.withColumns({
        "anciennete_ul_annees": a,
        "tranche_anciennete_ul": age_band(a),
        "categorie_effectifs_ul": headcount_category("uniteLegale_trancheEffectifsUniteLegale"),
    })


def build_full(siret: DataFrame, siren: DataFrame, counts: DataFrame | None = None) -> tuple[DataFrame, SaltPlan]:
    """Establishment ⟕ entity on ``siren``; establishment columns win on name
    clashes. Salted on the entity key; the hot entities come from ``counts``
    (siren, nb_etablissements) when given, so finding them needs no join."""
    clash = [c for c in siren.columns if c in siret.columns and c != "siren"]
    ent = siren.drop(*clash)
    plan = SaltPlan.from_counts(counts if counts is not None else ent, ["siren"], "nb_etablissements")
    return plan.join(siret, ent, "left", salt_from=["siret"]), plan


def run(flat: DataFrame, ref_date: str, codes: Sequence[str] = bands.SECTOR_CODES,
        coord_decimals: int | None = None) -> dict[str, DataFrame]:
    """The whole chain on flattened raw records; tables tagged with the entity's
    activity code (the extraction filter) for partitioned publication. ``quarantine``
    holds the records that were left out because they can't be read."""
    good, bad = quarantine(flat)
    clean = clean_raw(good)
    siret, siren = split_siret_siren(clean)
    counts = clean.groupBy("siren").agg(F.count(F.lit(1)).alias("nb_etablissements"))
    siren = enrich_siren(siren, ref_date).withColumn("code_ape", F.col("uniteLegale_activitePrincipaleUniteLegale"))
    siret = enrich_siret(enrich_geo(siret, coord_decimals), ref_date, codes)
    full, plan = build_full(siret, siren, counts)
    code = siren.select("siren", "code_ape")
    return {"clean": clean, "siret": plan.join(siret, code, "left", salt_from=["siret"]).drop(*SALT_COLUMNS), "siren": siren,
            "full": full, "salt_plan": plan, "quarantine": bad}


#: Texts of the report (fixed values).
NO_DATA, NO_ACTIVE = "aucune donnée", "aucun établissement actif"


def record_error(df: DataFrame, corrupt_column: str = "_corrupt_record") -> Column:
    """What is wrong with a raw record, or null: the error travels as a column, so that one bad record or
    code stops no other."""
    malformed = F.col(corrupt_column).isNotNull() if corrupt_column in df.columns else F.lit(False)
    return (F.when(malformed, F.lit("ligne illisible")).when(F.col("siret").isNull(), F.lit("siret absent"))
            .when(F.col("siren").isNull(), F.lit("siren absent")))


def run_by_code(flat: DataFrame, wanted: DataFrame, ref_date: str, codes: Sequence[str] = bands.SECTOR_CODES,
                code_col: str = "code_extraction", most_rejected: float = 0.5, max_codes: int = 100_000) -> tuple[dict[str, DataFrame], DataFrame]:
    """The chain over all wanted codes (``code_ape``) in one job, each on its own account, and its report.

    ``flat`` tells in ``code_col`` which code a record was extracted for. A code without records fails, and so does one
    of whose records more than ``most_rejected`` can't be read: none of its rows reaches the tables. Other codes lose
    their unreadable records only. The report has a row a code (success, erreur, nb_siret, nb_siren, nb_rejets) and
    a ``TOTAL`` row. At most ``max_codes`` codes are broadcast."""
    wanted = wanted.select("code_ape").where("code_ape IS NOT NULL").distinct()
    seen = flat.withColumn("__erreur", record_error(flat))
    by_code = seen.groupBy(F.col(code_col).alias("__code")).agg(F.count(F.lit(1)).alias("lus"), F.count("__erreur").alias("nb_rejets"))
    state = wanted.join(by_code, F.col("code_ape") == F.col("__code"), "left").drop("__code").fillna(0, ["lus", "nb_rejets"])
    state = state.withColumn("erreur", F.when(F.col("lus") == 0, F.lit(NO_DATA)).when(
        F.col("nb_rejets") > F.col("lus") * F.lit(most_rejected), F.format_string("%d enregistrements rejetés sur %d", "nb_rejets", "lus")))
    sound = bounded(state.where("erreur IS NULL").select(F.col("code_ape").alias("__code")), max_codes)
    rows = seen.where("__erreur IS NULL").join(sound, F.col(code_col) == F.col("__code"), "left_semi")
    out = run(rows.drop("__erreur", code_col, "_corrupt_record"), ref_date, codes)
    out["quarantine"] = seen.where("__erreur IS NOT NULL").withColumnRenamed("__erreur", "erreur")

    # sites and entities in one pass: a row an entity first
    entities = out["full"].groupBy("code_ape", "siren").agg(F.count(F.lit(1)).alias("n"))
    counts = entities.groupBy(F.col("code_ape").alias("__code")).agg(F.sum("n").alias("nb_siret"), F.count(F.lit(1)).alias("nb_siren"))
    report = state.join(counts, F.col("code_ape") == F.col("__code"), "left").fillna(0, ["nb_siret", "nb_siren"])
    report = report.withColumn("erreur", F.coalesce("erreur", F.when(F.col("nb_siret") == 0, F.lit(NO_ACTIVE))))
    columns = ["code_ape", "success", "erreur", "nb_siret", "nb_siren", "nb_rejets"]
    report = report.withColumn("success", F.col("erreur").isNull()).select(*columns)
    failed = F.count(F.when(~F.col("success"), F.lit(1)))
    total = report.agg((failed == 0).alias("success"), F.format_string("%d en erreur sur %d", failed, F.count(F.lit(1))).alias("erreur"),
                       *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns[3:]]).withColumn("code_ape", F.lit("TOTAL"))
    return out, report.unionByName(total)
