"""Explicit schemas. Inference is never used: codes keep leading zeros and
``2A``/``NN`` values, and a key read as a number cannot silently mismatch."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


UNITE_LEGALE = T.StructType(_s(
    "statutDiffusionUniteLegale", "etatAdministratifUniteLegale", "dateCreationUniteLegale",
    "categorieJuridiqueUniteLegale", "denominationUniteLegale", "sigleUniteLegale",
    "denominationUsuelle1UniteLegale", "activitePrincipaleUniteLegale", "categorieEntreprise",
    "trancheEffectifsUniteLegale", "anneeEffectifsUniteLegale"))

ADRESSE = T.StructType(_s(
    "numeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement",
    "codePostalEtablissement", "libelleCommuneEtablissement", "codeCommuneEtablissement",
    "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement",
    "libellePaysEtrangerEtablissement"))

PERIODE = T.StructType(_s("dateDebut", "dateFin", "activitePrincipaleEtablissement",
                          "etatAdministratifEtablissement"))

# One raw establishment record of the registry (nested JSON).
RAW_ESTABLISHMENT = T.StructType(
    _s("siret", "siren", "statutDiffusionEtablissement", "dateCreationEtablissement",
       "trancheEffectifsEtablissement", "anneeEffectifsEtablissement",
       "activitePrincipaleRegistreMetiersEtablissement")
    + [T.StructField("etablissementSiege", T.BooleanType(), True),
       T.StructField("uniteLegale", UNITE_LEGALE, True),
       T.StructField("adresseEtablissement", ADRESSE, True),
       T.StructField("periodesEtablissement", T.ArrayType(PERIODE, True), True)])

DIM_DEPARTEMENTS = T.StructType(
    _s("dep", "dep_name", "prefecture", "region")
    + [T.StructField("km2", T.DoubleType(), True), T.StructField("population_2022", T.LongType(), True),
       T.StructField("profil_territorial", S, True), T.StructField("profil_territorial_ordre", T.IntegerType(), True)])

# The activity CSV has a blank header before the score; it is read as `_blank` and dropped.
DIM_CODES_APE_CSV = T.StructType(
    _s("code_ape", "libelle_ape", "division_ape", "division_libelle", "famille_metier",
       "nom_commun_metier", "_blank") + [T.StructField("score_priorite", T.IntegerType(), True)])

DIM_CATEGORIES_EFFECTIFS = T.StructType(_s("tranche_effectifs", "Employes"))

# All strings: the legal prefix "00" must not become the number 0.
DIM_CATEGORIES_JURIDIQUES = T.StructType(_s("categorie_juridique_ul_niv2", "famille_juridique", "Libelle"))

DIM_ANCIENNETE = T.StructType(
    _s("anciennete_id", "libelle")
    + [T.StructField("borne_min_annees", T.IntegerType(), True),
       T.StructField("borne_max_annees", T.IntegerType(), True),
       T.StructField("ordre", T.IntegerType(), True)])

DIMENSION_SCHEMAS = {
    "dim_departements": DIM_DEPARTEMENTS,
    "dim_codes_ape": DIM_CODES_APE_CSV,
    "dim_categories_effectifs": DIM_CATEGORIES_EFFECTIFS,
    "dim_categories_juridiques": DIM_CATEGORIES_JURIDIQUES,
    "dim_anciennete": DIM_ANCIENNETE,
}

# Extraction manifest: one row per attempt.
MANIFEST = T.StructType([
    T.StructField("code_ape", S, False),
    T.StructField("extraction_date", T.TimestampType(), True),
    T.StructField("status", S, True),
    T.StructField("nb_etablissements", T.LongType(), True),
])
