"""Scored views over the establishment table ``full``.

``scored_view`` (V1): retained codes -> active rows -> star join onto the five
dimensions (broadcast, checked) -> five additive scores -> potential category ->
entity mean score -> first-match segment cascade. The mean comes from the entity's
sum of points where ``full`` brings it along (one aggregate an entity, made when the
sites are counted), else from skew-safe group statistics salted on the entity key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address_line
from ..operators.cascade import FlagSet, ScoreSet, Segmentation
from ..operators.groups import SALT_COLUMNS, TOTAL, SaltPlan, attach_group_stats
from ..operators.star import DimRef, star_join
from ..rules import scoring

BASE_COLUMNS = {
    "siret": "siret",
    "siren": "siren",
    "uniteLegale_denominationUniteLegale": "nom_entreprise",
    "code_ape": "code_ape",
    "departement": "code_departement",
    "trancheEffectifsEtablissement": "code_effectifs_etablissement",
    "uniteLegale_trancheEffectifsUniteLegale": "code_effectifs_unite_legale",
    "uniteLegale_categorieJuridiqueUniteLegale": "code_categorie_juridique",
    "dateCreationEtablissement": "date_creation_etablissement",
    "uniteLegale_dateCreationUniteLegale": "date_creation_entreprise",
    "periode_etatAdministratifEtablissement": "etat_administratif",
    "etablissementSiege": "est_siege",
    "longitude": "longitude",
    "latitude": "latitude",
    "nb_etablissements": "nb_etablissements",
}


ADDRESS_PARTS = ("adresseEtablissement_numeroVoieEtablissement", "adresseEtablissement_typeVoieEtablissement",
                 "adresseEtablissement_libelleVoieEtablissement", "adresseEtablissement_codePostalEtablissement",
                 "adresseEtablissement_libelleCommuneEtablissement")


def star_dimensions(dims: dict[str, DataFrame], legal_key: str = "uniteLegale_categorieJuridiqueUniteLegaleNiv2",
                    dept_key: str = "departement", with_entity_band: bool = True) -> list[DimRef]:
    """The view's five left joins; the headcount dimension serves two roles.
    Dimensions listed in ``dims["__checked__"]`` have a size bound proven at
    construction; the others get a row-count check before being broadcast."""
    refs = [
        DimRef("d", dims["dim_departements"], {dept_key: "dep"},
               {"profil_territorial": "profil_territorial"}),
        DimRef("eff_etab", dims["dim_categories_effectifs"], {"trancheEffectifsEtablissement": "tranche_effectifs"},
               {"Employes": "libelle_effectifs_etablissement"}),
    ]
    if with_entity_band:
        refs.append(DimRef("eff_ul", dims["dim_categories_effectifs"],
                           {"uniteLegale_trancheEffectifsUniteLegale": "tranche_effectifs"},
                           {"Employes": "libelle_effectifs_unite_legale"}))
    checked = dims.get("__checked__", frozenset())
    refs += [
        DimRef("j", dims["dim_categories_juridiques"], {legal_key: "categorie_juridique_ul_niv2"},
               {"famille_juridique": "famille_juridique"}),
        DimRef("ape", dims["dim_codes_ape"], {"code_ape": "code_ape"},
               {"score_priorite": "score_priorite", "libelle_ape": "libelle_ape"}),
    ]
    names = {"d": "dim_departements", "eff_etab": "dim_categories_effectifs", "eff_ul": "dim_categories_effectifs",
             "j": "dim_categories_juridiques", "ape": "dim_codes_ape"}
    for r in refs:
        r.checked = names[r.name] in checked
    return refs


def scoring_base(full: DataFrame, dims: dict[str, DataFrame],
                 retained_codes: Sequence[str] | None = None) -> DataFrame:
    """Union of retained codes (a partition filter on ``code_ape``), active
    rows, star join, canonical names. Row-local: no shuffle."""
    f = full
    if retained_codes is not None:
        f = f.where(F.col("code_ape").isin(*retained_codes))
    f = f.where(F.col("periode_etatAdministratifEtablissement") == "A")
    j = star_join(f, star_dimensions(dims))
    keep = [F.col(src).alias(dst) for src, dst in BASE_COLUMNS.items() if src in j.columns]
    parts = [F.col(c) if c in j.columns else F.lit(None).cast("string") for c in ADDRESS_PARTS]
    addr = address_line(*parts).alias("adresse_complete")
    extra = [c for c in ("profil_territorial", "libelle_effectifs_etablissement", "libelle_effectifs_unite_legale",
                         "famille_juridique", "libelle_ape", "score_priorite") if c in j.columns]
    salt = [c for c in SALT_COLUMNS if c in j.columns]
    return j.select(*keep, addr, *extra, *salt)


def score(df: DataFrame, scores: ScoreSet = scoring.SCORE_130) -> DataFrame:
    """Add dimension scores, total, structure type and potential category."""
    out = scoring.STRUCTURE_TYPE.apply(df)
    out = scores.apply(out)
    return scoring.POTENTIAL.apply(out)


def site_points(siret: DataFrame, dims: dict[str, DataFrame], scores: ScoreSet = scoring.SCORE_130) -> DataFrame:
    """``siret`` with ``__points``: the part of the score that depends on the establishment alone
    (territory, size, legal form); the rest is one value an entity (activity, multi-site)."""
    checked = dims.get("__checked__", frozenset())
    refs = [DimRef("d", dims["dim_departements"], {"departement": "dep"}, {"profil_territorial": "profil_territorial"},
                   checked="dim_departements" in checked),
            DimRef("j", dims["dim_categories_juridiques"], {"uniteLegale_categorieJuridiqueUniteLegaleNiv2": "categorie_juridique_ul_niv2"},
                   {"famille_juridique": "famille_juridique"}, checked="dim_categories_juridiques" in checked)]
    j = star_join(siret, refs).withColumnRenamed("trancheEffectifsEtablissement", "code_effectifs_etablissement")
    own = [c for c in scores.dimensions if c.name not in ENTITY_SCORES]
    points = own[0].column()
    for c in own[1:]:
        points = points + c.column()
    return j.withColumn("__points", points)


#: Scores that are the same for every establishment of an entity.
ENTITY_SCORES = ("score_potentiel_ape", "bonus_multi_agences")


def with_entity_mean(df: DataFrame, plan: SaltPlan | None = None, key: str = "siren",
                     total: str = "score_total", name: str = "score_moyen_siren") -> DataFrame:
    """Entity mean of the establishment score (W1), skew-safe.

    Where the rows bring the sum of their entity's own points along (``TOTAL``, see
    ``site_points``) and its count, the mean is arithmetic on the row: no window, no
    second pass, however many establishments an entity has."""
    if TOTAL in df.columns:
        n = F.col("nb_etablissements")
        shared = sum((F.col(c) for c in ENTITY_SCORES[1:]), F.col(ENTITY_SCORES[0]))
        return df.withColumn(name, (F.col(TOTAL) + n * shared).cast("double") / n.cast("double")).drop(*SALT_COLUMNS)
    return attach_group_stats(df, [key], {name: F.avg(total)}, salt_from=["siret"], plan=plan)


def scored_view(full: DataFrame, dims: dict[str, DataFrame], plan: SaltPlan | None = None,
                retained_codes: Sequence[str] | None = None, version: str = "1.6") -> DataFrame:
    """Global scored view (V1) under a rule version (1.1 .. 1.6)."""
    scores, labels = scoring.VERSIONS[version]
    base = scoring_base(full, dims, retained_codes)
    s = score(base, scores)
    if isinstance(labels, Segmentation):
        s = with_entity_mean(s, plan)
        return labels.apply(s)
    assert isinstance(labels, FlagSet)
    return labels.apply(s).drop(*SALT_COLUMNS)


# FIXED VALUES: the single-code view's columns, in its order: column of ``full`` or of a joined
# dimension, and the name in the view. The five score columns follow.
SINGLE_CODE_COLUMNS = (
    ("siret", "siret"), ("siren", "siren"),
    ("uniteLegale_denominationUniteLegale", "nom_entreprise"), ("uniteLegale_sigleUniteLegale", "sigle_entreprise"),
    ("uniteLegale_denominationUsuelle1UniteLegale", "denomination_usuelle"),
    ("statutDiffusionEtablissement", "statut_diffusion_etablissement"),
    ("uniteLegale_statutDiffusionUniteLegale", "statut_diffusion_unite_legale"),
    ("periode_activitePrincipaleEtablissement", "code_ape"), ("libelle_ape", "ape_nom_complet"),
    ("nom_commun_metier", "ape_metier"), ("famille_metier", "ape_famille"),
    ("division_ape_etab", "division_ape"), ("type_activite_etab", "type_activite"),
    ("uniteLegale_activitePrincipaleUniteLegale", "code_ape_unite_legale"),
    ("activitePrincipaleRegistreMetiersEtablissement", "code_activite_registre_metiers"),
    ("adresseEtablissement_numeroVoieEtablissement", "numero_voie"), ("adresseEtablissement_typeVoieEtablissement", "type_voie"),
    ("adresseEtablissement_libelleVoieEtablissement", "libelle_voie"), ("adresseEtablissement_codePostalEtablissement", "code_postal"),
    ("adresseEtablissement_libelleCommuneEtablissement", "commune"), ("adresseEtablissement_codeCommuneEtablissement", "code_commune"),
    ("longitude", "longitude"), ("latitude", "latitude"),
    ("adresseEtablissement_coordonneeLambertAbscisseEtablissement", "lambert_x"),
    ("adresseEtablissement_coordonneeLambertOrdonneeEtablissement", "lambert_y"),
    ("adresseEtablissement_libellePaysEtrangerEtablissement", "pays_etranger"),
    ("departement", "code_departement"), ("dept_anomaly", "departement_anomalie"), ("dep_name", "departement_nom"),
    ("prefecture", "departement_prefecture"), ("region", "region"), ("km2", "departement_superficie_km2"),
    ("population_2022", "departement_population"), ("profil_territorial", "profil_territorial"),
    ("profil_territorial_ordre", "profil_territorial_ordre"),
    ("trancheEffectifsEtablissement", "code_tranche_effectifs_etab"), ("anneeEffectifsEtablissement", "annee_effectifs_etab"),
    ("Employes", "effectifs_libelle_etab"), ("categorie_effectifs_etab", "categorie_effectifs_etab"),
    ("uniteLegale_trancheEffectifsUniteLegale", "code_tranche_effectifs_ul"),
    ("uniteLegale_anneeEffectifsUniteLegale", "annee_effectifs_ul"), ("categorie_effectifs_ul", "categorie_effectifs_ul"),
    ("nb_etablissements", "nb_etablissements"),
    ("uniteLegale_categorieJuridiqueUniteLegale", "code_categorie_juridique_niv1"),
    ("uniteLegale_categorieJuridiqueUniteLegaleNiv2", "code_categorie_juridique_niv2"),
    ("Libelle", "categorie_juridique_libelle"), ("famille_juridique", "famille_juridique"),
    ("uniteLegale_categorieEntreprise", "categorie_entreprise"),
    ("dateCreationEtablissement", "date_creation_etablissement"),
    ("periode_etatAdministratifEtablissement", "etat_administratif_etablissement"), ("etablissementSiege", "est_siege"),
    ("uniteLegale_dateCreationUniteLegale", "date_creation_unite_legale"),
    ("uniteLegale_etatAdministratifUniteLegale", "etat_administratif_unite_legale"),
    ("anciennete_etab_annees", "anciennete_etab_annees"), ("tranche_anciennete_etab", "tranche_anciennete_etab"),
    ("anciennete_ul_annees", "anciennete_ul_annees"), ("tranche_anciennete_ul", "tranche_anciennete_ul"),
)


def single_code_view(full: DataFrame, dims: dict[str, DataFrame], code: str) -> DataFrame:
    """Single-code view (V2): the establishments published under one activity code, with the
    100-point score. The activity dimension is joined on the establishment's own code,
    which may differ from its entity's (and so from ``code``). Columns that ``full``
    lacks are typed nulls."""
    f = full.where((F.col("code_ape") == code) & (F.col("periode_etatAdministratifEtablissement") == "A")).drop("code_ape")
    own = "periode_activitePrincipaleEtablissement"
    if own not in f.columns:
        f = f.withColumn(own, F.lit(None).cast("string"))

    def role(name: str, dim: str, on: dict[str, str], *cols: str) -> DimRef:
        ref = DimRef(name, dims[dim], on, {c: c for c in cols})
        ref.checked = dim in dims.get("__checked__", frozenset())
        return ref

    j = star_join(f, [
        role("ape", "dim_codes_ape", {own: "code_ape"}, "libelle_ape", "nom_commun_metier", "famille_metier"),
        role("d", "dim_departements", {"departement": "dep"}, "dep_name", "prefecture", "region", "km2", "population_2022",
             "profil_territorial", "profil_territorial_ordre"),
        role("eff", "dim_categories_effectifs", {"trancheEffectifsEtablissement": "tranche_effectifs"}, "Employes"),
        role("jur", "dim_categories_juridiques", {"uniteLegale_categorieJuridiqueUniteLegaleNiv2": "categorie_juridique_ul_niv2"},
             "Libelle", "famille_juridique"),
    ])
    base = j.select(*[(F.col(src) if src in j.columns else F.lit(None).cast("string")).alias(name) for src, name in SINGLE_CODE_COLUMNS],
                    F.col("trancheEffectifsEtablissement").alias("code_effectifs_etablissement"))
    s = scoring.SCORE_100.apply(base)
    return scoring.POTENTIAL_100.apply(s).drop("code_effectifs_etablissement")
