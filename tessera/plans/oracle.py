"""SQL text of the same model for the DuckDB oracle.

Plain ANSI SQL over the driver's tables (views ``orders``, ``customer``, ...):
the model, the five dimensions and the scored view written the way the source
warehouse wrote it (window ``AVG OVER (PARTITION BY siren)``), independent of
the Spark formulation (salted group statistics). Rule ``CASE`` blocks are
rendered from the same rule tables; literal tables become ``VALUES``.
"""

from __future__ import annotations

from ..rules import bands, scoring
from . import model


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows, cols, alias: str = "t") -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int, float)):
            return repr(v)
        return _q(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


def _pmod(a: str, n: int) -> str:
    return f"((({a}) % {n} + {n}) % {n})"


def _band(x: str, width: float, offset: float = 0.0) -> str:
    codes = "[" + ", ".join(_q(c) for c in bands.HEADCOUNT_CODES) + "]"
    idx = f"CAST(least(greatest(floor(({x} + {offset!r}) / {width!r}), 0), {len(bands.HEADCOUNT_CODES) - 1}) AS INTEGER)"
    return f"CASE WHEN {x} IS NOT NULL THEN {codes}[{idx} + 1] END"


def _dept(c: str) -> str:
    t = f"trim(CAST({c} AS VARCHAR))"
    return (f"CASE WHEN {t} IS NULL OR {t} = '' OR {t} = '[ND]' THEN NULL "
            f"WHEN upper({t}) LIKE '2A%' THEN '2A' WHEN upper({t}) LIKE '2B%' THEN '2B' "
            f"WHEN {t} LIKE '97%' OR {t} LIKE '98%' THEN substring({t}, 1, 3) "
            f"ELSE substring({t}, 1, 2) END")


def _lambert(xs: str, ys: str) -> tuple[str, str]:
    from ..functions import geo as g
    x = f"TRY_CAST(trim({xs}) AS DOUBLE)"
    y = f"TRY_CAST(trim({ys}) AS DOUBLE)"
    dx, dy = f"({x} - {g.XS!r})", f"({y} - {g.YS!r})"
    r = f"sqrt({dx} * {dx} + {dy} * {dy})"
    lon = f"({g.LON0_DEG!r} + degrees(atan({dx} / (-{dy})) / {g.N!r}))"
    el = f"exp(-ln({r} / {g.C!r}) / {g.N!r})"
    phi = f"(2.0 * atan({el}) - pi() / 2)"
    for _ in range(g.ITERATIONS):
        phi = f"(2.0 * atan(exp({g.E!r} * atanh({g.E!r} * sin({phi}))) * {el}) - pi() / 2)"
    lat = f"degrees({phi})"
    ok = f"({x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"CASE WHEN {ok} THEN {lon} END", f"CASE WHEN {ok} THEN {lat} END"


def _commune(o: str = "o_orderkey", c: str = "o_custkey") -> str:
    k = _pmod(o, 53)
    t3 = f"lpad(CAST({_pmod(o, 1000)} AS VARCHAR), 3, '0')"
    t2 = f"lpad(CAST({_pmod(o, 100)} AS VARCHAR), 2, '0')"
    return (f"CASE WHEN {k} = 0 THEN NULL WHEN {k} = 1 THEN '' WHEN {k} = 2 THEN ' [ND] ' "
            f"WHEN {k} = 3 THEN '2a' || {t3} WHEN {k} = 4 THEN '2B' || {t3} "
            f"WHEN {k} = 5 THEN '974' || {t2} WHEN {k} = 6 THEN '988' || {t2} "
            f"ELSE lpad(CAST({_pmod(c, 25)} AS VARCHAR), 2, '0') || {t3} END")


def _coord(axis: str) -> str:
    base, mult, span = (100000, 7919, 1100000) if axis == "x" else (6050000, 104723, 1050000)
    return (f"CASE WHEN {_pmod('o_orderkey', 13)} = 0 THEN '[ND]' WHEN {_pmod('o_orderkey', 11)} = 0 THEN NULL "
            f"ELSE CAST({base} + {_pmod(f'o_orderkey * {mult}', span)} AS VARCHAR) END")


def dims_ctes() -> str:
    prof = _values(model.REGION_PROFILE, ["r_name", "profil_territorial", "profil_territorial_ordre"], "pr")
    ape = _values([(c, lab, div, f"Division {div}", fam, lab.split(" ")[0], s)
                   for c, lab, div, fam, s in model.SEGMENT_ACTIVITY],
                  ["code_ape", "libelle_ape", "division_ape", "division_libelle", "famille_metier",
                   "nom_commun_metier", "score_priorite"])
    eff = _values(bands.HEADCOUNT_BANDS, ["tranche_effectifs", "Employes"])
    jur = _values(model.LEGAL_FAMILIES, ["categorie_juridique_ul_niv2", "famille_juridique", "Libelle"])
    anc = _values(bands.AGE_DIMENSION, ["anciennete_id", "libelle", "borne_min_annees", "borne_max_annees", "ordre"])
    return f"""
dim_departements AS (
  SELECT lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS dep, n.n_name AS dep_name,
         'CHEF-LIEU ' || n.n_name AS prefecture, r.r_name AS region,
         COALESCE(a.km2, 0.0) AS km2, CAST(COALESCE(p.population_2022, 0) AS BIGINT) AS population_2022,
         pr.profil_territorial, pr.profil_territorial_ordre
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN {prof} ON pr.r_name = r.r_name
  LEFT JOIN (SELECT c_nationkey, COUNT(*) AS population_2022 FROM customer GROUP BY c_nationkey) p
    ON n.n_nationkey = p.c_nationkey
  LEFT JOIN (SELECT s_nationkey, COUNT(*) * 1000.0 AS km2 FROM supplier GROUP BY s_nationkey) a
    ON n.n_nationkey = a.s_nationkey
),
dim_codes_ape AS (SELECT * FROM {ape}),
dim_categories_effectifs AS (SELECT * FROM {eff}),
dim_categories_juridiques AS (SELECT * FROM {jur}),
dim_anciennete AS (SELECT * FROM {anc})"""


def raw_siret_sql() -> str:
    lon, lat = _lambert("x_l93", "y_l93")
    return f"""
raw_siret0 AS (
  SELECT o_orderkey AS siret, o_custkey AS siren, CAST(o_orderdate AS DATE) AS dateCreationEtablissement,
         {_band('o_totalprice', model.PRICE_BAND_WIDTH)} AS trancheEffectifsEtablissement,
         ({_pmod('o_orderkey', 7)} = 0) AS etablissementSiege,
         ([{", ".join(_q(c) for c in model.OWN_CODES)}])[{_pmod('o_orderkey', len(model.OWN_CODES))} + 1]
           AS periode_activitePrincipaleEtablissement,
         CASE WHEN o_totalprice >= {model.ACTIVE_MIN_PRICE!r} THEN 'A' ELSE 'F' END AS periode_etatAdministratifEtablissement,
         o_orderpriority AS uniteLegale_categorieJuridiqueUniteLegale,
         substring(o_orderpriority, 1, 1) AS uniteLegale_categorieJuridiqueUniteLegaleNiv2,
         CASE WHEN {_pmod('o_orderkey', 150)} = 0 THEN NULL ELSE CAST({_pmod('o_orderkey', 150)} AS VARCHAR) END
           AS adresseEtablissement_numeroVoieEtablissement,
         (['RUE', 'AV', 'BD', 'CHE', NULL])[{_pmod('o_orderkey', 5)} + 1] AS adresseEtablissement_typeVoieEtablissement,
         'DES ARTISANS ' || CAST({_pmod('o_orderkey', 97)} AS VARCHAR) AS adresseEtablissement_libelleVoieEtablissement,
         lpad(CAST({_pmod('o_custkey * 7', 95000)} AS VARCHAR), 5, '0') AS adresseEtablissement_codePostalEtablissement,
         'COMMUNE ' || CAST({_pmod('o_custkey', 25)} AS VARCHAR) AS adresseEtablissement_libelleCommuneEtablissement,
         {_commune()} AS adresseEtablissement_codeCommuneEtablissement,
         {_coord('x')} AS x_l93, {_coord('y')} AS y_l93
  FROM orders
),
raw_siret AS (
  SELECT * EXCLUDE (x_l93, y_l93),
         x_l93 AS adresseEtablissement_coordonneeLambertAbscisseEtablissement,
         y_l93 AS adresseEtablissement_coordonneeLambertOrdonneeEtablissement,
         {lon} AS lon0, {lat} AS lat0,
         {_dept('adresseEtablissement_codeCommuneEtablissement')} AS departement
  FROM raw_siret0
),
geo_siret AS (
  SELECT * EXCLUDE (lon0, lat0),
         round(CASE WHEN abs(lat0) <= 90 AND abs(lon0) <= 180 THEN lon0 END, 9) AS longitude,
         round(CASE WHEN abs(lat0) <= 90 AND abs(lon0) <= 180 THEN lat0 END, 9) AS latitude,
         departement IS NULL AS dept_anomaly
  FROM raw_siret
)"""


def full_sql() -> str:
    return f"""
active_siret AS (SELECT * FROM geo_siret WHERE periode_etatAdministratifEtablissement = 'A'),
siren_t AS (
  SELECT c.c_custkey AS siren, c.c_name AS uniteLegale_denominationUniteLegale,
         c.c_mktsegment AS uniteLegale_activitePrincipaleUniteLegale,
         {_band('c.c_acctbal', model.ACCTBAL_BAND_WIDTH, model.ACCTBAL_OFFSET)} AS uniteLegale_trancheEffectifsUniteLegale,
         'A' AS uniteLegale_etatAdministratifUniteLegale,
         p.nb_etablissements, p.uniteLegale_dateCreationUniteLegale
  FROM customer c JOIN (
    SELECT siren, COUNT(*) AS nb_etablissements, MIN(dateCreationEtablissement) AS uniteLegale_dateCreationUniteLegale
    FROM active_siret GROUP BY siren) p ON c.c_custkey = p.siren
),
full_t AS (
  SELECT s.*, e.uniteLegale_denominationUniteLegale, e.uniteLegale_activitePrincipaleUniteLegale,
         e.uniteLegale_trancheEffectifsUniteLegale, e.uniteLegale_etatAdministratifUniteLegale,
         e.nb_etablissements, e.uniteLegale_dateCreationUniteLegale,
         e.uniteLegale_activitePrincipaleUniteLegale AS code_ape
  FROM active_siret s JOIN siren_t e ON s.siren = e.siren
)"""


def _scored_sql(version: str = "1.6", name: str = "scored") -> str:
    scores, labels = scoring.VERSIONS[version]
    retained = ", ".join(_q(c) for c in model.RETAINED_SEGMENTS)
    score_cols = ",\n    ".join(scores.sql_columns())
    base = f"""
{name}_base AS (
  SELECT b.siret, b.siren, b.uniteLegale_denominationUniteLegale AS nom_entreprise, b.code_ape,
    b.departement AS code_departement,
    b.trancheEffectifsEtablissement AS code_effectifs_etablissement,
    b.uniteLegale_trancheEffectifsUniteLegale AS code_effectifs_unite_legale,
    b.uniteLegale_categorieJuridiqueUniteLegale AS code_categorie_juridique,
    b.dateCreationEtablissement AS date_creation_etablissement,
    b.uniteLegale_dateCreationUniteLegale AS date_creation_entreprise,
    b.periode_etatAdministratifEtablissement AS etat_administratif,
    b.etablissementSiege AS est_siege, b.longitude, b.latitude, b.nb_etablissements,
    CONCAT(COALESCE(b.adresseEtablissement_numeroVoieEtablissement, ''), ' ',
           COALESCE(b.adresseEtablissement_typeVoieEtablissement, ''), ' ',
           COALESCE(b.adresseEtablissement_libelleVoieEtablissement, ''), ', ',
           COALESCE(b.adresseEtablissement_codePostalEtablissement, ''), ' ',
           COALESCE(b.adresseEtablissement_libelleCommuneEtablissement, '')) AS adresse_complete,
    d.profil_territorial, eff_etab.Employes AS libelle_effectifs_etablissement,
    eff_ul.Employes AS libelle_effectifs_unite_legale, j.famille_juridique, ape.libelle_ape, ape.score_priorite
  FROM full_t b
  LEFT JOIN dim_departements d ON b.departement = d.dep
  LEFT JOIN dim_categories_effectifs eff_etab ON b.trancheEffectifsEtablissement = eff_etab.tranche_effectifs
  LEFT JOIN dim_categories_effectifs eff_ul ON b.uniteLegale_trancheEffectifsUniteLegale = eff_ul.tranche_effectifs
  LEFT JOIN dim_categories_juridiques j ON b.uniteLegale_categorieJuridiqueUniteLegaleNiv2 = j.categorie_juridique_ul_niv2
  LEFT JOIN dim_codes_ape ape ON b.code_ape = ape.code_ape
  WHERE b.code_ape IN ({retained}) AND b.periode_etatAdministratifEtablissement = 'A'
),
{name}_s1 AS (
  SELECT *, {scoring.STRUCTURE_TYPE.sql()},
    {score_cols}
  FROM {name}_base
),
{name}_s2 AS (
  SELECT *, {scores.total_sql()} AS score_total FROM {name}_s1
),
{name}_s3 AS (
  SELECT *, {scoring.POTENTIAL.sql()} FROM {name}_s2
)"""
    if isinstance(labels, scoring.Segmentation):
        seg = ",\n    ".join(labels.sql_columns())
        return base + f""",
{name}_s4 AS (
  SELECT *, AVG(score_total) OVER (PARTITION BY siren) AS score_moyen_siren FROM {name}_s3
),
{name} AS (
  SELECT *, {seg} FROM {name}_s4
)"""
    flags = ",\n    ".join(labels.sql_columns())
    return base + f""",
{name} AS (
  SELECT *, {flags} FROM {name}_s3
)"""


def _category(c: str) -> str:
    arms = " ".join(f"WHEN {c} IN ({', '.join(_q(x) for x in codes)}) THEN {_q(lab)}" for lab, codes in bands.HEADCOUNT_CATEGORIES)
    return f"CASE {arms} END"


def _age(c: str) -> str:
    return f"CAST(floor(date_diff('day', {c}, DATE '{model.REF_DATE}') / 365.0) AS INTEGER)"


def _age_label(a: str) -> str:
    return (f"CASE WHEN {a} IS NULL THEN NULL WHEN {a} <= 5 THEN '0-5 ans' WHEN {a} <= 10 THEN '6-10 ans' "
            f"WHEN {a} <= 20 THEN '11-20 ans' ELSE '20+ ans' END")


def _v2_sql() -> str:
    """The single-code view written out: points and thresholds as text, not from the rule tables."""
    own, etab, ul = "f.periode_activitePrincipaleEtablissement", "f.trancheEffectifsEtablissement", "f.uniteLegale_trancheEffectifsUniteLegale"
    age_etab, age_ul = _age("f.dateCreationEtablissement"), _age("f.uniteLegale_dateCreationUniteLegale")
    retained = ", ".join(_q(c) for c in model.RETAINED_SEGMENTS)
    null = "CAST(NULL AS VARCHAR)"
    return f"""
v2_base AS (
  SELECT f.siret, f.siren, f.uniteLegale_denominationUniteLegale AS nom_entreprise, {null} AS sigle_entreprise,
    {null} AS denomination_usuelle, {null} AS statut_diffusion_etablissement, {null} AS statut_diffusion_unite_legale,
    {own} AS code_ape, ape.libelle_ape AS ape_nom_complet, ape.nom_commun_metier AS ape_metier,
    ape.famille_metier AS ape_famille, substring({own}, 1, 2) AS division_ape,
    CASE WHEN {own} IN ({retained}) THEN 'BTP' ELSE 'Autres' END AS type_activite,
    f.uniteLegale_activitePrincipaleUniteLegale AS code_ape_unite_legale, {null} AS code_activite_registre_metiers,
    f.adresseEtablissement_numeroVoieEtablissement AS numero_voie, f.adresseEtablissement_typeVoieEtablissement AS type_voie,
    f.adresseEtablissement_libelleVoieEtablissement AS libelle_voie, f.adresseEtablissement_codePostalEtablissement AS code_postal,
    f.adresseEtablissement_libelleCommuneEtablissement AS commune, f.adresseEtablissement_codeCommuneEtablissement AS code_commune,
    f.longitude, f.latitude, f.adresseEtablissement_coordonneeLambertAbscisseEtablissement AS lambert_x,
    f.adresseEtablissement_coordonneeLambertOrdonneeEtablissement AS lambert_y, {null} AS pays_etranger,
    f.departement AS code_departement, f.dept_anomaly AS departement_anomalie, d.dep_name AS departement_nom,
    d.prefecture AS departement_prefecture, d.region, CAST(d.km2 AS DOUBLE) AS departement_superficie_km2,
    d.population_2022 AS departement_population, d.profil_territorial, d.profil_territorial_ordre,
    {etab} AS code_tranche_effectifs_etab, {null} AS annee_effectifs_etab, eff.Employes AS effectifs_libelle_etab,
    {_category(etab)} AS categorie_effectifs_etab, {ul} AS code_tranche_effectifs_ul, {null} AS annee_effectifs_ul,
    {_category(ul)} AS categorie_effectifs_ul, f.nb_etablissements,
    f.uniteLegale_categorieJuridiqueUniteLegale AS code_categorie_juridique_niv1,
    f.uniteLegale_categorieJuridiqueUniteLegaleNiv2 AS code_categorie_juridique_niv2,
    jur.Libelle AS categorie_juridique_libelle, jur.famille_juridique, {null} AS categorie_entreprise,
    f.dateCreationEtablissement AS date_creation_etablissement,
    f.periode_etatAdministratifEtablissement AS etat_administratif_etablissement, f.etablissementSiege AS est_siege,
    f.uniteLegale_dateCreationUniteLegale AS date_creation_unite_legale,
    f.uniteLegale_etatAdministratifUniteLegale AS etat_administratif_unite_legale,
    {age_etab} AS anciennete_etab_annees, {_age_label(age_etab)} AS tranche_anciennete_etab,
    {age_ul} AS anciennete_ul_annees, {_age_label(age_ul)} AS tranche_anciennete_ul,
    CASE d.profil_territorial WHEN 'Très urbain' THEN 40 WHEN 'Urbain' THEN 30 WHEN 'Péri-urbain' THEN 20
      WHEN 'Rural' THEN 10 ELSE 0 END AS score_territoire,
    CASE WHEN {etab} IN ('21', '22', '31', '32', '41', '42', '51', '52', '53') THEN 30 WHEN {etab} IN ('11', '12') THEN 20
      WHEN {etab} = '03' THEN 10 WHEN {etab} IN ('01', '02') THEN 5 WHEN {etab} = '00' THEN 2 ELSE 0 END AS score_taille,
    CASE jur.famille_juridique WHEN 'Société commerciale' THEN 30 WHEN 'Entrepreneur individuel' THEN 15 ELSE 10 END AS score_juridique
  FROM full_t f
  LEFT JOIN dim_codes_ape ape ON {own} = ape.code_ape
  LEFT JOIN dim_departements d ON f.departement = d.dep
  LEFT JOIN dim_categories_effectifs eff ON {etab} = eff.tranche_effectifs
  LEFT JOIN dim_categories_juridiques jur ON f.uniteLegale_categorieJuridiqueUniteLegaleNiv2 = jur.categorie_juridique_ul_niv2
  WHERE f.code_ape = {_q(model.FOCUS_CODE)} AND f.periode_etatAdministratifEtablissement = 'A'
),
v2_t AS (SELECT *, score_territoire + score_taille + score_juridique AS score_total FROM v2_base),
v2 AS (SELECT *, CASE WHEN score_total >= 80 THEN 'Très fort potentiel' WHEN score_total >= 60 THEN 'Fort potentiel'
  WHEN score_total >= 40 THEN 'Potentiel moyen' ELSE 'Potentiel faible' END AS categorie_potentiel FROM v2_t)"""


def with_model(select: str, versions: tuple[str, ...] = ("1.6",)) -> str:
    """Prefix a SELECT with the model CTEs (dimensions, full table, scored views
    ``scored`` for v1.6 and ``scored_v1x`` for other versions)."""
    parts = [dims_ctes(), raw_siret_sql(), full_sql()]
    for v in versions:
        if v == "v2":
            parts.append(_v2_sql())
            continue
        parts.append(_scored_sql(v, "scored" if v == "1.6" else "scored_v" + v.replace(".", "")))
    return "WITH " + ",".join(parts) + "\n" + select
