"""Scalar, projection and cleaning-layer queries (P1..P29, S7, S10, S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    address_line, age_band, age_years, clean_code_text, department_from_commune, first_chars,
    headcount_category, safe_name, sector_type, try_date, try_double,
    valid_coordinates,
)
from ..operators.groups import latest_per_key
from ..operators.projection import (
    drop_null_columns, left_join_keep_left, select_strict, select_tolerant, spread_struct, validity_profile,
)
from ..rules import bands
from ..sources.readers import coerce_types, read_table, sanitize_columns
from . import cleaning, model
from .catalog import query
from .oracle import _band, _pmod, with_model

H = "CAST(100 AS DOUBLE)"


def _raw(spark, d):
    return model.raw_siret(spark, d)


# P1 ------------------------------------------------------------------------------
@query("p1_drop_null_columns", with_model(
    "SELECT siret, siren, trancheEffectifsEtablissement FROM raw_siret"))
def p1_drop_null_columns(spark, d):
    r = _raw(spark, d).select(
        "siret", "siren", "trancheEffectifsEtablissement",
        # entirely null in the data: no order has a negative price
        F.when(F.col("siret") < 0, F.lit("x")).alias("sigleUniteLegale"))
    return drop_null_columns(r)


# P2 ------------------------------------------------------------------------------
@query("p2_prefix_codes", """
SELECT substring(o_orderpriority, 1, 2) AS niv2, COUNT(*) AS nb_lignes
FROM orders GROUP BY 1""")
def p2_prefix_codes(spark, d):
    o = read_table(spark, d, "orders")
    return o.groupBy(first_chars("o_orderpriority", 2).alias("niv2")).agg(F.count(F.lit(1)).alias("nb_lignes"))


# P3 / P4 -------------------------------------------------------------------------
# Status history per establishment = the order's lines. The latest line by ship
# date wins; ties keep the first in line order (then the remaining fields).
# Computed as a partially aggregated min_by (no per-key array is materialised);
# ``functions.latest_struct`` is the same rule for array-shaped input (registry
# JSON, see plans/cleaning.py and the tests).
def _latest_line(spark, d):
    li = read_table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("rang"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("dateDebut"),
        F.col("l_linestatus").alias("etatAdministratifEtablissement"),
        F.col("l_returnflag").alias("activitePrincipaleEtablissement"), "l_shipdate")
    return latest_per_key(li, ["l_orderkey"], ["rang", "dateDebut", "etatAdministratifEtablissement",
                                               "activitePrincipaleEtablissement"],
                          F.to_date("l_shipdate"),
                          [F.col("rang"), F.col("dateDebut"), F.col("etatAdministratifEtablissement"),
                           F.col("activitePrincipaleEtablissement")])


_P3_SQL = """
SELECT l_orderkey, rang, dateDebut, etatAdministratifEtablissement, activitePrincipaleEtablissement FROM (
  SELECT l_orderkey, l_linenumber AS rang, strftime(l_shipdate, '%Y-%m-%d') AS dateDebut,
         l_linestatus AS etatAdministratifEtablissement, l_returnflag AS activitePrincipaleEtablissement,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY COALESCE(strftime(l_shipdate, '%Y-%m-%d'), '0000-00-00') DESC,
                    l_linenumber, strftime(l_shipdate, '%Y-%m-%d') NULLS FIRST, l_linestatus NULLS FIRST,
                    l_returnflag NULLS FIRST) AS rn
  FROM lineitem) t WHERE rn = 1"""


@query("p3_latest_period", _P3_SQL)
def p3_latest_period(spark, d):
    return _latest_line(spark, d).select("l_orderkey", "p.*")


@query("p4_spread_struct", _P3_SQL.replace(
    "SELECT l_orderkey, rang, dateDebut, etatAdministratifEtablissement, activitePrincipaleEtablissement FROM (",
    "SELECT l_orderkey, rang AS periode_rang, dateDebut AS periode_dateDebut, "
    "etatAdministratifEtablissement AS periode_etatAdministratifEtablissement, "
    "activitePrincipaleEtablissement AS periode_activitePrincipaleEtablissement FROM (", 1))
def p4_spread_struct(spark, d):
    return spread_struct(_latest_line(spark, d), "p", "periode_")


# P5 / P6 -------------------------------------------------------------------------
@query("p5_allow_list_strict", with_model(
    "SELECT siret, siren, dateCreationEtablissement, trancheEffectifsEtablissement FROM raw_siret"))
def p5_allow_list_strict(spark, d):
    return select_strict(_raw(spark, d), ["siret", "siren", "dateCreationEtablissement",
                                          "trancheEffectifsEtablissement"])


@query("p6_allow_list_tolerant", with_model(
    "SELECT siret, trancheEffectifsEtablissement, CAST(NULL AS VARCHAR) AS anneeEffectifsEtablissement "
    "FROM raw_siret"))
def p6_allow_list_tolerant(spark, d):
    return select_tolerant(_raw(spark, d), ["siret", "trancheEffectifsEtablissement", "anneeEffectifsEtablissement"])


# P8 / P9 -------------------------------------------------------------------------
@query("p8_tolerant_date", f"""
SELECT o_orderkey, CASE WHEN {_pmod('o_orderkey', 17)} > 4 THEN CAST(o_orderdate AS DATE) END AS date_creation
FROM orders""")
def p8_tolerant_date(spark, d):
    o = read_table(spark, d, "orders")
    k = F.pmod("o_orderkey", F.lit(17))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    txt = (F.when(k == 0, "garbage").when(k == 1, "").when(k == 2, "[ND]")
           .when(k == 3, F.concat(day, F.lit(" xx"))).when(k == 4, F.concat(day, F.lit("Tgarbage")))
           .when(k == 5, F.concat(day, F.lit("T10:20:30"))).when(k == 6, F.concat(F.lit("\t"), day, F.lit("\u00a0")))
           .when(k == 7, F.concat(day, F.lit(" 10:20:30.5"))).otherwise(day))
    return o.select("o_orderkey", txt.alias("t")).select("o_orderkey", try_date("t").alias("date_creation"))


@query("p9_tolerant_number", with_model("""
SELECT siret, TRY_CAST(trim(adresseEtablissement_coordonneeLambertAbscisseEtablissement) AS DOUBLE) AS x,
       TRY_CAST(trim(adresseEtablissement_coordonneeLambertOrdonneeEtablissement) AS DOUBLE) AS y
FROM raw_siret"""))
def p9_tolerant_number(spark, d):
    return _raw(spark, d).select(
        "siret", try_double("adresseEtablissement_coordonneeLambertAbscisseEtablissement").alias("x"),
        try_double("adresseEtablissement_coordonneeLambertOrdonneeEtablissement").alias("y"))


# P10 / P11 -----------------------------------------------------------------------
@query("p10_department_from_commune", with_model(
    "SELECT departement, COUNT(*) AS nb_lignes FROM raw_siret GROUP BY 1"))
def p10_department_from_commune(spark, d):
    r = _raw(spark, d)
    # white space of any kind around a code changes nothing
    code, k = F.col("adresseEtablissement_codeCommuneEtablissement"), F.pmod("siret", F.lit(19))
    padded = (F.when(k == 0, F.concat(F.lit("\t"), code)).when(k == 1, F.concat(F.lit("\u00a0"), code, F.lit(" \n")))
              .when(k == 2, F.concat(F.lit("\u2003"), code)).otherwise(code))
    return (r.groupBy(department_from_commune(padded).alias("departement"))
            .agg(F.count(F.lit(1)).alias("nb_lignes")))


@query("p11_department_anomaly", with_model(
    "SELECT dept_anomaly, COUNT(*) AS nb_lignes FROM geo_siret GROUP BY 1"))
def p11_department_anomaly(spark, d):
    g = model.with_geo(_raw(spark, d))
    return g.groupBy("dept_anomaly").agg(F.count(F.lit(1)).alias("nb_lignes"))


# P12 / P13 / P20 -----------------------------------------------------------------
# Rows without both coordinates come back with null longitude/latitude. (A filter
# on the result would be pushed below the staged projections with the projection
# expression substituted into it; keep the staging intact.)
@query("p12_lambert_to_wgs84", with_model("SELECT siret, longitude, latitude FROM geo_siret"))
def p12_lambert_to_wgs84(spark, d):
    return model.with_geo(_raw(spark, d)).select("siret", "longitude", "latitude")


@query("p13_coordinate_guard", """
SELECT o_orderkey,
       CASE WHEN abs(b) <= 90 AND abs(a) <= 180 THEN a END AS longitude,
       CASE WHEN abs(b) <= 90 AND abs(a) <= 180 THEN b END AS latitude
FROM (SELECT o_orderkey, o_totalprice / 1000.0 - 250.0 AS a, CAST((o_custkey % 200) - 100 AS DOUBLE) AS b
      FROM orders) t""")
def p13_coordinate_guard(spark, d):
    o = read_table(spark, d, "orders")
    a = F.col("o_totalprice") / F.lit(1000.0) - F.lit(250.0)
    b = (F.pmod("o_custkey", F.lit(200)) - 100).cast("double")
    lon, lat = valid_coordinates(a, b)
    return o.select("o_orderkey", lon.alias("longitude"), lat.alias("latitude"))


@query("p20_geo_chain", with_model(
    "SELECT siret, longitude, latitude, departement, dept_anomaly FROM geo_siret"))
def p20_geo_chain(spark, d):
    return model.with_geo(_raw(spark, d)).select("siret", "longitude", "latitude", "departement", "dept_anomaly")


# P14 / P15 -----------------------------------------------------------------------
_AGE = f"CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '{model.REF_DATE}') / 365.0) AS INTEGER)"
_AGE_BAND = ("CASE WHEN {a} IS NULL THEN NULL WHEN {a} <= 5 THEN '0-5 ans' WHEN {a} <= 10 THEN '6-10 ans' "
             "WHEN {a} <= 20 THEN '11-20 ans' ELSE '20+ ans' END")


@query("p14_age_years", f"SELECT o_orderkey, {_AGE} AS anciennete_annees FROM orders")
def p14_age_years(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", age_years("o_orderdate", model.REF_DATE).alias("anciennete_annees"))


@query("p15_age_band", f"""
SELECT tranche, COUNT(*) AS nb_lignes FROM (
  SELECT {_AGE_BAND.format(a='a')} AS tranche FROM (SELECT {_AGE} AS a FROM orders) t) u GROUP BY 1""")
def p15_age_band(spark, d):
    o = read_table(spark, d, "orders")
    a = age_years("o_orderdate", model.REF_DATE)
    return o.groupBy(age_band(a).alias("tranche")).agg(F.count(F.lit(1)).alias("nb_lignes"))


# P16 / P17 -----------------------------------------------------------------------
def _cat_sql(c: str) -> str:
    arms = " ".join(f"WHEN trim({c}) IN ({', '.join(repr(x) for x in codes)}) THEN '{lab}'"
                    for lab, codes in bands.HEADCOUNT_CATEGORIES)
    return f"CASE {arms} END"


@query("p16_headcount_category", f"""
SELECT categorie, COUNT(*) AS nb_lignes FROM (SELECT {_cat_sql('b')} AS categorie
  FROM (SELECT {_band('o_totalprice', model.PRICE_BAND_WIDTH)} AS b FROM orders) t) u GROUP BY 1""")
def p16_headcount_category(spark, d):
    r = _raw(spark, d)
    # some codes carry stray white space; the category ignores it
    code, k = F.col("trancheEffectifsEtablissement"), F.pmod("siret", F.lit(9))
    b = F.when(k == 0, F.concat(F.lit(" "), code, F.lit(" "))).when(k == 1, F.concat(F.lit("\t"), code, F.lit("\u00a0"))).otherwise(code)
    return r.groupBy(headcount_category(b).alias("categorie")).agg(F.count(F.lit(1)).alias("nb_lignes"))


@query("p17_sector_type", f"""
SELECT CASE WHEN c_mktsegment IN ({', '.join(repr(s) for s in model.RETAINED_SEGMENTS)}) THEN 'BTP' ELSE 'Autres' END
  AS type_activite, COUNT(*) AS nb_lignes FROM customer GROUP BY 1""")
def p17_sector_type(spark, d):
    c = read_table(spark, d, "customer")
    return (c.groupBy(sector_type("c_mktsegment", model.RETAINED_SEGMENTS).alias("type_activite"))
            .agg(F.count(F.lit(1)).alias("nb_lignes")))


# Enrichment chains ------------------------------------------------------
@query("p18_enrich_siret", with_model(f"""
SELECT siret, anciennete_etab_annees, {_AGE_BAND.format(a='anciennete_etab_annees')} AS tranche_anciennete_etab,
       {_cat_sql('trancheEffectifsEtablissement')} AS categorie_effectifs_etab,
       substring(periode_activitePrincipaleEtablissement, 1, 2) AS division_ape_etab,
       CASE WHEN periode_activitePrincipaleEtablissement IN ({', '.join(repr(s) for s in model.RETAINED_SEGMENTS)})
         THEN 'BTP' ELSE 'Autres' END AS type_activite_etab
FROM (SELECT siret, trancheEffectifsEtablissement, periode_activitePrincipaleEtablissement,
        CAST(floor(date_diff('day', dateCreationEtablissement, DATE '{model.REF_DATE}') / 365.0) AS INTEGER)
          AS anciennete_etab_annees FROM raw_siret) t"""))
def p18_enrich_siret(spark, d):
    e = model.enriched_siret(_raw(spark, d))
    return e.select("siret", "anciennete_etab_annees", "tranche_anciennete_etab", "categorie_effectifs_etab",
                    "division_ape_etab", "type_activite_etab")


@query("p19_enrich_siren", with_model(f"""
SELECT siren, anciennete_ul_annees, {_AGE_BAND.format(a='anciennete_ul_annees')} AS tranche_anciennete_ul,
       {_cat_sql('uniteLegale_trancheEffectifsUniteLegale')} AS categorie_effectifs_ul
FROM (SELECT siren, uniteLegale_trancheEffectifsUniteLegale,
        CAST(floor(date_diff('day', uniteLegale_dateCreationUniteLegale, DATE '{model.REF_DATE}') / 365.0) AS INTEGER)
          AS anciennete_ul_annees FROM siren_t) t"""))
def p19_enrich_siren(spark, d):
    s = model.with_geo(_raw(spark, d)).where(F.col("periode_etatAdministratifEtablissement") == "A")
    e = cleaning.enrich_siren(model.siren_table(spark, d, s), model.REF_DATE)
    return e.select("siren", "anciennete_ul_annees", "tranche_anciennete_ul", "categorie_effectifs_ul")


# P21 -----------------------------------------------------------------------------
@query("p21_address_line", with_model("""
SELECT siret, CONCAT(COALESCE(adresseEtablissement_numeroVoieEtablissement, ''), ' ',
  COALESCE(adresseEtablissement_typeVoieEtablissement, ''), ' ',
  COALESCE(adresseEtablissement_libelleVoieEtablissement, ''), ', ',
  COALESCE(adresseEtablissement_codePostalEtablissement, ''), ' ',
  COALESCE(adresseEtablissement_libelleCommuneEtablissement, '')) AS adresse_complete FROM raw_siret"""))
def p21_address_line(spark, d):
    r = _raw(spark, d)
    return r.select("siret", address_line(
        "adresseEtablissement_numeroVoieEtablissement", "adresseEtablissement_typeVoieEtablissement",
        "adresseEtablissement_libelleVoieEtablissement", "adresseEtablissement_codePostalEtablissement",
        "adresseEtablissement_libelleCommuneEtablissement").alias("adresse_complete"))


# P26 -----------------------------------------------------------------------------
def _map_sql(c: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in pairs) + " END"


@query("p26_profile_labels", with_model(f"""
SELECT dep, profil_territorial, {_map_sql('profil_territorial', bands.PROFILE_MARKET_POTENTIAL)} AS potentiel_marche,
       {_map_sql('profil_territorial', bands.PROFILE_REFERENCE_DENSITY)} AS densite_reference
FROM dim_departements"""))
def p26_profile_labels(spark, d):
    dep = model.dim_departements(spark, d)

    def m(pairs):
        out = None
        for k, v in pairs:
            out = F.when(F.col("profil_territorial") == k, v) if out is None else out.when(F.col("profil_territorial") == k, v)
        return out
    return dep.select("dep", "profil_territorial", m(bands.PROFILE_MARKET_POTENTIAL).alias("potentiel_marche"),
                      m(bands.PROFILE_REFERENCE_DENSITY).alias("densite_reference"))


# Establishment ⟕ entity, left wins, helper columns dropped ---------------------
@query("p27_join_drop_suffix", with_model("""
SELECT s.siret, s.siren, s.periode_etatAdministratifEtablissement, e.nb_etablissements
FROM active_siret s LEFT JOIN siren_t e ON s.siren = e.siren"""))
def p27_join_drop_suffix(spark, d):
    s = model.with_geo(_raw(spark, d)).where(F.col("periode_etatAdministratifEtablissement") == "A")
    e = model.siren_table(spark, d, s).select(
        "siren", "nb_etablissements",
        F.lit("X").alias("periode_etatAdministratifEtablissement"))  # clashes: left value must win
    return left_join_keep_left(s.select("siret", "siren", "periode_etatAdministratifEtablissement"), e, "siren")


# Runtime type check, with engine-neutral type names and the values that have it ----
_NEUTRAL = {"bigint": "entier", "int": "entier", "double": "decimal", "date": "date", "boolean": "booleen", "string": "texte"}
_P28 = (("siret", "entier"), ("dateCreationEtablissement", "date"), ("etablissementSiege", "booleen"),
        ("uniteLegale_categorieJuridiqueUniteLegaleNiv2", "texte"))
_P28_DUCK = {"BIGINT": "entier", "INTEGER": "entier", "DOUBLE": "decimal", "DATE": "date", "BOOLEAN": "booleen", "VARCHAR": "texte"}


@query("p28_type_check", with_model(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, CASE MAX(typeof({c})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _P28_DUCK.items())
    + f" END AS type_observe, '{t}' AS type_attendu, COUNT({c}) AS nb_valides FROM raw_siret" for c, t in _P28)))
def p28_type_check(spark, d):
    v = _raw(spark, d).select(*[c for c, _ in _P28])
    kinds = dict(v.dtypes)                    # from the schema: an empty table has types too
    one = v.agg(*[F.count(c).alias(c) for c, _ in _P28])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.lit(_NEUTRAL.get(kinds[c], kinds[c])).alias("type_observe"),
                 F.lit(t).alias("type_attendu"), F.col(c).alias("nb_valides")) for c, t in _P28])).alias("r")).select("r.*")


# Valid-value counts and rates, one pass ----------------------------------------
_P29_COLS = ["longitude", "latitude", "departement", "adresseEtablissement_numeroVoieEtablissement"]


@query("p29_validity_rates", with_model(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, COUNT({c}) AS nb_valides, COUNT(*) AS nb_total, "
    f"COUNT({c}) * {H} / COUNT(*) AS pct_valides FROM geo_siret" for c in _P29_COLS)))
def p29_validity_rates(spark, d):
    return validity_profile(model.with_geo(_raw(spark, d)), _P29_COLS)


# A code column read as a number back to text ------------------------------------
@query("s7_code_text_repair", """
SELECT regexp_replace(CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR), '\\.0$', '') AS code, COUNT(*) AS nb_lignes
FROM customer GROUP BY 1""")
def s7_code_text_repair(spark, d):
    c = read_table(spark, d, "customer")
    return (c.groupBy(clean_code_text(F.col("c_nationkey").cast("double")).alias("code"))
            .agg(F.count(F.lit(1)).alias("nb_lignes")))


# Warehouse-safe names ------------------------------------------------------------
@query("s10_safe_column_names", """
SELECT o_orderkey AS uniteLegale_siren, o_orderpriority AS priorite__code_, o_totalprice AS montant_total_
FROM orders""")
def s10_safe_column_names(spark, d):
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("uniteLegale.siren"), F.col("o_orderpriority").alias("priorite (code)"),
        F.col("o_totalprice").alias("montant-total€"))
    assert safe_name("a.b c") == "a_b_c"
    return sanitize_columns(o)


# Name-driven tolerant typing ------------------------------------------------------
@query("s11_name_driven_types", f"""
SELECT o_orderkey AS siret,
       CASE WHEN {_pmod('o_orderkey', 17)} > 4 THEN CAST(o_orderdate AS DATE) END AS dateCreationEtablissement,
       TRY_CAST(CASE WHEN {_pmod('o_orderkey', 5)} = 0 THEN '[ND]' ELSE CAST(year(o_orderdate) AS VARCHAR) END
                AS INTEGER) AS anneeEffectifsEtablissement,
       TRY_CAST(CAST(o_totalprice / 10000.0 AS VARCHAR) AS DOUBLE) AS longitude,
       TRY_CAST(CASE WHEN {_pmod('o_orderkey', 2)} = 0 THEN 'true' ELSE 'false' END AS BOOLEAN) AS etablissementSiege,
       o_orderpriority AS categorie
FROM orders""")
def s11_name_driven_types(spark, d):
    o = read_table(spark, d, "orders")
    k = F.pmod("o_orderkey", F.lit(17))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    txt = (F.when(k == 0, "garbage").when(k == 1, "").when(k == 2, "[ND]")
           .when(k == 3, F.concat(day, F.lit(" xx"))).when(k == 4, F.concat(day, F.lit("Tgarbage")))
           .when(k == 5, F.concat(day, F.lit("T10:20:30"))).when(k == 6, F.concat(F.lit("\t"), day, F.lit("\u00a0")))
           .when(k == 7, F.concat(day, F.lit(" 10:20:30.5"))).otherwise(day))
    s = o.select(
        F.col("o_orderkey").alias("siret"), txt.alias("dateCreationEtablissement"),
        F.when(F.pmod("o_orderkey", F.lit(5)) == 0, F.lit("[ND]")).otherwise(F.year("o_orderdate").cast("string"))
        .alias("anneeEffectifsEtablissement"),
        (F.col("o_totalprice") / F.lit(10000.0)).cast("string").alias("longitude"),
        F.when(F.pmod("o_orderkey", F.lit(2)) == 0, "true").otherwise("false").alias("etablissementSiege"),
        F.col("o_orderpriority").alias("categorie"))
    return coerce_types(s)

