"""The registry data model laid over the driver's star tables.


    entity (SIREN)              customer.c_custkey / orders.o_custkey
    establishment (SIRET)       orders.o_orderkey
    active establishment        o_totalprice >= 5000
    activity code               customer.c_mktsegment
    establishment headcount     band of o_totalprice (16 bands of 31,250)
    entity headcount            band of c_acctbal + 1000 (16 bands of 687.5)
    legal category / prefix     o_orderpriority / its first character
    commune code -> department  built from o_custkey / o_orderkey, with blank,
                                [ND], Corsican and overseas codes mixed in
    department dimension        nation + region, a territorial profile per
                                region (one region left out), population =
                                customers per nation
    Lambert coordinates         built from o_orderkey, some missing or [ND]
    creation dates              o_orderdate; entity = first order date

Every table here is a lazy DataFrame over the parquet files; nothing is
collected. The establishment table ``full`` has the registry's flattened column
names, so the scored views run unchanged on real registry data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import band_from_edges
from ..operators.groups import ROWS_PER_TASK_CONF, TOTAL, SaltPlan
from ..operators.star import bounded
from ..rules import bands
from ..sources.readers import read_table
from . import cleaning, views

# FIXED VALUES of the model (our choice, mirrored by the SQL oracle).
REGION_PROFILE = (            # region -> territorial profile, rank; MIDDLE EAST left out
    ("EUROPE", "Très urbain", 4),
    ("AMERICA", "Urbain", 3),
    ("ASIA", "Péri-urbain", 2),
    ("AFRICA", "Rural", 1),
)
SEGMENT_ACTIVITY = (          # code, label, division, family, priority; HOUSEHOLD left out
    ("BUILDING", "Construction de bâtiments", "41", "Gros oeuvre", 25),
    ("FURNITURE", "Fabrication de meubles", "31", "Second oeuvre", 20),
    ("MACHINERY", "Travaux mécaniques", "43", "Second oeuvre", 10),
    ("AUTOMOBILE", "Réparation automobile", "45", "Hors périmètre", 0),
)
# An establishment's own activity code, by order key: mostly not its entity's, one without a label.
OWN_CODES = tuple(r[0] for r in SEGMENT_ACTIVITY) + ("99.99Z",)
RETAINED_SEGMENTS = ("BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD")
LEGAL_FAMILIES = (            # legal prefix -> family, label; prefix 5 left out
    ("1", "Société commerciale", "Société par actions simplifiée"),
    ("2", "Entrepreneur individuel", "Entrepreneur individuel"),
    ("3", "Société civile", "Société civile"),
    ("4", "Association et fondation", "Association déclarée"),
)
ACTIVE_MIN_PRICE = 5000.0
PRICE_BAND_WIDTH = 31250.0
ACCTBAL_BAND_WIDTH = 687.5
ACCTBAL_OFFSET = 1000.0
REF_DATE = "2002-01-01"
FOCUS_CODE = "BUILDING"       # the single-code view's activity code
COORD_DECIMALS = 9
MAX_NATIONS = 10_000          # broadcast bound for nation / region rows


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


_MEMO: dict = {}
_MEMO_SIZE = 64


def memo(spark: SparkSession, key: tuple, build):
    """Reuse a lazily built DataFrame (a plan, not data) within one session.

    Queries of the catalogue share the model's base frames; building them once
    per session, input folder and salt setting keeps driver-side planning off the hot path.
    The oldest entries go first; plans of other sessions go at once."""
    salt = spark.conf.get(ROWS_PER_TASK_CONF, "")
    session = (id(spark), spark.sparkContext.applicationId)
    for k in [k for k in _MEMO if k[:2] != session]:
        del _MEMO[k]
    k = session + (salt,) + key
    if k not in _MEMO:
        while len(_MEMO) >= _MEMO_SIZE:
            del _MEMO[next(iter(_MEMO))]
        _MEMO[k] = build()
    return _MEMO[k]


# --- dimensions --------------------------------------------------------------

def dim_departements(spark: SparkSession, d: str) -> DataFrame:
    """Department dimension: one row per nation of a profiled region."""
    return memo(spark, ("dim_departements", d), lambda: _dim_departements(spark, d))


def _dim_departements(spark: SparkSession, d: str) -> DataFrame:
    # At most one row per nation: the bound is checked once on the nation table.
    nation = bounded(_t(spark, d, "nation"), MAX_NATIONS)
    region = _t(spark, d, "region")
    prof = spark.createDataFrame(list(REGION_PROFILE),
                                 "r_name string, profil_territorial string, profil_territorial_ordre int")
    pop = (_t(spark, d, "customer").groupBy("c_nationkey")
           .agg(F.count(F.lit(1)).alias("population_2022")))
    area = (_t(spark, d, "supplier").groupBy("s_nationkey")
            .agg((F.count(F.lit(1)) * F.lit(1000.0)).alias("km2")))
    return (nation.join(bounded(region, MAX_NATIONS), nation.n_regionkey == region.r_regionkey)
            .join(F.broadcast(prof), "r_name")
            .join(pop, nation.n_nationkey == pop.c_nationkey, "left")
            .join(area, nation.n_nationkey == area.s_nationkey, "left")
            .select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("dep"),
                    F.col("n_name").alias("dep_name"),
                    F.concat(F.lit("CHEF-LIEU "), F.col("n_name")).alias("prefecture"),
                    F.col("r_name").alias("region"),
                    F.coalesce(F.col("km2"), F.lit(0.0)).alias("km2"),
                    F.coalesce(F.col("population_2022"), F.lit(0)).cast("bigint").alias("population_2022"),
                    "profil_territorial", "profil_territorial_ordre"))


def dim_codes_ape(spark: SparkSession) -> DataFrame:
    rows = [(c, lab, div, f"Division {div}", fam, lab.split(" ")[0], s) for c, lab, div, fam, s in SEGMENT_ACTIVITY]
    return spark.createDataFrame(rows, "code_ape string, libelle_ape string, division_ape string, "
                                       "division_libelle string, famille_metier string, "
                                       "nom_commun_metier string, score_priorite int")


def dim_categories_effectifs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(bands.HEADCOUNT_BANDS), "tranche_effectifs string, Employes string")


def dim_categories_juridiques(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEGAL_FAMILIES),
                                 "categorie_juridique_ul_niv2 string, famille_juridique string, Libelle string")


def dim_anciennete(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(bands.AGE_DIMENSION),
                                 "anciennete_id string, libelle string, borne_min_annees int, "
                                 "borne_max_annees int, ordre int")


def dimensions(spark: SparkSession, d: str) -> dict:
    """The five dimensions; all have a size bound known at construction (fixed
    rule rows, or one row per nation checked in ``dim_departements``)."""
    return memo(spark, ("dimensions", d), lambda: _dimensions(spark, d))


def _dimensions(spark: SparkSession, d: str) -> dict:
    out = {
        "dim_departements": dim_departements(spark, d),
        "dim_codes_ape": dim_codes_ape(spark),
        "dim_categories_effectifs": dim_categories_effectifs(spark),
        "dim_categories_juridiques": dim_categories_juridiques(spark),
        "dim_anciennete": dim_anciennete(spark),
    }
    # fixed rule tables are bounded by construction; the departments by the nations, which are counted
    few = _t(spark, d, "nation").limit(MAX_NATIONS + 1).count() <= MAX_NATIONS
    out["__checked__"] = frozenset(k for k in out if few or k != "dim_departements")
    return out


# --- fact grains ---------------------------------------------------------------

def _commune_code(orderkey, custkey):
    k = F.pmod(orderkey, F.lit(53))
    tail3 = F.lpad(F.pmod(orderkey, F.lit(1000)).cast("string"), 3, "0")
    tail2 = F.lpad(F.pmod(orderkey, F.lit(100)).cast("string"), 2, "0")
    return (F.when(k == 0, F.lit(None).cast("string"))
            .when(k == 1, F.lit(""))
            .when(k == 2, F.lit(" [ND] "))
            .when(k == 3, F.concat(F.lit("2a"), tail3))
            .when(k == 4, F.concat(F.lit("2B"), tail3))
            .when(k == 5, F.concat(F.lit("974"), tail2))
            .when(k == 6, F.concat(F.lit("988"), tail2))
            .otherwise(F.concat(F.lpad(F.pmod(custkey, F.lit(25)).cast("string"), 2, "0"), tail3)))


def _lambert(orderkey, axis: str):
    base, mult, span = (100000, 7919, 1100000) if axis == "x" else (6050000, 104723, 1050000)
    v = (F.lit(base) + F.pmod(orderkey * F.lit(mult), F.lit(span))).cast("string")
    return (F.when(F.pmod(orderkey, F.lit(13)) == 0, F.lit("[ND]"))
            .when(F.pmod(orderkey, F.lit(11)) == 0, F.lit(None).cast("string"))
            .otherwise(v))


def raw_siret(spark: SparkSession, d: str) -> DataFrame:
    """Establishment grain before cleaning (active and inactive rows)."""
    o = _t(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("siret"),
        F.col("o_custkey").alias("siren"),
        F.to_date("o_orderdate").alias("dateCreationEtablissement"),
        band_from_edges(F.col("o_totalprice"), PRICE_BAND_WIDTH, bands.HEADCOUNT_CODES)
        .alias("trancheEffectifsEtablissement"),
        (F.pmod(F.col("o_orderkey"), F.lit(7)) == 0).alias("etablissementSiege"),
        F.element_at(F.array(*[F.lit(c) for c in OWN_CODES]), (F.pmod("o_orderkey", F.lit(len(OWN_CODES))) + 1).cast("int"))
        .alias("periode_activitePrincipaleEtablissement"),
        F.when(F.col("o_totalprice") >= ACTIVE_MIN_PRICE, F.lit("A")).otherwise(F.lit("F"))
        .alias("periode_etatAdministratifEtablissement"),
        F.col("o_orderpriority").alias("uniteLegale_categorieJuridiqueUniteLegale"),
        F.substring("o_orderpriority", 1, 1).alias("uniteLegale_categorieJuridiqueUniteLegaleNiv2"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(150)) == 0, F.lit(None).cast("string"))
        .otherwise(F.pmod(F.col("o_orderkey"), F.lit(150)).cast("string"))
        .alias("adresseEtablissement_numeroVoieEtablissement"),
        F.element_at(F.array(F.lit("RUE"), F.lit("AV"), F.lit("BD"), F.lit("CHE"), F.lit(None).cast("string")),
                     (F.pmod(F.col("o_orderkey"), F.lit(5)) + 1).cast("int"))
        .alias("adresseEtablissement_typeVoieEtablissement"),
        F.concat(F.lit("DES ARTISANS "), F.pmod(F.col("o_orderkey"), F.lit(97)).cast("string"))
        .alias("adresseEtablissement_libelleVoieEtablissement"),
        F.lpad(F.pmod(F.col("o_custkey") * F.lit(7), F.lit(95000)).cast("string"), 5, "0")
        .alias("adresseEtablissement_codePostalEtablissement"),
        F.concat(F.lit("COMMUNE "), F.pmod(F.col("o_custkey"), F.lit(25)).cast("string"))
        .alias("adresseEtablissement_libelleCommuneEtablissement"),
        _commune_code(F.col("o_orderkey"), F.col("o_custkey")).alias("adresseEtablissement_codeCommuneEtablissement"),
        _lambert(F.col("o_orderkey"), "x").alias("adresseEtablissement_coordonneeLambertAbscisseEtablissement"),
        _lambert(F.col("o_orderkey"), "y").alias("adresseEtablissement_coordonneeLambertOrdonneeEtablissement"),
    )


def with_geo(siret: DataFrame) -> DataFrame:
    """The cleaning step's geo chain. Published coordinates keep 9 decimals (0.1 mm):
    engines' libm differ in the last bits."""
    return cleaning.enrich_geo(siret, decimals=COORD_DECIMALS)


def entity_counts(active_siret: DataFrame) -> DataFrame:
    """Active establishments and first creation date per entity (partial
    aggregation: a hot entity ships one partial row per map task); the sum of
    ``__points`` too where the rows have it."""
    points = [F.sum("__points").alias(TOTAL)] if "__points" in active_siret.columns else []
    return (active_siret.groupBy("siren")
            .agg(F.count(F.lit(1)).alias("nb_etablissements"),
                 F.min("dateCreationEtablissement").alias("uniteLegale_dateCreationUniteLegale"), *points))


def siren_table(spark: SparkSession, d: str, active_siret: DataFrame, per: DataFrame | None = None) -> DataFrame:
    """Entity grain: customer attributes, establishment count (active sites) and
    first establishment date. Joins two entity-sized inputs; the fact is only
    pre-aggregated (partial aggregation), never shuffled whole here."""
    c = _t(spark, d, "customer")
    per = per if per is not None else entity_counts(active_siret)
    ent = c.select(
        F.col("c_custkey").alias("siren"),
        F.col("c_name").alias("uniteLegale_denominationUniteLegale"),
        F.col("c_mktsegment").alias("uniteLegale_activitePrincipaleUniteLegale"),
        band_from_edges(F.col("c_acctbal"), ACCTBAL_BAND_WIDTH, bands.HEADCOUNT_CODES, ACCTBAL_OFFSET)
        .alias("uniteLegale_trancheEffectifsUniteLegale"),
        F.lit("A").alias("uniteLegale_etatAdministratifUniteLegale"),
    )
    return ent.join(per, "siren", "inner")


def full(spark: SparkSession, d: str, rows_per_task: int | None = None) -> tuple[DataFrame, SaltPlan]:
    """Establishment ⟕ entity on ``siren`` for active establishments, with the
    salt plan of the fact (reused by the scored view so the fact is shuffled once)."""
    return memo(spark, ("full", d, rows_per_task), lambda: _full(spark, d, rows_per_task))


def _full(spark: SparkSession, d: str, rows_per_task: int | None = None) -> tuple[DataFrame, SaltPlan]:
    s = with_geo(raw_siret(spark, d)).where(F.col("periode_etatAdministratifEtablissement") == "A")
    per = entity_counts(views.site_points(s, dimensions(spark, d)))
    ent = siren_table(spark, d, s, per)
    # hot entities straight from the counts: no entity join needed to find them
    plan = SaltPlan.from_counts(per, ["siren"], "nb_etablissements", rows_per_task)
    out = plan.join(s, ent, "inner", salt_from=["siret"])
    out = out.withColumn("code_ape", F.col("uniteLegale_activitePrincipaleUniteLegale"))
    return out, plan


def enriched_siret(siret: DataFrame, ref_date: str = REF_DATE) -> DataFrame:
    """The cleaning step's establishment chain under the model's sector codes."""
    return cleaning.enrich_siret(siret, ref_date, RETAINED_SEGMENTS)


def enriched_full(spark: SparkSession, d: str) -> DataFrame:
    """``full`` with both grains' enrichment, as the pipeline publishes it."""
    return cleaning.enrich_siren(enriched_siret(full(spark, d)[0]), REF_DATE)
