"""Registry pipeline on nested records, writers, manifest, streaming."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tessera.plans import cleaning
from tessera.sources import manifest as mf
from tessera.sources.readers import read_partitioned, read_raw_json
from tessera.sources.writers import publish
from tessera.streaming.ingest import ingest_pages


def _rec(siret, siren, periods, siege=False, commune="75056", band="12", legal="5710", code="43.22B"):
    return {"siret": siret, "siren": siren, "dateCreationEtablissement": "2015-06-01",
            "trancheEffectifsEtablissement": band, "etablissementSiege": siege,
            "uniteLegale": {"categorieJuridiqueUniteLegale": legal, "denominationUniteLegale": f"ENT {siren}",
                            "activitePrincipaleUniteLegale": code, "trancheEffectifsUniteLegale": "21",
                            "dateCreationUniteLegale": "garbage"},
            "adresseEtablissement": {"codeCommuneEtablissement": commune,
                                     "coordonneeLambertAbscisseEtablissement": "700000",
                                     "coordonneeLambertOrdonneeEtablissement": "[ND]"},
            "periodesEtablissement": periods}


def test_registry_chain(spark):
    d = tempfile.mkdtemp(prefix="tessera-reg-")
    recs = [
        _rec("1", "A", [{"dateDebut": "2020-01-01", "etatAdministratifEtablissement": "F"},
                        {"dateDebut": "2021-01-01", "etatAdministratifEtablissement": "A"},
                        {"dateDebut": "2021-01-01", "etatAdministratifEtablissement": "F"}], siege=False),
        _rec("2", "A", [{"dateDebut": None, "etatAdministratifEtablissement": "A"}], siege=True, commune="2a004"),
        _rec("3", "A", [{"dateDebut": "2022-01-01", "etatAdministratifEtablissement": "F"}]),   # closed
        _rec("4", "B", [], commune=" [ND] "),                                                    # no history
    ]
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    out = cleaning.run(read_raw_json(spark, d), "2024-01-01")
    clean = {r.siret: r for r in out["clean"].collect()}
    assert set(clean) == {"1", "2"}                  # tie keeps the first 2021 period (A); 3 closed; 4 empty
    assert clean["2"].uniteLegale_dateCreationUniteLegale is None   # tolerant date parse
    siren = {r.siren: r for r in out["siren"].collect()}
    assert siren["A"].nb_etablissements == 2        # active establishments only
    full = {r.siret: r for r in out["full"].collect()}
    assert full["2"].departement == "2A" and full["1"].departement == "75"
    assert full["1"].longitude is None               # y is [ND]
    assert full["1"].uniteLegale_categorieJuridiqueUniteLegaleNiv2 == "57"
    assert full["1"].type_activite_etab == "Autres"  # period activity is null in the fixture


def test_publish_dynamic_overwrite(spark):
    d = tempfile.mkdtemp(prefix="tessera-pub-")
    df = spark.createDataFrame([(1, "a", "75"), (2, "b", "69"), (3, "a", "13")], "id int, code_ape string, departement string")
    publish(df, d, "overwrite", ("code_ape",), ("departement",))
    publish(df.where("code_ape = 'a'").limit(1), d, "overwrite", ("code_ape",))
    got = {r.code_ape: r.n for r in spark.read.parquet(d).groupBy("code_ape").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 1, "b": 1}                   # only partition a was replaced
    assert read_partitioned(spark, d, "b").count() == 1
    d2 = tempfile.mkdtemp(prefix="tessera-pub-day-")
    ts = df.withColumn("maj", F.to_timestamp(F.lit("2024-05-01 10:00:00")))
    publish(ts, d2, "overwrite", ("code_ape",), ("zz_missing",), day_partition="maj")
    assert os.path.isdir(os.path.join(d2, "code_ape=a", "maj_jour=2024-05-01"))


def test_manifest_and_freshness(spark):
    d = tempfile.mkdtemp(prefix="tessera-man-")
    rows = spark.createDataFrame(
        [("c1", "2024-01-01 00:00:00", "completed", 5), ("c1", "2024-02-20 00:00:00", "completed", 6),
         ("c2", "2024-02-01 00:00:00", "partial", 3), ("c3", "2024-01-10 00:00:00", "completed", 1),
         ("c4", "2024-01-31 00:00:00", "completed", 1)],
        "code_ape string, extraction_date string, status string, nb_etablissements long") \
        .withColumn("extraction_date", F.to_timestamp("extraction_date"))
    mf.append_manifest(rows, os.path.join(d, "m"))
    latest = mf.latest_per_code(mf.read_manifest(spark, os.path.join(d, "m")))
    codes = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",), ("c5",), ("c6",)], "code_ape string")
    present = spark.createDataFrame([("c1",), ("c2",), ("c3",), ("c4",), ("c6",)], "code_ape string")
    dec = {r.code_ape: (r.should_extract, r.reason) for r in
           mf.freshness(codes, latest, present, F.lit("2024-03-01 00:00:00").cast("timestamp"), 30).collect()}
    assert dec["c1"] == (False, "Données récentes (10j)")
    assert dec["c2"] == (True, mf.R_PARTIAL)
    assert dec["c3"] == (True, "Données anciennes (51j > 30j)")
    assert dec["c4"] == (False, "Données récentes (30j)")   # 30 days is still fresh
    assert dec["c5"] == (True, mf.R_NO_FILE)
    assert dec["c6"] == (True, mf.R_NO_META)
    # a manifest whose date does not parse asks for a refresh
    bad = spark.createDataFrame([("c1", "not a date", "completed")], "code_ape string, d string, status string")
    r = mf.freshness(codes.where("code_ape = 'c1'"), bad, present, F.lit("2024-03-01").cast("timestamp"), 30,
                     raw_date="d").first()
    assert (r.should_extract, r.reason) == (True, mf.R_BAD_DATE)


def test_stream_exactly_once_and_dedup(spark):
    root = tempfile.mkdtemp(prefix="tessera-st-")
    land = os.path.join(root, "landing")
    df = spark.range(100).select(F.col("id").cast("string").alias("siret"), (F.col("id") % 7).alias("siren"))
    df.repartition(4).write.json(os.path.join(land, "p1"))
    df.where("id < 10").write.json(os.path.join(land, "p2"))       # re-landed records
    schema = df.schema
    sink, ck = os.path.join(root, "raw"), os.path.join(root, "_ck")
    for _ in range(2):   # the second run finds nothing new
        ingest_pages(spark, os.path.join(land, "*"), schema, sink, ck, files_per_trigger=2, flatten=False,
                     dedup_key="siret")
    out = spark.read.parquet(sink)
    assert out.count() == 100 and out.select("siret").distinct().count() == 100


def test_overseas_coordinates_option(spark):
    df = spark.createDataFrame([("75056", "700000", "6600000"), ("97411", "700000", "6600000")],
                               "adresseEtablissement_codeCommuneEtablissement string, "
                               "adresseEtablissement_coordonneeLambertAbscisseEtablissement string, "
                               "adresseEtablissement_coordonneeLambertOrdonneeEtablissement string")
    kept = {r.departement: r.latitude for r in cleaning.enrich_geo(df).collect()}
    nulled = {r.departement: r.latitude for r in cleaning.enrich_geo(df, overseas="null").collect()}
    assert kept["974"] is not None and nulled["974"] is None
    assert abs(nulled["75"] - 46.5) < 1e-6


def test_stream_resumes_after_new_pages(spark):
    root = tempfile.mkdtemp(prefix="tessera-st-resume-")
    land = os.path.join(root, "landing")
    df = spark.range(60).select(F.col("id").cast("string").alias("siret"), (F.col("id") % 5).alias("siren"))
    df.where("id < 40").repartition(3).write.json(os.path.join(land, "p1"))
    sink, ck = os.path.join(root, "raw"), os.path.join(root, "_ck")
    ingest_pages(spark, os.path.join(land, "*"), df.schema, sink, ck, files_per_trigger=1, flatten=False)
    assert spark.read.parquet(sink).count() == 40
    df.where("id >= 40").write.json(os.path.join(land, "p2"))          # new pages land later
    ingest_pages(spark, os.path.join(land, "*"), df.schema, sink, ck, files_per_trigger=1, flatten=False)
    out = spark.read.parquet(sink)
    assert out.count() == 60 and out.select("siret").distinct().count() == 60


def test_read_dimensions_source_layout(spark):
    from tessera.sources.readers import read_dimensions
    d = tempfile.mkdtemp(prefix="tessera-dims-")
    files = {
        "departements.csv": "dep,dep_name,prefecture,region,km2,population_2022,profil_territorial,"
                            "profil_territorial_ordre\n01,Ain,Bourg,ARA,5762.4,671289,Péri-urbain,2\n",
        "codes_ape.csv": "code_ape,libelle_ape,division_ape,division_libelle,famille_metier,nom_commun_metier,,"
                         "score_priorite\n43.22B,Chauffage,43,Travaux,Génie climatique,Chauffagiste,,25\n",
        "categories_effectifs.csv": "tranche_effectifs,Employes\nNN,0 ou inconnu\n",
        "categories_juridiques.csv": "categorie_juridique_ul_niv2,famille_juridique,Libelle\n0,Organisme,X\n"
                                     "54,Société commerciale,SARL\n",
        "anciennete.csv": "anciennete_id,libelle,borne_min_annees,borne_max_annees,ordre\nmoins_2_ans,< 2 ans,0,2,1\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    dims = read_dimensions(spark, d)
    ape = dims["dim_codes_ape"].first()
    assert "_blank" not in dims["dim_codes_ape"].columns and ape.score_priorite == 25
    keys = [r[0] for r in dims["dim_categories_juridiques"].collect()]
    assert keys == ["0", "54"]                    # strings: '0' is not the number 0 (and not '00')
    dep = dims["dim_departements"].first()
    assert dep.dep == "01" and dep.km2 == 5762.4 and dep.population_2022 == 671289
