"""Branches that the driver's tables never reach: reasons, outcomes, failing reports, storage contract."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.functions import age_band, department_from_commune, headcount_category, try_date
from tessera.operators.quality import check
from tessera.plans import cleaning, model
from tessera.session import ensure_checkpoint_dir
from tessera.sources import manifest as mf
from tessera.sources.readers import path_exists, read_partitioned

NOW = dt.datetime(2024, 3, 1)


def decisions(spark):
    codes = spark.createDataFrame([(c,) for c in "ABCDEFG"], "code_ape string")
    latest = spark.createDataFrame([("C", "2024-02-20 00:00:00", "partial"), ("D", "not a date", "completed"),
                                    ("E", "2024-01-01 00:00:00", "completed"), ("F", "2024-02-20 00:00:00", "completed"),
                                    ("A", "2024-02-20 00:00:00", "completed"), ("G", "2024-01-31 00:00:00", "completed")],
                                   "code_ape string, d string, status string")
    present = spark.createDataFrame([(c,) for c in "BCDEFG"], "code_ape string")
    return mf.freshness(codes, latest, present, F.lit(NOW), 30, raw_date="d")


def test_all_freshness_reasons(spark):
    got = {r.code_ape: (r.should_extract, r.reason) for r in decisions(spark).collect()}
    assert got == {"A": (True, mf.R_NO_FILE), "B": (True, mf.R_NO_META), "C": (True, mf.R_PARTIAL), "D": (True, mf.R_BAD_DATE),
                   "E": (True, "Données anciennes (60j > 30j)"), "F": (False, "Données récentes (10j)"),
                   "G": (False, "Données récentes (30j)")}


def test_all_outcomes(spark):
    results = spark.createDataFrame([("A", 5), ("B", 0), ("E", 7), ("F", 9)], "code_ape string, nb_extraits int")
    got = {r.outcome: r.codes for r in mf.outcome_summary(decisions(spark), results).collect()}
    assert got == {"success": "A", "errors": "B,C,D", "updated": "E", "skipped": "F,G"}
    forced = {r.outcome: r.codes for r in mf.outcome_summary(decisions(spark), results, force=True).collect()}
    assert forced == {"success": "A,F", "errors": "B,C,D,G", "updated": "E"}


def test_latest_attempt_on_a_tie(spark):
    rows = [("A", NOW, "partial", 9), ("A", NOW, "completed", 5), ("A", NOW, "completed", 7), ("A", dt.datetime(2023, 1, 1), "completed", 99)]
    latest = mf.latest_per_code(spark.createDataFrame(rows, "code_ape string, extraction_date timestamp, status string, nb_etablissements long"))
    assert [tuple(r)[2:] for r in latest.collect()] == [("completed", 7)]


def test_publish_report_lists_failures(spark):
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "code_ape string")
    published = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("C", 2), ("X", 8)], "code_ape string, siren long")
    got = {r.code_ape: tuple(r)[1:] for r in mf.publish_report(wanted, published).collect()}
    assert got == {"A": (3, 2, "success", None), "B": (0, 0, "error", "aucune donnée publiée"), "C": (1, 1, "success", None),
                   "TOTAL": (4, 2, "1 en erreur sur 3", None)}


def test_a_check_without_data_is_not_ok(spark):
    agg = spark.createDataFrame([(1.0,)], "x double").where("x > 1").agg(F.max("x").alias("x"))
    assert check(agg, "c", F.col("x"), F.lit("1"), F.col("x") == 1).first().statut == "AUCUNE DONNEE"


def test_missing_data_raises_on_any_file_system(spark):
    root = tempfile.mkdtemp(prefix="tessera-parts-")
    spark.createDataFrame([("a b/c", 1), ("x", 2)], "code_ape string, v int").write.mode("overwrite").partitionBy("code_ape").parquet(root)
    for base in (root, f"file://{root}"):
        assert read_partitioned(spark, base, "a b/c").count() == 1
        for missing in ((base, "nope"), (f"{base}/none", None)):
            with pytest.raises(FileNotFoundError):
                read_partitioned(spark, *missing)
    assert path_exists(spark, f"file://{root}") and not path_exists(spark, os.path.join(root, "zz"))


def test_checkpoint_folder_is_required_off_local_mode():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_department_dimension_above_its_bound_is_not_broadcast(spark, sf_small, monkeypatch):
    monkeypatch.setattr(model, "MAX_NATIONS", 3)
    monkeypatch.setattr(model, "_MEMO", {})
    assert "dim_departements" not in model.dimensions(spark, sf_small)["__checked__"]
    monkeypatch.setattr(model, "MAX_NATIONS", 10_000)
    monkeypatch.setattr(model, "_MEMO", {})
    assert "dim_departements" in model.dimensions(spark, sf_small)["__checked__"]


def test_scalar_edges(spark):
    rows = [("2020-01-02", "75056", "12"), ("2020-01-02 xx", "\t75056", "\t12"), ("2020-01-02Tgarbage", " 75056 ", "12 "),
            ("2020-01-02T10:20:30Z", "2a004", " 00 "), (" 2020-01-02 ", "97411", "99"), ("2020-13-02", " [ND]\t", None), (None, "\n", "53")]
    df = spark.createDataFrame(rows, "d string, c string, h string")
    got = df.select(try_date("d").alias("d"), department_from_commune("c").alias("c"), headcount_category("h").alias("h")).collect()
    day = dt.date(2020, 1, 2)
    assert [r.d for r in got] == [day, None, None, day, day, None, None]
    assert [r.c for r in got] == ["75", "75", "75", "2A", "974", None, None]
    assert [r.h for r in got] == ["PME (10-249)"] * 3 + ["Non employeur", None, None, "Grande structure (250+)"]
    ages = spark.createDataFrame([(a,) for a in (-1, 5, 6, 10, 11, 20, 21, None)], "a int").select(age_band("a").alias("b"))
    assert [r.b for r in ages.collect()] == ["0-5 ans", "0-5 ans", "6-10 ans", "6-10 ans", "11-20 ans", "11-20 ans", "20+ ans", None]


def test_pipeline_counts_a_site_once_and_sets_bad_records_aside(spark):
    cols = ("siret string, siren string, periode_etatAdministratifEtablissement string, periode_dateDebut string, "
            "uniteLegale_activitePrincipaleUniteLegale string, _corrupt_record string")
    rows = [("1", "A", "A", "2020-01-01", "43.22A", None), ("2", "B", "A", "2020-01-01", "43.22A", None),
            ("2", "B", "A", "2020-01-01", "43.22A", None), ("3", "A", "A", "2020-01-01", "43.22A", None),
            ("3", "A", "F", "2021-01-01", "43.22A", None), (None, "C", "A", "2020-01-01", "43.22A", None),
            ("9", "C", "A", "2020-01-01", "43.22A", "{broken")]
    flat = spark.createDataFrame(rows, cols).withColumn("uniteLegale_categorieJuridiqueUniteLegale", F.lit("5499"))
    out = cleaning.run(flat, "2024-01-01")
    full = {(r.siret, r.siren, r.nb_etablissements, r.code_ape) for r in out["full"].collect()}
    assert full == {("1", "A", 1, "43.22A"), ("2", "B", 1, "43.22A")}
    assert out["quarantine"].count() == 2
    assert sorted(r.siret for r in out["siret"].collect()) == ["1", "2"]
