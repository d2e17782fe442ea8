"""Publication in one step, reports by code, bounded distinct lists, tolerant typing."""

import os
import tempfile

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tessera.operators.analytics import distinct_list, grouped_with_list
from tessera.plans import cleaning
from tessera.sources.publication import current, publish_grains, read_published, remove_unused
from tessera.sources.readers import coerce_types, read_raw_json


def grains(spark, codes, n, tag):
    base = spark.range(n).select(F.col("id").alias("siret"), F.lit(tag).alias("tag"), (F.col("id") % 3).cast("string").alias("departement"),
                                 F.element_at(F.array(*map(F.lit, codes)), (F.col("id") % len(codes) + 1).cast("int")).alias("code_ape"))
    return base, base.drop("departement").distinct(), base.withColumn("more", F.lit(1))


def seen(spark, root):
    return {g: {(r.code_ape, r.tag): r.n for r in read_published(spark, root, g).groupBy("code_ape", "tag").agg(F.count(F.lit(1)).alias("n")).collect()}
            for g in ("siret", "siren", "full")}


def test_a_failed_publication_shows_nothing(spark):
    root = tempfile.mkdtemp(prefix="tessera-atomic-")
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "full")
    first = publish_grains(*grains(spark, ["43.21A", "x/y", "c d"], 30, "one"), root, ("departement",))
    old = seen(spark, root)
    assert old["full"] == {("43.21A", "one"): 10, ("x/y", "one"): 10, ("c d", "one"): 10}
    siret, siren, full = grains(spark, ["43.21A", "x/y", "c d"], 60, "two")
    broken = full.withColumn("more", F.when(F.col("siret") == 59, F.raise_error(F.lit("no space left"))).otherwise(F.lit(1)))
    with pytest.raises(SparkRuntimeException):
        publish_grains(siret, siren, broken, root, ("departement",))      # after the second grain
    assert seen(spark, root) == old
    # one code anew: the others keep their version, in all grains
    second = publish_grains(*grains(spark, ["x/y"], 7, "three"), root, ("departement",))
    new = seen(spark, root)
    assert all(rows == {("43.21A", "one"): 10, ("x/y", "three"): 7, ("c d", "one"): 10} for rows in new.values())
    assert read_published(spark, root, "siret", "x/y").count() == 7
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "siret", "zz")
    assert {v for g in current(spark, root).values() for v in g.values()} == {first, second}
    # only the failed version goes
    assert remove_unused(spark, root) == [] and len(remove_unused(spark, root, 0)) == 1
    assert seen(spark, root) == new and sum(n.startswith("version=") for n in os.listdir(root)) == 2
    with pytest.raises(ValueError, match="clustering"):
        publish_grains(siret, siren, full, root, ("no_such",))


def test_distinct_list_of_a_million_values(spark):
    df = spark.range(0, 1_100_000, 1, 8).select(
        F.when(F.col("id") < 1_000_000, "hot").otherwise("cold").alias("g"),
        F.format_string("%07d", F.pmod(F.col("id") * 7919, F.lit(1_000_003))).alias("v"), F.lit(2).alias("x"))
    out = grouped_with_list(df, ["g"], "v", 3, {"n": F.lit(1), "total": F.col("x")}, "first", buckets=16)
    got = {r.g: (r.n, r.total, r.first) for r in out.collect()}
    want = {r.g: (r.n, 2 * r.n, r.first) for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), distinct_list("v", 3).alias("first")).collect()}
    assert got == want and got["hot"][0] == 1_000_000
    odd = spark.createDataFrame([(None, "b"), (None, None), (None, "a"), ("g", None), ("h", "z"), ("h", "z")], "g string, v string")
    rows = {r.g: (r.n, r.l) for r in grouped_with_list(odd, ["g"], "v", 1, {"n": F.lit(1)}, "l").collect()}
    assert rows == {None: (3, "a"), "g": (1, ""), "h": (2, "z")}
    assert grouped_with_list(odd.limit(0), ["g"], "v", 1, {"n": F.lit(1)}, "l").count() == 0


def record(siret, siren, code, state="A"):
    return (f'{{"siret": "{siret}", "siren": "{siren}", "dateCreationEtablissement": "2001-01-01", "uniteLegale": '
            f'{{"categorieJuridiqueUniteLegale": "5710", "activitePrincipaleUniteLegale": "{code}"}}, "periodesEtablissement": '
            f'[{{"dateDebut": "2001-01-01", "etatAdministratifEtablissement": "{state}"}}]}}')


def test_report_by_code_isolates_failures(spark):
    root = tempfile.mkdtemp(prefix="tessera-by-code-")
    lines = [(record(1, 10, "good"), "good"), (record(2, 10, "good"), "good"), (record(3, 11, "good"), "good"), ('{"siret": "4", broken', "good"),
             (record(5, 12, "bad"), "bad"), ('{"x', "bad"), ('{"siren": "12"}', "bad"), (record(6, 13, "closed", "F"), "closed")]
    spark.createDataFrame(lines, "value string, code_extraction string").write.partitionBy("code_extraction").text(f"{root}/landing")
    flat = read_raw_json(spark, f"{root}/landing", corrupt_column="_corrupt_record")
    wanted = spark.createDataFrame([("good",), ("bad",), ("closed",), ("none",), ("good",), (None,)], "code_ape string")
    out, report = cleaning.run_by_code(flat, wanted, "2026-02-01", ["good"])
    got = {r.code_ape: tuple(r)[1:] for r in report.collect()}
    assert got == {"good": (True, None, 3, 2, 1), "bad": (False, "2 enregistrements rejetés sur 3", 0, 0, 2),
                   "closed": (False, cleaning.NO_ACTIVE, 0, 0, 0), "none": (False, cleaning.NO_DATA, 0, 0, 0),
                   "TOTAL": (False, "3 en erreur sur 4", 3, 2, 3)}
    assert {r.siret for r in out["full"].collect()} == {"1", "2", "3"}
    errors = sorted((r.code_extraction, r.erreur) for r in out["quarantine"].select("code_extraction", "erreur", "siret", "_corrupt_record").collect())
    assert errors == [("bad", "ligne illisible"), ("bad", "siret absent"), ("good", "ligne illisible")]


def test_typing_by_name_takes_whole_values_only(spark):
    df = spark.createDataFrame([("2020-01-01 xx", "NaN", "3.0"), ("2020-01-01Tgarbage", "Infinity", "x"), ("\t2020-01-01 ", " 2.5 ", "1e99"),
                                ("2020-01-01T10:20:30", "[ND]", None), (None, None, "")], "dateCreation string, longitude string, anciennete_ul_annees string")
    rows = [(str(r[0]) if r[0] else None, r[1], r[2]) for r in coerce_types(df).collect()]
    assert rows == [(None, None, 3), (None, None, None), ("2020-01-01", 2.5, None), ("2020-01-01", None, None), (None, None, None)]


def test_one_code_is_written_by_several_tasks(spark):
    """Without cluster columns too: a code's rows are no single range."""
    from tessera.sources.writers import publish
    path, size = tempfile.mkdtemp(prefix="tessera-wide-") + "/t", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        publish(spark.range(0, 60_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("code_ape")), path)
    finally:
        spark.conf.set(size, before)
    back = spark.read.parquet(path)
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert back.count() == 60_000 and back.select("id").distinct().count() == 60_000
    assert len(per_file) > 4 and max(per_file) < 20_000


def test_generated_code_is_compiled_within_a_write_only(spark):
    from tessera.session import compiled_code
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError):
        with compiled_code(spark):
            assert spark.conf.get(name) == "8000"
            1 / 0
    assert spark.conf.get(name) == before
