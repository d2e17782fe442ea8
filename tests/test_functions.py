"""Scalar functions on the edge rows of FIXTURES.md section 4."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import (
    address_line, age_band, age_years, clean_code_text, department_from_commune, headcount_category,
    lambert93_to_wgs84, latest_struct, safe_name, sector_type, try_date, try_double, valid_coordinates,
)

PERIODE = T.ArrayType(T.StructType([T.StructField("dateDebut", T.StringType()),
                                    T.StructField("etat", T.StringType())]))


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_latest_struct_edges(spark):
    rows = [(None,), ([],), ([("2020", "A"), ("2021", "F"), ("2021", "A")],), ([(None, "A")],),
            ([None, ("2019", "X")],)]
    s = T.StructType([T.StructField("p", PERIODE)])
    out = _one(spark, latest_struct("p", "dateDebut"), rows, s)
    assert out[0] is None and out[1] is None
    assert tuple(out[2]) == ("2021", "F")          # tie: the first 2021 item wins
    assert tuple(out[3]) == (None, "A")            # missing date counts as 0000-00-00
    assert tuple(out[4]) == ("2019", "X")          # null items are ignored


def test_tolerant_parses(spark):
    s = "v string"
    assert _one(spark, try_date("v"), [("garbage",), ("",), ("[ND]",), ("2020-02-29",)], s)[:3] == [None] * 3
    assert str(_one(spark, try_date("v"), [("2020-02-29",)], s)[0]) == "2020-02-29"
    assert _one(spark, try_date(F.col("v")), [("garbage",)], s) == [None]        # Column input, ANSI on
    assert _one(spark, try_double(F.col("v")), [("[ND]",)], s) == [None]
    assert _one(spark, try_double("v"), [("garbage",), ("",), ("[ND]",), ("NaN",), (" 12.5 ",)], s) == \
        [None, None, None, None, 12.5]


def test_department_from_commune(spark):
    vals = [(None,), ("",), (" [ND] ",), ("2a004",), ("2B033",), ("97411",), ("98818",), (" 75056 ",)]
    out = _one(spark, department_from_commune("v"), vals, "v string")
    assert out == [None, None, None, "2A", "2B", "974", "988", "75"]


def test_lambert_and_guard(spark):
    df = spark.createDataFrame([(700000.0, 6600000.0), (None, 6600000.0)], "x double, y double")
    lon, lat = lambert93_to_wgs84(F.col("x"), F.col("y"))
    r = df.select(lon.alias("lon"), lat.alias("lat")).collect()
    assert abs(r[0].lon - 3.0) < 1e-6 and abs(r[0].lat - 46.5) < 1e-6
    assert r[1].lon is None and r[1].lat is None
    g = spark.createDataFrame([(3.0, 95.0), (200.0, 10.0), (3.0, 46.0)], "lo double, la double")
    glo, gla = valid_coordinates(F.col("lo"), F.col("la"))
    out = [tuple(x) for x in g.select(glo, gla).collect()]
    assert out == [(None, None), (None, None), (3.0, 46.0)]


def test_age_and_band(spark):
    df = spark.createDataFrame([("2024-03-01",), (None,), ("2021-01-01",)], "d string")
    out = [r[0] for r in df.select(age_years(F.to_date("d"), "2023-12-31")).collect()]
    assert out == [-1, None, 2]           # 61 days in the future -> floor(-0.17) = -1
    ages = [(-1,), (5,), (6,), (10,), (11,), (20,), (21,), (None,)]
    bands = _one(spark, age_band("a"), ages, "a int")
    assert bands == ["0-5 ans", "0-5 ans", "6-10 ans", "6-10 ans", "11-20 ans", "11-20 ans", "20+ ans", None]


def test_headcount_category_and_sector(spark):
    vals = [("NN",), (" 03 ",), ("31",), ("32",), ("99",)]
    assert _one(spark, headcount_category("v"), vals, "v string") == \
        ["Non employeur", "TPE (1-9)", "PME (10-249)", "Grande structure (250+)", None]
    assert _one(spark, sector_type("v"), [(None,), ("43.22B",), ("01.11Z",)], "v string") == ["Autres", "BTP", "Autres"]


def test_address_line_keeps_separators(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "a string, b string, c string, d string, e string")
    assert df.select(address_line("a", "b", "c", "d", "e")).first()[0] == "  ,  "


def test_code_text_repair_and_names(spark):
    assert _one(spark, clean_code_text(F.col("v")), [(54.0,), (10.0,), (0.0,)], "v double") == ["54", "10", "0"]
    assert safe_name("uniteLegale.code (x)") == "uniteLegale_code__x_"
