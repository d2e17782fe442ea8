"""Golden scoring rows (FIXTURES.md section 5) under rule versions 1.6 and 1.5."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.groups import group_size
from tessera.plans import views
from tessera.rules import bands

# entity, sites, departments, establishment bands, legal prefix, code, entity band,
# expected total per site, expected mean, expected segment
GOLDEN = [
    ("E1", 1, ["75"], ["12"], "54", "43.22B", "12", [110], 110, "Premium Mono-Site"),
    ("E2", 1, ["02"], ["NN"], "10", "43.34Z", "NN", [35], 35, "Hors-Cible"),
    ("E3", 2, ["93", "02"], ["12", "01"], "57", "43.29A", "21", [120, 80], 100, "Multi-Sites Qualifiés"),
    ("E4", 2, ["75", "69"], ["02", "NN"], "54", "43.32B", "03", [95, 75], 85, "Prioritaire"),
    ("E5", 1, ["75"], ["03"], "54", "43.22B", "03", [100], 100, "Secondaire"),
    ("E6", 6, ["75"] * 6, ["00"] * 6, "54", "43.99C", "12", [80] * 6, 80, "Groupes Structurés"),
    ("E7", 6, ["75"] * 6, ["00"] * 6, "54", "43.99C", "11", [80] * 6, 80, "Secondaire"),
    ("E8", 21, ["02"] * 21, ["NN"] * 21, "10", "43.34Z", "NN", [55] * 21, 55, "Grands Comptes"),
    ("E9", 1, ["975"], [None], "00", "99.99Z", None, [25], 25, "Hors-Cible"),
    ("E10", 1, ["38"], ["01"], "54", "43.99C", "01", [60], 60, "Secondaire"),
]


@pytest.fixture(scope="module")
def dims(spark):
    dep = spark.createDataFrame(
        [("75", "Très urbain"), ("93", "Très urbain"), ("69", "Urbain"), ("38", "Péri-urbain"), ("02", "Rural")],
        "dep string, profil_territorial string")
    ape = spark.createDataFrame([("43.22B", "a", 25), ("43.29A", "b", 25), ("43.32B", "c", 20), ("43.34Z", "d", 10),
                                 ("43.99C", "e", 10)], "code_ape string, libelle_ape string, score_priorite int")
    eff = spark.createDataFrame(list(bands.HEADCOUNT_BANDS), "tranche_effectifs string, Employes string")
    # the dimension key '0' does not match the fact prefix '00' (E9)
    jur = spark.createDataFrame([("54", "Société commerciale"), ("57", "Société commerciale"),
                                 ("10", "Entrepreneur individuel"), ("0", "Organisme sans personnalité morale")],
                                "categorie_juridique_ul_niv2 string, famille_juridique string")
    d = {"dim_departements": dep, "dim_codes_ape": ape, "dim_categories_effectifs": eff,
         "dim_categories_juridiques": jur}
    d["__checked__"] = frozenset(d)
    return d


@pytest.fixture(scope="module")
def full(spark):
    rows, k = [], 0
    for ent, n, deps, bands_e, legal, code, band_u, *_ in GOLDEN:
        for i in range(n):
            k += 1
            rows.append((k, ent, deps[i], bands_e[i], legal + "10", legal, code, band_u, "A", f"Société {ent}"))
    df = spark.createDataFrame(rows, "siret long, siren string, departement string, trancheEffectifsEtablissement string, "
                                     "uniteLegale_categorieJuridiqueUniteLegale string, "
                                     "uniteLegale_categorieJuridiqueUniteLegaleNiv2 string, code_ape string, "
                                     "uniteLegale_trancheEffectifsUniteLegale string, "
                                     "periode_etatAdministratifEtablissement string, "
                                     "uniteLegale_denominationUniteLegale string")
    return group_size(df, ["siren"], "nb_etablissements", salt_from=["siret"])


def test_v16_golden(full, dims):
    v = views.scored_view(full, dims).collect()
    by = {}
    for r in v:
        by.setdefault(r.siren, []).append(r)
    for ent, n, _, _, _, _, _, totals, mean, segment in GOLDEN:
        rows = sorted(by[ent], key=lambda r: r.siret)
        assert len(rows) == n, ent
        assert [r.score_total for r in rows] == totals, ent
        assert all(r.score_moyen_siren == pytest.approx(mean) for r in rows), ent
        assert {r.segment_entreprise for r in rows} == {segment}, ent


def test_v15_flags(full, dims):
    v = views.scored_view(full, dims, version="1.5").collect()
    flags = ["est_grand_compte", "est_moyenne_filiale", "est_cible_premium", "est_cible_prioritaire",
             "est_cible_secondaire"]
    got = {}
    for r in v:
        got.setdefault(r.siren, set()).update(f for f in flags if r[f])
    assert got["E1"] == {"est_cible_premium"}
    assert got["E3"] == {"est_cible_premium"}
    assert got["E5"] == {"est_cible_secondaire"}
    assert got["E6"] == set() and got["E8"] == set()
    # exclusive: never two flags on one row
    assert all(sum(int(r[f]) for f in flags) <= 1 for r in v)


def test_salted_mean_equals_window(full, dims):
    """Forcing every entity to be 'heavy' (split into buckets) changes nothing."""
    from pyspark.sql import Window
    from tessera.operators.groups import attach_group_stats
    s = views.score(views.scoring_base(full, dims))
    salted = attach_group_stats(s, ["siren"], {"m": F.avg("score_total")}, salt_from=["siret"], rows_per_task=1)
    win = s.withColumn("m", F.avg("score_total").over(Window.partitionBy("siren")))
    a = sorted((r.siret, r.m) for r in salted.select("siret", "m").collect())
    b = sorted((r.siret, r.m) for r in win.select("siret", "m").collect())
    assert a == b


V14_FLAGS = {  # entity -> flags per site (in siret order)
    "E1": [{"est_cible_premium", "est_cible_prioritaire", "est_cible_secondaire"}],
    "E2": [set()],
    "E3": [{"est_cible_premium", "est_cible_prioritaire", "est_cible_secondaire"}, set()],
    "E4": [set(), set()],
    "E5": [{"est_cible_secondaire"}],
    "E6": [set()] * 6, "E7": [set()] * 6, "E8": [set()] * 21, "E9": [set()], "E10": [set()],
}
# v1.1 uses the earlier size map: totals per site
V11_TOTALS = {"E1": [85], "E2": [35], "E3": [95, 70], "E4": [80, 75], "E5": [75], "E6": [80] * 6,
              "E7": [80] * 6, "E8": [55] * 21, "E9": [25], "E10": [50]}


def test_version_regression_v14_v11(full, dims):
    flags = ["est_cible_premium", "est_cible_prioritaire", "est_cible_secondaire", "est_grand_compte"]
    by = {}
    for r in sorted(views.scored_view(full, dims, version="1.4").collect(), key=lambda r: r.siret):
        by.setdefault(r.siren, []).append({f for f in flags if r[f]})
    assert by == V14_FLAGS
    tot = {}
    v11 = views.scored_view(full, dims, version="1.1")
    for r in sorted(v11.collect(), key=lambda r: r.siret):
        tot.setdefault(r.siren, []).append(r.score_total)
        assert r.est_cible_prioritaire is False        # no site has a v1.1 target band
    assert tot == V11_TOTALS
