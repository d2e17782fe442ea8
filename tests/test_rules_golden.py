"""Hand-written rows for the older rule versions and score variants: points and
thresholds as literals here, not taken from the rule tables."""

import pytest

from tessera.rules import scoring

FLAG_COLUMNS = "score_total int, code_effectifs_etablissement string, score_potentiel_ape int, nb_etablissements int"

# score, band, activity points, sites -> flags of v1.2, flags of v1.3
FLAG_ROWS = [
    (78, "22", 20, 1, "PRS", "PRS"),
    (78, "32", 25, 20, "PRS", "PRS"),
    (78, "32", 25, 21, "PRS", "RSG"),
    (78, "21", 10, 21, "S", "SG"),
    (77, "31", 20, 1, "RS", "RS"),
    (70, "11", 20, 50, "RS", "RS"),
    (70, "12", 20, 51, "RS", ""),
    (69, "12", 25, 2, "S", "S"),
    (52, "11", 0, 1, "S", "S"),
    (51, "22", 25, 1, "", ""),
    (130, "03", 25, 3, "", ""),
    (90, "41", 25, 60, "", "G"),
    (90, None, 25, 60, "", "G"),
]
NAMES = {"P": "est_cible_premium", "R": "est_cible_prioritaire", "S": "est_cible_secondaire", "G": "est_grand_compte"}


@pytest.mark.parametrize("flags, at", [(scoring.FLAGS_V12, 4), (scoring.FLAGS_V13, 5)])
def test_flags_v12_v13(spark, flags, at):
    df = spark.createDataFrame([(k, *r[:4]) for k, r in enumerate(FLAG_ROWS)], "k int, " + FLAG_COLUMNS)
    names = [n for n, _ in flags.flags]
    got = {r.k: {n for n in names if r[n]} for r in flags.apply(df).collect()}
    assert got == {k: {NAMES[c] for c in r[at]} for k, r in enumerate(FLAG_ROWS)}


def test_territory_only_score(spark):
    want = {"Très urbain": 100, "Urbain": 75, "Péri-urbain": 50, "Rural": 25, "Autre": 0, None: 0}
    df = spark.createDataFrame([(p,) for p in want], "profil_territorial string")
    assert {r.profil_territorial: r.score_territoire for r in scoring.TERRITORY_ONLY.apply(df).collect()} == want


def test_score_100_points(spark):
    rows = [("Très urbain", "53", "Société commerciale", 100), ("Urbain", "12", "Entrepreneur individuel", 65),
            ("Péri-urbain", "03", "Association", 40), ("Rural", "02", None, 25), (None, "00", "Société commerciale", 32),
            ("Autre", "NN", "Société civile", 10), ("Urbain", None, "Société commerciale", 60)]
    df = spark.createDataFrame(rows, "profil_territorial string, code_effectifs_etablissement string, famille_juridique string, want int")
    out = scoring.POTENTIAL_100.apply(scoring.SCORE_100.apply(df)).collect()
    assert all(r.score_total == r.want for r in out)
    label = {100: "Très fort potentiel", 65: "Fort potentiel", 40: "Potentiel moyen", 25: "Potentiel faible", 32: "Potentiel faible",
             10: "Potentiel faible", 60: "Fort potentiel"}
    assert all(r.categorie_potentiel == label[r.want] for r in out)


def test_documented_variant_points(spark):
    rows = [("Très urbain", "Société commerciale", 5, 25, 20, 20), ("Urbain", "Entrepreneur individuel", 1, 20, 5, None),
            ("Péri-urbain", "Association", 5, 15, 10, 20), ("Rural", None, 5, 5, 10, 20), (None, "Société commerciale", 5, 5, 20, 20)]
    df = spark.createDataFrame([(k, *r[:3], "12", "12", "43.22B", 25) for k, r in enumerate(rows)],
                               "k int, profil_territorial string, famille_juridique string, nb_etablissements int, "
                               "code_effectifs_etablissement string, code_effectifs_unite_legale string, code_ape string, score_priorite int")
    out = {r.k: r for r in scoring.README_VARIANT.apply(df).collect()}
    for k, (_, _, _, territory, legal, bonus) in enumerate(rows):
        assert out[k].score_profil_territorial == territory and out[k].score_forme_juridique == legal
        assert bonus is None or out[k].bonus_multi_agences == bonus
