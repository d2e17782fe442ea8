"""Score and segment rule sets, one per published rule version.

FIXED VALUES: points, thresholds, band lists and labels below must equal the
reference's rule versions for results to match. Predicates are Spark SQL
expressions over the canonical column names of the scored table:

    profil_territorial, code_effectifs_etablissement, code_effectifs_unite_legale,
    famille_juridique, score_priorite, nb_etablissements, score_total,
    score_moyen_siren, score_potentiel_ape
"""

from __future__ import annotations

from ..operators.cascade import Cascade, Expr, FlagSet, Rule, ScoreSet, Segmentation

E = "code_effectifs_etablissement"
U = "code_effectifs_unite_legale"
P = "COALESCE(score_potentiel_ape, 0)"


def _in(col: str, codes: tuple[str, ...]) -> str:
    return f"{col} IN ({', '.join(repr(c) for c in codes)})"


# --- dimension scores shared by every 130-point version --------------------
TERRITORY = Cascade("score_profil_territorial", (
    Rule("profil_territorial = 'Très urbain'", 25),
    Rule("profil_territorial = 'Urbain'", 20),
    Rule("profil_territorial = 'Péri-urbain'", 15),
    Rule("profil_territorial = 'Rural'", 10),
), 5)

# Size score from the establishment band, versions 1.4 and later.
SIZE = Cascade("score_taille_entreprise", (
    Rule(f"{E} = '12'", 40),
    Rule(_in(E, ("21", "22", "31", "32", "41", "42", "51", "52", "53")), 40),
    Rule(f"{E} = '11'", 35),
    Rule(f"{E} = '03'", 30),
    Rule(f"{E} = '02'", 20),
    Rule(f"{E} = '01'", 15),
    Rule(_in(E, ("00", "NN")), 5),
), 5)

# Size score of versions 1.1 to 1.3.
SIZE_V11 = Cascade("score_taille_entreprise", (
    Rule(_in(E, ("53", "52", "51")), 40),
    Rule(_in(E, ("42", "41", "32", "31")), 38),
    Rule(f"{E} = '22'", 35),
    Rule(f"{E} = '21'", 30),
    Rule(_in(E, ("12", "11")), 15),
    Rule(_in(E, ("03", "02", "01", "00", "NN")), 5),
), 5)

LEGAL = Cascade("score_forme_juridique", (
    Rule("famille_juridique = 'Société commerciale'", 20),
    Rule("famille_juridique = 'Société civile'", 15),
    Rule("famille_juridique = 'Entrepreneur individuel'", 10),
), 5)

ACTIVITY = Cascade("score_potentiel_ape", (), Expr("COALESCE(score_priorite, 10)"))

MULTI_SITE = Cascade("bonus_multi_agences", (
    Rule("nb_etablissements >= 5", 20),
    Rule("nb_etablissements >= 2", 10),
), 0)

SCORE_130 = ScoreSet((TERRITORY, SIZE, LEGAL, ACTIVITY, MULTI_SITE))
SCORE_130_V11 = ScoreSet((TERRITORY, SIZE_V11, LEGAL, ACTIVITY, MULTI_SITE))

POTENTIAL = Cascade("categorie_potentiel", (
    Rule("score_total >= 104", "Très fort potentiel"),
    Rule("score_total >= 78", "Fort potentiel"),
    Rule("score_total >= 52", "Potentiel moyen"),
), "Potentiel faible")

STRUCTURE_TYPE = Cascade("type_structure", (
    Rule("nb_etablissements >= 5", "Multi-agences (5+)"),
    Rule("nb_etablissements >= 2", "Multi-agences (2-4)"),
), "Mono-établissement")

# --- v1.6: seven exclusive entity segments (first match) -------------------
SEGMENTS_V16 = Segmentation("segment_entreprise", "segment_priorite", (
    ("Grands Comptes", "nb_etablissements > 20"),
    ("Groupes Structurés",
     "nb_etablissements BETWEEN 6 AND 20 AND score_moyen_siren >= 75 AND "
     + _in(U, ("12", "21", "22", "31", "32", "41", "42", "51", "52", "53"))),
    ("Multi-Sites Qualifiés",
     "nb_etablissements BETWEEN 2 AND 5 AND score_moyen_siren >= 90 AND "
     + _in(U, ("12", "21", "22")) + f" AND {P} >= 20"),
    ("Premium Mono-Site",
     "nb_etablissements = 1 AND score_total >= 100 AND "
     + _in(U, ("12", "21", "22")) + f" AND {P} >= 20"),
    ("Prioritaire",
     f"nb_etablissements <= 5 AND score_moyen_siren >= 78 AND {P} >= 20 AND ("
     + _in(U, ("11", "12", "21", "22")) + f" OR (nb_etablissements >= 2 AND {U} = '03'))"),
    ("Secondaire", "score_moyen_siren >= 60"),
), "Hors-Cible")

# --- older flag versions ---------------------------------------------------
FLAGS_V11 = FlagSet((
    ("est_cible_prioritaire",
     "score_total >= 78 AND " + _in(E, ("22", "21", "31", "32")) + " AND score_potentiel_ape >= 25"),
))

_V12_PREMIUM = "score_total >= 78 AND " + _in(E, ("22", "21", "31", "32")) + " AND score_potentiel_ape >= 20"
_V12_PRIORITY = ("score_total >= 70 AND " + _in(E, ("22", "21", "31", "32", "12", "11"))
                 + " AND score_potentiel_ape >= 20")
_V12_SECONDARY = "score_total >= 52 AND " + _in(E, ("22", "21", "31", "32", "12", "11"))

FLAGS_V12 = FlagSet((
    ("est_cible_premium", _V12_PREMIUM),
    ("est_cible_prioritaire", _V12_PRIORITY),
    ("est_cible_secondaire", _V12_SECONDARY),
))

FLAGS_V13 = FlagSet((
    ("est_cible_premium", _V12_PREMIUM + " AND nb_etablissements <= 20"),
    ("est_cible_prioritaire", _V12_PRIORITY + " AND nb_etablissements <= 50"),
    ("est_cible_secondaire", _V12_SECONDARY + " AND nb_etablissements <= 50"),
    ("est_grand_compte", "score_total >= 78 AND nb_etablissements > 20"),
))

FLAGS_V14 = FlagSet((
    ("est_cible_premium", "score_total >= 78 AND " + _in(E, ("12", "21", "22"))
     + " AND score_potentiel_ape >= 20 AND nb_etablissements <= 20"),
    ("est_cible_prioritaire", "score_total >= 70 AND " + _in(E, ("11", "12", "21", "22"))
     + " AND score_potentiel_ape >= 20 AND nb_etablissements <= 50"),
    ("est_cible_secondaire", "score_total >= 52 AND " + _in(E, ("03", "11", "12", "21", "22"))
     + " AND nb_etablissements <= 50"),
    ("est_grand_compte", "score_total >= 78 AND nb_etablissements > 20"),
))

FLAGS_V15 = FlagSet((
    ("est_grand_compte", f"score_total >= 78 AND nb_etablissements > 20 AND {P} >= 10"),
    ("est_moyenne_filiale", "score_total >= 75 AND " + _in(E, ("31", "32", "41"))
     + f" AND nb_etablissements <= 20 AND {P} >= 10"),
    ("est_cible_premium", "score_total >= 78 AND " + _in(U, ("12", "21", "22"))
     + f" AND {P} >= 20 AND nb_etablissements <= 20"),
    ("est_cible_prioritaire", "score_total >= 70 AND " + _in(U, ("11", "12", "21", "22"))
     + f" AND {P} >= 20 AND nb_etablissements <= 50"),
    ("est_cible_secondaire", "score_total >= 52 AND "
     + _in(E, ("02", "03", "11", "12", "21", "22", "31", "32", "41", "42", "51", "52", "53"))
     + " AND " + _in(U, ("03", "11", "12", "21", "22", "31", "32", "41", "42", "51", "52", "53"))
     + " AND nb_etablissements <= 50"),
), exclusive=True)

# Label order used when a v1.5 row is reported as one segment.
V15_SEGMENT = Cascade("segment_v15", (
    Rule("est_grand_compte", "Grand Compte"),
    Rule("est_moyenne_filiale", "Moyenne Filiale"),
    Rule("est_cible_premium", "Premium"),
    Rule("est_cible_prioritaire", "Prioritaire"),
    Rule("est_cible_secondaire", "Secondaire"),
), "Non ciblé")

VERSIONS = {
    "1.1": (SCORE_130_V11, FLAGS_V11),
    "1.2": (SCORE_130_V11, FLAGS_V12),
    "1.3": (SCORE_130_V11, FLAGS_V13),
    "1.4": (SCORE_130, FLAGS_V14),
    "1.5": (SCORE_130, FLAGS_V15),
    "1.6": (SCORE_130, SEGMENTS_V16),
}

# --- single-code view: 100-point score -------------------------------------
TERRITORY_100 = Cascade("score_territoire", (
    Rule("profil_territorial = 'Très urbain'", 40),
    Rule("profil_territorial = 'Urbain'", 30),
    Rule("profil_territorial = 'Péri-urbain'", 20),
    Rule("profil_territorial = 'Rural'", 10),
), 0)
SIZE_100 = Cascade("score_taille", (
    Rule(_in(E, ("21", "22", "31", "32", "41", "42", "51", "52", "53")), 30),
    Rule(_in(E, ("11", "12")), 20),
    Rule(f"{E} = '03'", 10),
    Rule(_in(E, ("01", "02")), 5),
    Rule(f"{E} = '00'", 2),
    Rule(f"{E} = 'NN'", 0),
), 0)
LEGAL_100 = Cascade("score_juridique", (
    Rule("famille_juridique = 'Société commerciale'", 30),
    Rule("famille_juridique = 'Entrepreneur individuel'", 15),
), 10)
SCORE_100 = ScoreSet((TERRITORY_100, SIZE_100, LEGAL_100))
POTENTIAL_100 = Cascade("categorie_potentiel", (
    Rule("score_total >= 80", "Très fort potentiel"),
    Rule("score_total >= 60", "Fort potentiel"),
    Rule("score_total >= 40", "Potentiel moyen"),
), "Potentiel faible")

# Territory-only score on 100 points.
TERRITORY_ONLY = Cascade("score_territoire", (
    Rule("profil_territorial = 'Très urbain'", 100),
    Rule("profil_territorial = 'Urbain'", 75),
    Rule("profil_territorial = 'Péri-urbain'", 50),
    Rule("profil_territorial = 'Rural'", 25),
), 0)

# --- README variant of the points (documented, differs from the code) ------
README_VARIANT = ScoreSet((
    Cascade("score_profil_territorial", (
        Rule("profil_territorial = 'Très urbain'", 25),
        Rule("profil_territorial = 'Urbain'", 20),
        Rule("profil_territorial = 'Péri-urbain'", 15),
        Rule("profil_territorial = 'Rural'", 5),
    ), 5),
    SIZE,
    Cascade("score_forme_juridique", (
        Rule("famille_juridique = 'Société commerciale'", 20),
        Rule("famille_juridique = 'Entrepreneur individuel'", 5),
    ), 10),
    ACTIVITY,
    Cascade("bonus_multi_agences", (
        Rule("nb_etablissements >= 5", 20),
        Rule("nb_etablissements >= 3", 10),
        Rule("nb_etablissements = 2", 5),
    ), 0),
))
