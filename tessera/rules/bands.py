"""Code lists and bands.

FIXED VALUES: these must equal the reference's code lists and labels for results
to match. They are listed plainly, in their natural order.
"""

# Headcount band codes of the registry, smallest to largest, with their labels.
HEADCOUNT_BANDS = (
    ("NN", "0 ou inconnu"),
    ("00", "0"),
    ("01", "1-2"),
    ("02", "3-5"),
    ("03", "6-9"),
    ("11", "10-19"),
    ("12", "20-49"),
    ("21", "50-99"),
    ("22", "100-199"),
    ("31", "200-249"),
    ("32", "250-499"),
    ("41", "500-999"),
    ("42", "1000-1999"),
    ("51", "2000-4999"),
    ("52", "5000-9999"),
    ("53", ">10000"),
)
HEADCOUNT_CODES = tuple(c for c, _ in HEADCOUNT_BANDS)

# Headcount category of an establishment or entity (after trimming the code).
HEADCOUNT_CATEGORIES = (
    ("Non employeur", ("NN", "00")),
    ("TPE (1-9)", ("01", "02", "03")),
    ("PME (10-249)", ("11", "12", "21", "22", "31")),
    ("Grande structure (250+)", ("32", "41", "42", "51", "52", "53")),
)

# Age band in whole years (upper bounds inclusive); null stays null.
AGE_BANDS = (
    (5, "0-5 ans"),
    (10, "6-10 ans"),
    (20, "11-20 ans"),
)
AGE_BAND_LAST = "20+ ans"

# Age dimension rows: id, label, lower bound, upper bound, order. Bounds touch,
# so lookups use the half-open interval [min, max).
AGE_DIMENSION = (
    ("moins_2_ans", "< 2 ans", 0, 2, 1),
    ("2_5_ans", "2-5 ans", 2, 5, 2),
    ("5_10_ans", "5-10 ans", 5, 10, 3),
    ("10_20_ans", "10-20 ans", 10, 20, 4),
    ("plus_20_ans", "> 20 ans", 20, 999, 5),
)

# Activity codes of the construction sector, by priority score.
ACTIVITY_CODES_BY_SCORE = {
    25: ("43.22B", "43.29A", "43.32A"),
    20: ("41.20A", "43.29B", "43.31Z", "43.32B"),
    10: ("41.20B", "43.11Z", "43.12A", "43.12B", "43.21A", "43.22A", "43.32C", "43.33Z",
         "43.34Z", "43.39Z", "43.91A", "43.91B", "43.99A", "43.99C", "43.99D", "81.30Z"),
    0: ("41.10A", "41.10B", "41.10C", "41.10D", "42.11Z", "42.12Z", "42.13A", "42.13B",
        "42.21Z", "42.22Z", "42.91Z", "42.99Z", "43.13Z", "43.21B", "43.99B", "74.90A"),
}
SECTOR_CODES = tuple(c for codes in ACTIVITY_CODES_BY_SCORE.values() for c in codes)
# The global view unions the codes with a non-zero priority (23 codes).
RETAINED_CODES = tuple(c for s, codes in ACTIVITY_CODES_BY_SCORE.items() if s > 0 for c in codes)

# Territorial profiles, most urban first, with the rank used for ordering
# (rank grows with urbanisation).
TERRITORIAL_PROFILES = (
    ("Très urbain", 4),
    ("Urbain", 3),
    ("Péri-urbain", 2),
    ("Rural", 1),
)

# Market potential and reference density text per territorial profile.
PROFILE_MARKET_POTENTIAL = (
    ("Très urbain", "Très fort"),
    ("Urbain", "Fort"),
    ("Péri-urbain", "Moyen"),
    ("Rural", "Faible"),
)
PROFILE_REFERENCE_DENSITY = (
    ("Très urbain", "20-27 / 10K hab"),
    ("Urbain", "15-20 / 10K hab"),
    ("Péri-urbain", "10-15 / 10K hab"),
    ("Rural", "5-10 / 10K hab"),
)
# Expected reference density range (per 10k inhabitants) per profile.
PROFILE_DENSITY_RANGE = (
    ("Très urbain", 20.0, 27.0),
    ("Urbain", 15.0, 20.0),
    ("Péri-urbain", 10.0, 15.0),
    ("Rural", 5.0, 10.0),
)

# Departments per territorial profile in the published department dimension
# (101 rows); the expected distribution of the profile check on registry data.
REGISTRY_PROFILE_COUNTS = (
    ("Rural", 49),
    ("Péri-urbain", 31),
    ("Urbain", 15),
    ("Très urbain", 6),
)
