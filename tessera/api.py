"""

    from tessera import api
    full = api.star_join(fact, [api.DimRef("d", dep, {"departement": "dep"}, {"profil_territorial": "profil"})])
"""

from .functions import (  # noqa: F401
    address_line, age_band, age_years, band_from_edges, clean_code_text, department_from_commune,
    headcount_category, lambert93_to_wgs84, latest_struct, sector_type, try_date, try_double, valid_coordinates,
)
from .functions.geo import with_wgs84  # noqa: F401
from .operators.analytics import (  # noqa: F401
    concentration, count_if, coverage, density, distinct_list, histogram, top_k, top_k_per_group, value_counts,
    with_running_share, with_share,
)
from .operators.cascade import Cascade, Expr, FlagSet, Rule, ScoreSet, Segmentation  # noqa: F401
from .operators.groups import (  # noqa: F401
    SaltPlan, attach_group_stats, duplicate_keys, first_per_key, group_size, latest_per_key,
)
from .operators.projection import (  # noqa: F401
    drop_null_columns, left_join_keep_left, select_strict, select_tolerant, spread_struct, validity_profile,
)
from .operators.quality import (  # noqa: F401
    bounds_check, check, checks, coverage_checks, group_consistency_check, null_check, row_count_check,
    unique_key_check,
)
from .operators.star import DimRef, bounded, star_join, unmatched_keys  # noqa: F401
from .plans.cleaning import build_full, clean_raw, enrich_geo, enrich_siren, enrich_siret, split_siret_siren  # noqa: F401
from .plans.cleaning import run as run_pipeline, run_by_code  # noqa: F401
from .plans.views import scored_view, single_code_view  # noqa: F401
from .sources.manifest import append_manifest, freshness, latest_per_code, outcome_summary  # noqa: F401
from .sources.readers import (  # noqa: F401
    coerce_types, flatten_structs, read_dimension_csv, read_dimensions, read_partitioned, read_processed,
    read_raw_json, sanitize_columns,
)
from .sources.publication import publish_grains, read_published, remove_unused  # noqa: F401
from .sources.writers import export_final, publish, save_split  # noqa: F401
from .streaming.ingest import ingest_pages, latest_scored, score_stream  # noqa: F401
from .streaming.keyed import KeyedTable  # noqa: F401

# Names used in the survey's API sketch.
derive_region_code = department_from_commune
band = band_from_edges
pct_of_total = with_share
distribution = histogram


def cascade(name: str, rules, default=None, mode: str = "first_match"):
    """

    ``mode="first_match"``: ``rules`` = [(predicate, value)] -> a ``Cascade``
    (one column ``name``). ``mode="flags"`` / ``"exclusive_flags"``: ``rules`` =
    [(flag_column, predicate)] -> a ``FlagSet`` (``name`` unused)."""
    if mode == "first_match":
        return Cascade(name, tuple(Rule(p, v) for p, v in rules), default)
    if mode in ("flags", "exclusive_flags"):
        return FlagSet(tuple(rules), exclusive=(mode == "exclusive_flags"))
    raise ValueError("mode must be first_match, flags or exclusive_flags")
