"""Native Column expressions. Every function returns a ``Column``; none runs Python per row."""

from .scalar import (  # noqa: F401
    address_line, age_band, age_years, band_from_edges, clean_code_text, department_from_commune,
    first_chars, headcount_category, latest_struct, safe_name, sector_type, try_date, try_double,
)
from .geo import lambert93_to_wgs84, valid_coordinates  # noqa: F401
