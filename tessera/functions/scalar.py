"""Scalar column functions: tolerant parsing, codes, ages, bands, labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import bands


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Text without any Unicode white space at its ends (``trim`` takes plain spaces only)."""
    return F.regexp_replace(_c(c).cast("string"), r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", "")


# A whole ISO date, alone or with a time and a zone.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def try_date(c: Column | str) -> Column:
    """Tolerant date parse: an ISO date or timestamp -> date; anything else, a date
    followed by other text included, -> null (a cast alone would take the date and
    leave the rest)."""
    t = strip(c)
    return F.when(t.rlike(_ISO_DATE), F.substring(t, 1, 10).try_cast("date"))


def try_double(c: Column | str) -> Column:
    """Tolerant number parse: ``[ND]``, text, ``NaN`` and infinities -> null."""
    x = strip(c).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def first_chars(c: Column | str, n: int = 2) -> Column:
    """Prefix of a code (legal category level 2, activity division)."""
    return F.substring(_c(c), 1, n)


def clean_code_text(c: Column | str) -> Column:
    """A code read as a number (``54.0``) back to its text form (``54``); the
    ``.0`` is removed only at the end of the value."""
    return F.regexp_replace(_c(c).cast("string"), r"\.0$", "")


def latest_struct(arr: Column | str, order_field: str, default: str = "0000-00-00") -> Column:
    """Latest element of an array of structs by ``order_field`` (descending).

    A missing order value counts as ``default``; on a tie the first element in
    array order wins (strict ``>`` in the fold); empty or null array -> null.
    ``array_max`` would compare whole structs, so a fold is used instead."""
    a = F.filter(_c(arr), lambda x: x.isNotNull())
    key = lambda s: F.coalesce(s[order_field].cast("string"), F.lit(default))
    return F.aggregate(
        F.slice(a, 2, F.greatest(F.size(a), F.lit(0))),
        F.try_element_at(a, F.lit(1)),
        lambda acc, x: F.when(key(x) > key(acc), x).otherwise(acc),
    )


def department_from_commune(c: Column | str) -> Column:
    """Department code from a commune code: null/blank/``[ND]`` -> null; Corsica
    ``2A``/``2B`` case-insensitively; overseas ``97x``/``98x`` keep 3 chars;
    otherwise the first 2 chars."""
    t = strip(c)
    up = F.upper(t)
    return (F.when(t.isNull() | (t == "") | (t == "[ND]"), F.lit(None).cast("string"))
            .when(up.startswith("2A"), F.lit("2A"))
            .when(up.startswith("2B"), F.lit("2B"))
            .when(t.startswith("97") | t.startswith("98"), F.substring(t, 1, 3))
            .otherwise(F.substring(t, 1, 2)))


def age_years(date: Column | str, ref_date: str | Column) -> Column:
    """Whole years between a date and a reference date: ``floor(days / 365)``.
    Future dates give negative ages (floor, not truncation)."""
    ref = F.to_date(F.lit(ref_date)) if isinstance(ref_date, str) else ref_date
    return F.floor(F.datediff(ref, _c(date).try_cast("date")) / F.lit(365)).cast("int")


def age_band(age: Column | str) -> Column:
    """Age band with inclusive upper bounds; null stays null; negatives fall in
    the first band."""
    a = _c(age)
    out = None
    for upper, label in bands.AGE_BANDS:
        out = F.when(a <= upper, label) if out is None else out.when(a <= upper, label)
    return F.when(a.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(bands.AGE_BAND_LAST))


def headcount_category(code: Column | str) -> Column:
    """Headcount category from a band code (white space around it ignored); unknown codes -> null."""
    t = strip(code)
    out = None
    for label, codes in bands.HEADCOUNT_CATEGORIES:
        cond = t.isin(*codes)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def sector_type(code: Column | str, codes: Sequence[str] = bands.SECTOR_CODES,
                inside: str = "BTP", outside: str = "Autres") -> Column:
    """Sector membership; null codes count as outside."""
    return F.when(_c(code).isin(*codes), inside).otherwise(outside)


def address_line(numero, type_voie, libelle_voie, code_postal, commune) -> Column:
    """Five address parts, nulls as empty strings, fixed separators kept even
    when parts are missing (``concat_ws`` would drop them)."""
    z = lambda c: F.coalesce(_c(c).cast("string"), F.lit(""))
    return F.concat(z(numero), F.lit(" "), z(type_voie), F.lit(" "), z(libelle_voie), F.lit(", "),
                    z(code_postal), F.lit(" "), z(commune))


def band_from_edges(x: Column | str, width: float, labels: Sequence[str], offset: float = 0.0) -> Column:
    """Map a number to ``labels[floor((x + offset) / width)]`` clamped to the
    label range (a rule-generated banding; null stays null)."""
    # greatest/least skip nulls, so a null input is handled explicitly
    idx = F.least(F.greatest(F.floor((_c(x) + F.lit(offset)) / F.lit(width)), F.lit(0)),
                  F.lit(len(labels) - 1)).cast("int")
    return F.when(_c(x).isNotNull(), F.element_at(F.array(*[F.lit(s) for s in labels]), idx + 1))


_UNSAFE = re.compile(r"[^a-zA-Z0-9_]")


def safe_name(name: str) -> str:
    """Warehouse-safe column name: dots to underscores, then any other
    character outside ``[a-zA-Z0-9_]`` to underscore."""
    return _UNSAFE.sub("_", name.replace(".", "_"))
