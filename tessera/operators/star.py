"""Star join of a fact onto small dimensions.

Dimensions are broadcast only when their row count is checked against a bound
(``bounded``); a dimension over the bound is joined without a hint and AQE picks
the strategy from runtime sizes. The fact is never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest dimension we broadcast without a second thought: reference tables of
# the registry are 5 to 101 rows; 1M rows of a few columns is still tens of MB.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, else return it as is.

    The check runs a ``limit(max_rows + 1).count()`` job, which stops reading as
    soon as the bound is exceeded, so it costs at most ``max_rows`` rows.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


@dataclass
class DimRef:
    """One dimension role in a star join.

    ``on`` maps fact column -> dimension column. ``cols`` maps dimension column
    -> output name (the role's projection). ``how`` is ``left`` (keep unmatched
    facts with null attributes) or ``inner`` (drop them).
    """
    name: str
    df: DataFrame
    on: dict[str, str]
    cols: dict[str, str]
    how: str = "left"
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS
    checked: bool = field(default=False)


def star_join(fact: DataFrame, dims: Sequence[DimRef]) -> DataFrame:
    """Join ``fact`` to every dimension role; a dimension may appear in several
    roles (each with its own projection). Unmatched keys keep null attributes
    (left) or are dropped (inner)."""
    out = fact
    for d in dims:
        keys = list(d.on.items())
        proj = [F.col(dc).alias(f"__{d.name}__{dc}") for _, dc in keys]
        proj += [F.col(dc).alias(out_name) for dc, out_name in d.cols.items()]
        side = d.df.select(*proj)
        # checked: the size bound is proven at construction, broadcast without counting
        side = F.broadcast(side) if d.checked else bounded(side, d.max_rows)
        cond: Column | None = None
        for fc, dc in keys:
            c = out[fc] == side[f"__{d.name}__{dc}"]
            cond = c if cond is None else cond & c
        out = out.join(side, cond, d.how).drop(*[f"__{d.name}__{dc}" for _, dc in keys])
    return out


def unmatched_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys with no dimension row, with their fact row counts (anti join)."""
    d = bounded(dim.select(F.col(dim_key).alias("__k")).distinct())
    return (fact.join(d, fact[fact_key] == d["__k"], "left_anti")
            .groupBy(fact_key).agg(F.count(F.lit(1)).alias("nb_lignes")))
