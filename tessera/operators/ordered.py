"""Running sums and ranks over rows in a total order, without a task that sees them all.

A window without a partition sorts every row in one task. Here rows are range-partitioned
and sorted, written with their place (the ranges come from a sample, so they must
not be drawn twice), each range sums for itself, and ranges get the sums of those
before them by a join. Only one row a range is ever put in a window of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .star import bounded

_AT, _PART = "__at", "__part"


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str], rank: str | None = None,
                 totals: dict[str, str] | None = None) -> DataFrame:
    """``df`` with, for each ``new: column`` of ``sums``, the sum of ``column`` over the rows up to this one in
    ``order`` (nulls add nothing), ``rank`` (place from 1, long) and, for each ``new: column`` of ``totals``, the sum over all.

    ``order`` must end in something unique; otherwise equal rows take an arbitrary, though stable, order.
    New names must not be columns of ``df``. An empty table gives an empty table. A task holds one range.
    """
    totals = totals or {}
    path = scratch_path(df.sparkSession, f"tessera-ordered/{uuid.uuid4().hex}")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    # the upper bits of the place are the number of the range
    placed = df.sparkSession.read.parquet(path).withColumn(_PART, F.shiftright(_AT, 33))
    used = sorted({*sums.values(), *totals.values()})
    name = {c: f"__s{k}" for k, c in enumerate(used)}
    ranges = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("__n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(name[c]) for c in used])
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = ranges.select(F.col(_PART).alias("__range"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__rank"),
                            *[F.coalesce(F.sum(name[c]).over(before), F.lit(0)).alias(f"__b{k}") for k, c in enumerate(sums.values())],
                            *[F.sum(name[c]).over(whole).alias(f"__t{k}") for k, c in enumerate(totals.values())])
    here = Window.partitionBy(_PART).orderBy(_AT)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = placed.withColumns({"__place": F.row_number().over(here).cast("long"),
                              **{f"__r{k}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for k, c in enumerate(sums.values())}})
    out = own.join(bounded(offsets), F.col(_PART) == F.col("__range"))
    return out.select(*df.columns, *[(F.col(f"__r{k}") + F.col(f"__b{k}")).alias(new) for k, new in enumerate(sums)],
                      *([(F.col("__place") + F.col("__rank")).alias(rank)] if rank else []),
                      *[F.col(f"__t{k}").alias(new) for k, new in enumerate(totals)])


def range_lookup(points: DataFrame, value: str, ranges: DataFrame, lo: str, hi: str) -> DataFrame:
    """``points`` left-joined to the rows of ``ranges`` with ``lo <= value < hi``, by equality joins only.

    A range of width w is listed in the (at most two) bins of size 2^ceil(log2 w) that it meets, whatever its width;
    a value asks the one bin that holds it at each size in use. Only distinct values are looked up: a value shared by a
    third of all rows is one row there, and the join that brings the matches back is on the value itself.

    A null end is open; a null or NaN value matches nothing; overlapping ranges give a row each; an empty range or an
    empty table of ranges matches nothing. Numeric columns; names of the two tables must differ.
    """
    x = F.col(value).cast("double")
    values = points.select(value).where(F.col(value).isNotNull() & ~F.isnan(x)).distinct()
    # ends beyond the values are cut for the choice of bins, so an open range has a width too
    extent = values.agg(F.min(x).alias("a"), F.max(x).alias("b"))
    a, b = extent.select("a").scalar(), extent.select("b").scalar()
    cut = ranges.withColumns({"__a": F.greatest(F.col(lo).cast("double"), a), "__b": F.least(F.col(hi).cast("double"), b)}) \
        .where(F.col("__a") <= F.col("__b"))
    # bins stay below 2^53, so that a value's bin is exact
    finest = F.ceil(F.log2(F.greatest(F.abs(a), F.abs(b)))) - 52
    size = F.greatest(F.ceil(F.log2(F.col("__b") - F.col("__a"))), finest, F.lit(-50).cast("long"))
    listed = cut.withColumn("__size", F.pow(F.lit(2.0), size)) \
        .withColumn("__bin", F.explode(F.sequence(F.floor(F.col("__a") / F.col("__size")), F.floor(F.col("__b") / F.col("__size"))))) \
        .drop("__a", "__b")
    sizes = listed.agg(F.collect_set("__size").alias("s")).scalar()          # one size a power of two at most
    asked = values.withColumn("__sizes", sizes).select(F.col(value).alias("__value"), F.explode("__sizes").alias("__of"))
    asked = asked.withColumn("__in", F.floor(F.col("__value").cast("double") / F.col("__of")))
    inside = (F.col(lo).isNull() | (F.col("__value") >= F.col(lo))) & (F.col(hi).isNull() | (F.col("__value") < F.col(hi)))
    found = asked.join(listed, (F.col("__of") == F.col("__size")) & (F.col("__in") == F.col("__bin"))).where(inside) \
        .select("__value", *ranges.columns)
    return points.join(found, F.col(value) == F.col("__value"), "left").drop("__value")
