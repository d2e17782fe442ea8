"""Places in a total order without a single task: rows are range-partitioned and sorted,
written with their place in their partition, and partitions get offsets from their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise

#: Offsets (rows a group and partition) that are broadcast at most.
MAX_BROADCAST_OFFSETS = 20_000


def numbered(rows: DataFrame, order: list[Column], name: str, group: str | None = None) -> DataFrame:
    """``rows`` with ``idx`` (place in ``order``, from 0) and ``members`` (rows counted), by values of ``group``
    (null is a group) or over all.

    ``order`` must end in something unique: equal rows stay in one partition. Only the offsets, one row
    a group and partition, are ever put in a window.
    """
    keys = [F.col(group).asc_nulls_first()] if group else []
    at = F.monotonically_increasing_id()             # partition (upper 31 bits) and place in it
    placed = materialise(rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", at), name)
    part = F.shiftright("_at", 33)
    by = [F.col(group).alias("_group")] if group else [F.lit(0).alias("_group")]
    runs = placed.groupBy(*by, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("_at").alias("_n"))
    before = W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "members": F.sum("_n").over(W.partitionBy("_group"))})
    runs = broadcast_if_small(materialise(runs, f"{name}-offsets"), MAX_BROADCAST_OFFSETS)
    same = (part == F.col("_part")) & (F.col(group).eqNullSafe(F.col("_group")) if group else F.lit(True))
    return placed.join(runs, same).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")) \
        .select(*rows.columns, "idx", "members")
