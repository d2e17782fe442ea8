"""Vectors in and out of Arrow batches, shared by the nearest-neighbour operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

#: Rows of one block of work: data rows are dealt over groups of about this size, queries likewise.
GROUP_ROWS = 2048


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, name: str, least: Column | None = None) -> DataFrame:
    """row, vec_id, v (array of double) of usable rows: id and vector present, no null or non-finite component,
    and ``least`` (a condition on ``v``). Written as ``name``, so that ``row``, a number of a row's own, stays the same:
    rows may share an id, and each takes part.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)
    if least is not None:
        rows = rows.filter(least)
    return materialise(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), name)


def matrix(col: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """A list column as rows x dims doubles; shorter vectors are filled with 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    out = np.zeros((len(col), dims))
    bounds = np.asarray(col.offsets).astype(np.int64)
    sizes = np.diff(bounds)
    flat = col.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]] if len(col) else np.zeros(0)
    rows = np.repeat(np.arange(len(col)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(bounds[:-1] - bounds[0], sizes)] = flat
    return out


def top_rows(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``score`` (queries x candidates; -inf: none): places of the k best, ties to smaller ids,
    and whether each exists."""
    k = min(k, score.shape[1])
    if k == 0:
        return np.zeros((len(score), 0), np.int64), np.zeros((len(score), 0), bool)
    order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
    return order, np.isfinite(np.take_along_axis(score, order, 1))


def best_per_query(rows: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows (query_row, query_id, vec_id, score) of each query."""
    order = W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
