"""Exact top-k inner products by block-at-a-time pruning.

Vectors are whole-number forward indexes. Rows are dealt over groups; in a group they
are sorted by id and cut into ranges (blocks) with the largest and smallest weight
of each term. A query bounds every block by the sum over its terms of
the most that the term can add, visits blocks from the largest bound down,
scores a block's rows through its forward index, and stops when the next bound is
below its k-th best score. Bounds equal to it are still visited, so ties are exact.

Handling of odd rows: rows with a null id, or a vector that is null, empty or holds a
null or non-finite component take no part; rows that share an id all do, and a query's own row alone is not its candidate;
missing trailing components count 0; products that may pass a long are summed as Python's whole numbers,
and a score beyond a long is held to its end; no query or no candidate gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import GROUP_ROWS, best_per_query, matrix, usable_rows

BLOCK_ROWS = 64
_LEAST, _MOST = -(2 ** 63) + 1, 2 ** 63 - 1
_NONE = _LEAST - 1


def whole_numbers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as longs, or as Python's whole numbers where one does not fit."""
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(vectors * scale), -2.0 ** 1000, 2.0 ** 1000)
    return x.astype(np.int64) if np.abs(x).max(initial=0) < 2 ** 62 else np.frompyfunc(int, 1, 1)(x)


def _longs(x: np.ndarray) -> np.ndarray:
    """Whole numbers as longs, held to the ends: the order of what fits stays."""
    return x if x.dtype == np.int64 else np.frompyfunc(lambda v: min(max(v, _LEAST), _MOST), 1, 1)(x).astype(np.int64)


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """rows (q x n x d) times query (q x d), exact whole numbers."""
    if rows.dtype == object:
        return _longs((rows * query[:, None, :]).sum(2))
    if rows.size and float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * rows.shape[-1] < 2 ** 53:
        return np.matmul(rows.astype(np.float64), query.astype(np.float64)[:, :, None])[:, :, 0].astype(np.int64)
    return np.einsum("qnd,qd->qn", rows, query)


def search_blocks(ids: np.ndarray, weights: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
                  block_rows: int = BLOCK_ROWS, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vec_id, score) of each query's k best rows, and the number of blocks scored. A query does not meet the
    row of its own number in ``rows`` (the ids, if not given)."""
    order = np.argsort(ids, kind="stable")
    rows = (ids if rows is None else rows)[order]
    ids, weights = ids[order], weights[order]
    most = [max((abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))) for x in (weights, queries)]
    if most[0] * most[1] * weights.shape[1] >= 2 ** 62:
        weights, queries = weights.astype(object), queries.astype(object)
    n, blocks = len(ids), -(-len(ids) // block_rows)
    padded = np.zeros((blocks * block_rows, weights.shape[1]), weights.dtype)
    padded[:n] = weights
    forward = padded.reshape(blocks, block_rows, -1)
    block_ids = np.full(blocks * block_rows, -1, np.int64)
    block_ids[:n] = ids
    block_ids = block_ids.reshape(blocks, block_rows)
    block_own = np.full(blocks * block_rows, -1, np.int64)
    block_own[:n] = rows
    block_own = block_own.reshape(blocks, block_rows)
    real = (np.arange(blocks * block_rows) < n).reshape(blocks, block_rows)
    starts = np.arange(blocks) * block_rows
    largest, smallest = np.maximum.reduceat(weights, starts), np.minimum.reduceat(weights, starts)
    bound = np.zeros((len(queries), blocks), weights.dtype)
    for term in range(weights.shape[1]):
        q = queries[:, term, None]
        bound += np.maximum(q * largest[None, :, term], q * smallest[None, :, term])
    bound = _longs(bound)
    visit = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, visit, 1)
    none = _NONE
    best = np.full((len(queries), k), none)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    active, scored = np.arange(len(queries)), 0
    for turn in range(blocks):
        active = active[bound[active, turn] >= best[active, -1]]
        if not len(active):
            break
        scored += len(active)
        for part in np.array_split(active, -(-len(active) // 256)):
            at = visit[part, turn]
            score = _products(forward[at], queries[part])
            score[~real[at] | (block_own[at] == query_ids[part, None])] = none
            all_scores = np.concatenate([best[part], score], 1)
            all_ids = np.concatenate([best_id[part], np.where(score == none, np.iinfo(np.int64).max, block_ids[at])], 1)
            pick = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
            best[part], best_id[part] = np.take_along_axis(all_scores, pick, 1), np.take_along_axis(all_ids, pick, 1)
    found = best != none
    return np.repeat(query_ids, k).reshape(-1, k)[found], best_id[found], best[found], scored


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
                 vector_col: str = "embedding", group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products of floor(scale * x),
    over all rows but its own. ``is_query`` is a condition on ``vec_id``.

    Data rows are dealt over groups of about ``group_rows``; queries, dealt over
    batches of about as many, visit every group. A task holds one batch and one group.
    """
    usable = usable_rows(vectors, id_col, vector_col, "topk-vectors")
    queries = usable.filter(is_query)
    n, dims, m = usable.agg(F.count("vec_id"), F.max(F.size("v")), F.count(F.when(is_query, 1))).first()
    groups, batches, dims = max(1, -(-n // group_rows)), max(1, -(-m // group_rows)), dims or 1
    data = usable.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups))) \
        .withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    asked = queries.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int")) \
        .withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def search(data: pa.Table, wanted: pa.Table) -> pa.Table:
        if not data.num_rows or not wanted.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_row", "query_id", "vec_id", "score")})
        own = wanted["row"].to_numpy()
        query, vec_id, score, _ = search_blocks(data["vec_id"].to_numpy(), whole_numbers(matrix(data["v"], dims), scale), own,
                                                whole_numbers(matrix(wanted["v"], dims), scale), k, rows=data["row"].to_numpy())
        order = np.argsort(own, kind="stable")
        query_id = wanted["vec_id"].to_numpy()[order[np.searchsorted(own, query, sorter=order)]]
        return pa.table({"query_row": query, "query_id": query_id, "vec_id": vec_id, "score": score})

    found = data.groupBy("grp", "batch").cogroup(asked.groupBy("grp", "batch")) \
        .applyInArrow(search, "query_row long, query_id long, vec_id long, score long")
    return best_per_query(found, k)
