"""Approximate nearest neighbours by cross-polytope hashing.

A table turns vectors by a pseudo-random rotation (three rounds of random signs
and a fast Hadamard transform) and assigns each to the nearest signed axis. Every
row is in one bucket of every table; a query looks into the buckets of its
nearest ``probes`` axes in each. Candidates are ranked by the exact cosine of the
original vectors in double precision. Buckets above ``GROUP_ROWS`` rows are
split, and the queries visit each part; nothing is capped. A query whose buckets hold
fewer than k candidates then visits all buckets of one table, that is every row.

Handling of odd rows: rows with a null id, or a vector that is null, empty, zero
or holds a null or non-finite component take no part; rows that share an id all do, and
a query's own row alone is not its candidate; missing trailing components count 0;
no query or no candidate gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialise, random_words
from .vectors import GROUP_ROWS, best_per_query, matrix, top_rows, usable_rows

#: Tables, and axes that a query looks at in each.
TABLES, PROBES = 12, 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the rows of ``x`` (a power of two long), not scaled."""
    step, dims = 1, x.shape[1]
    while step < dims:
        x = x.reshape(-1, dims // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(-1, dims)
        step *= 2
    return x


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """``vectors`` under the pseudo-rotation of ``table``, padded to a power of two."""
    dims = 1 << max(0, vectors.shape[1] - 1).bit_length()
    x = np.zeros((len(vectors), dims))
    x[:, :vectors.shape[1]] = vectors
    words = -(-3 * dims // 64)
    signs = np.unpackbits(random_words(5000 + table, words).view(np.uint8))[:3 * dims].reshape(3, dims) * 2.0 - 1.0
    for row in signs:
        x = hadamard(x * row) / np.sqrt(dims)
    return x


def nearest_axes(vectors: np.ndarray, table: int, number: int) -> np.ndarray:
    """The ``number`` signed axes nearest to each vector, nearest first (2i: +axis i, 2i + 1: -axis i)."""
    x = rotated(vectors, table)
    both = np.stack([x, -x], 2).reshape(len(x), -1)
    if number == 1:
        return both.argmax(1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :number]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; the same bits whatever the rows beside it."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, probes: int = PROBES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest candidates by cosine, its own row left out.
    ``is_query`` is a condition on ``vec_id``."""
    usable = usable_rows(vectors, id_col, vector_col, "ann-vectors", F.exists("v", lambda x: x != 0))
    n, dims = usable.agg(F.count("vec_id"), F.max(F.size("v"))).first()
    dims = dims or 1
    all_axes = 2 << max(0, dims - 1).bit_length()

    def hashed(number: int, tables: int):
        def run(batch: pa.RecordBatch):
            v = matrix(batch.column(2), dims)
            for table in range(tables):
                axes = nearest_axes(v, table, number)
                rows = pa.array(np.repeat(np.arange(len(v)), axes.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(axes.size, table, np.int32)), pa.array(axes.ravel().astype(np.int32)), *(c.take(rows) for c in batch.columns)],
                    ["tab", "axis", "row", "vec_id", "v"])
        return run

    schema = "tab int, axis int, row long, vec_id long, v array<double>"
    data = arrow_map(usable, hashed(1, tables), schema)
    sizes = materialise(data.groupBy("tab", "axis").agg(F.count("row").alias("m")), "ann-buckets") \
        .select("tab", "axis", F.ceil(F.col("m") / group_rows).cast("int").alias("parts"))
    sizes = F.broadcast(sizes)               # tables x 2 x dims rows at most
    data = data.join(sizes, ["tab", "axis"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")

    def rank(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and wanted.num_rows:
            ids, own, v = rows["vec_id"].to_numpy(), rows["row"].to_numpy(), matrix(rows["v"], dims)
            length = np.sqrt((v * v).sum(1))
            for at in range(0, wanted.num_rows, 512):
                some = wanted.slice(at, 512)
                query_rows, query_ids, q = some["row"].to_numpy(), some["vec_id"].to_numpy(), matrix(some["v"], dims)
                near = (q @ v.T) / length
                near[query_rows[:, None] == own[None, :]] = -np.inf
                # a few more than k, for ties that the matrix product rounds apart
                place, real = top_rows(near, ids, k + 3)
                which = np.repeat(np.arange(len(q)), place.shape[1])[real.ravel()]
                place = place.ravel()[real.ravel()]
                out.append((query_rows[which], query_ids[which], own[place], ids[place], cosines(q[which], v[place])))
        found = [np.concatenate(x) for x in zip(*out, strict=True)] or [*[np.zeros(0, np.int64)] * 4, np.zeros(0)]
        return pa.table(dict(zip(("query_row", "query_id", "row", "vec_id", "score"), found, strict=True)))

    def visit(queries: DataFrame, axes: int, tables: int) -> DataFrame:
        asked = arrow_map(queries, hashed(axes, tables), schema).join(sizes, ["tab", "axis"]) \
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        keys = ["tab", "axis", "part"]
        found = data.filter(F.col("tab") < tables).groupBy(*keys).cogroup(asked.groupBy(*keys)) \
            .applyInArrow(rank, "query_row long, query_id long, row long, vec_id long, score double")
        return found.groupBy("query_row", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))

    queries = usable.filter(is_query)
    found = materialise(visit(queries, min(probes, all_axes), tables), "ann-found")
    enough = found.groupBy("query_row").agg(F.count("row").alias("m")).filter(F.col("m") >= min(k, n - 1))
    short = materialise(queries.join(enough, queries["row"] == enough["query_row"], "left_anti"), "ann-short")
    if short.limit(1).count():
        found = found.join(short, found["query_row"] == short["row"], "left_anti").unionByName(visit(short, all_axes, 1))
    return best_per_query(found, k)
