"""Whitening of vectors by a polarised covariance.

Each entry becomes a whole number x = floor(scale * entry) + shift. A first pass counts the
rows and sums every dimension. A second one subtracts the whole part of each mean, so that centred
values are small, and sums the squares of every dimension and of every sum of two dimensions; both
are exact. As (a + b)^2 - a^2 - b^2 = 2ab, differences of those variances are all cross products; what the
means' fractions leave is taken off in whole numbers, so that n^2 times the covariance is known exactly and
is rounded once. Its eigenvectors (numpy's eigh, on dimensions x dimensions in the driver) whiten the rows in a third pass.

Batches work in 64-bit integers where bounds on their values allow it, else in Python's. What is gathered is
dimensions squared, whatever the number of rows.

Handling of odd rows: rows whose vector is null or holds a null or non-finite entry, or one of
2^40 or more after scaling, take no part; null and repeated ids are rows of their own; missing trailing
entries count 0; components without variance (eigenvalue at most 1e-12 of their sum), which no scaling can make 1, are not
returned; a ``deviation`` that does not fit a long is null; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialise, release, ship
from .vectors import matrix

#: Largest scaled entry: squares of sums, added over any number of rows, fit 38 digits.
LIMIT = 1 << 40

#: Eigenvalues up to this share of their sum are rounding, not variance.
LEAST_SHARE = 1e-12

_WHOLE = pa.decimal128(38, 0)


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id, v (array of double) of the rows that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * F.lit(scale) >= F.lit(float(LIMIT))))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(v.isNotNull() & ~bad)


def whole(col: pa.Array, dims: int, scale: float, shift: int) -> np.ndarray:
    return np.floor(scale * matrix(col, dims)).astype(np.int64) + shift


def square_sums(z: np.ndarray) -> np.ndarray:
    """For dimensions d < e the sum over rows of (z_d + z_e)^2 at [d, e], and of z_d^2 at [d, d]; Python integers."""
    largest = int(np.abs(z).max(initial=0))
    if 4 * largest * largest * max(1, len(z)) >= 1 << 63:
        z = z.astype(object)
    dims = z.shape[1]
    out = np.zeros((dims, dims), object)
    for d in range(dims):
        pair = z[:, d:] + z[:, d:d + 1]
        pair[:, 0] = z[:, d]
        out[d, d:] = (pair * pair).sum(0)
    return out


def _summed(rows: DataFrame, start: Callable[[], np.ndarray], add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """The whole numbers that ``add`` gathers in ``start()`` over all batches: one partial result a partition."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start()
        for batch in batches:
            add(total, batch)
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array([Decimal(int(x)) for x in flat], _WHOLE)], ["place", "amount"])
        release()
    sums = rows.mapInArrow(run, "place int, amount decimal(38,0)").groupBy("place").agg(F.sum("amount").alias("amount"))
    total = start().ravel()
    for place, amount in sums.collect():              # as many as ``start()`` has
        total[place] += int(amount)
    return total.reshape(start().shape)


def covariance(q: np.ndarray, n: int, rest: list[int]) -> np.ndarray:
    """The covariance (divisor ``n``) from the square sums of centred values whose sums are ``rest``."""
    dims = len(rest)
    out = np.zeros((dims, dims))
    for d in range(dims):
        for e in range(d, dims):
            product = q[d, d] if d == e else (q[d, e] - q[d, d] - q[e, e]) // 2
            # whole numbers up to here; their quotient is rounded once
            out[d, e] = out[e, d] = (n * product - rest[d] * rest[e]) / (n * n)
    return out


def deviations(z: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Per row the sum over dimensions of (n z - rest)^2, exact; None where it does not fit a long."""
    largest = n * int(np.abs(z).max(initial=0)) + max(rest, default=0)
    if largest * largest * max(1, z.shape[1]) < 1 << 63:
        y = n * z - np.array(rest, np.int64)
        return (y * y).sum(1).tolist()
    y = n * z.astype(object) - np.array(rest, object)
    return [d if d < 1 << 63 else None for d in (y * y).sum(1)]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every row that takes part
    and every component up to ``components``; the last is measured on the whitened rows."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, scale)
    n, dims = rows.agg(F.count("v"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if n == 0 or dims == 0:
        return spark.createDataFrame([], SCHEMA)

    def add_x(total: np.ndarray, batch: pa.RecordBatch) -> None:
        x = whole(batch.column(1), dims, scale, shift)
        total += ((x >> 20).sum(0).astype(object) << 20) + (x & ((1 << 20) - 1)).sum(0)      # halves stay in 64 bits

    sums = [int(x) for x in _summed(rows, lambda: np.zeros(dims, object), add_x)]
    means = np.array([x // n for x in sums], np.int64)                # whole parts
    rest = [x % n for x in sums]                                      # n times what is left of each mean

    def add_squares(total: np.ndarray, batch: pa.RecordBatch) -> None:
        total += square_sums(whole(batch.column(1), dims, scale, shift) - means)

    cov = covariance(_summed(rows, lambda: np.zeros((dims, dims), object), add_squares), n, rest)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(cov))
    kept = int((values[:components] > LEAST_SHARE * trace).sum())
    if kept == 0:
        return spark.createDataFrame([], SCHEMA)
    project = axes[:, :kept] / np.sqrt(values[:kept])
    offset = np.array([r / n for r in rest])

    def turn(batch: pa.RecordBatch) -> pa.RecordBatch:
        z = whole(batch.column(1), dims, scale, shift) - means
        white = (z - offset) @ project
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * kept), pa.array(white.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(z, n, rest), pa.int64()), lists], ["vec_id", "deviation", "w"])

    white = materialise(arrow_map(rows, turn, "vec_id long, deviation long, w array<double>"), "whitened")
    pairs = [(a, b) for a in range(kept) for b in range(a, kept)]
    measured = white.agg(*[F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))) for a, b in pairs]).first()
    error = max(abs(c - (a == b)) for c, (a, b) in zip(measured, pairs, strict=True))
    shares = F.array(*[F.lit(float(v) / trace) for v in values[:kept]])
    return white.select("vec_id", "deviation", F.posexplode("w").alias("_k", "whitened")).select(
        "vec_id", (F.col("_k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_k")).alias("explained"), F.lit(error).alias("identity_error"))
