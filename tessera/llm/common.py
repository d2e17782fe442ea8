"""Helpers shared by the corpus operators: whole-text byte views of Arrow
batches, hashed words, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import tempfile
import threading
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, small_reader_batches

#: Word separators of the contracts: space and the ASCII controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts are worked on in slices of about this many bytes, to bound a task's memory.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_reader_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: sent once an application, unless PYTHONPATH already has it."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    on_path = str(root) in map(os.path.realpath, os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if on_path or sc.applicationId in _shipped or not root.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-py-"), "tessera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(Path(__file__).resolve().parents[1].rglob("*.py")):
            z.write(file, file.relative_to(root))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


#: Rows of an Arrow batch while an intermediate table is made: rows hold whole texts or sets.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialise(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    columns can be pruned by whoever reads the table. Python stages of ``df`` get
    batches of ``batch_rows`` rows, to bound a worker's memory.
    """
    spark = df.sparkSession
    ship(spark)
    small_reader_batches(spark)
    path = scratch_path(spark, f"tessera-llm/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def own_place(df: DataFrame) -> tuple[Column, Column]:
    """Hash of the file and place in it of each row of a plain table of files: a row's own
    name, the same whenever the table is read."""
    at = df.metadataColumn("_metadata")
    return F.xxhash64(at["file_path"]), at["row_index"]


def own_places(df: DataFrame, name: str) -> DataFrame:
    """``_doc`` (all columns of ``df``), ``file`` and ``place`` (a row's own name, see ``own_place``).

    What is no plain table of files is written once first.
    """
    def named(df: DataFrame) -> DataFrame:
        file, place = own_place(df)
        return df.select(F.struct(*[df[c] for c in df.columns]).alias("_doc"), file.alias("file"), place.alias("place"))

    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return named(df)
        except AnalysisException:                 # a table, but not of files
            pass
    return named(materialise(df, name))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is
    (the join is then a shuffle join, which adaptive execution splits on skew).

    ``df`` should be materialised: its rows are counted here.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (Stafford's variant 13 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words: the same on every machine."""
    return mix64((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE_VALUES = random_words(17, 256)[_LOWER]
_BASE = 0x9E3779B97F4A7C55
_powers: dict[int, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n-1 of an odd base modulo 2^64, and of its inverse. They are as long as the longest text, so they
    are kept only while a worker asks for them."""
    drop_when_idle("powers", _powers.clear)
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = _powers.get(base)
        if steps is None or len(steps) < n:
            steps = np.full(1 << max(n - 1, 0).bit_length(), base, np.uint64)
            steps[0] = 1
            _powers[base] = steps = np.multiply.accumulate(steps)
        out.append(steps[:n])
    return out[0], out[1]


def binary_column(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and each row's bounds (n + 1 offsets).
    Nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, offsets, data = col.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes together; a longer row stands alone."""
    n, at = len(bounds) - 1, 0
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


def hashed_words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of the texts in ``raw``, in order, and
    each text's bounds in them. A word never crosses texts."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = ~_IS_SPACE[raw]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | first[1:n]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    power, inverse = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * power, out=total[1:])
    words = mix64((total[stop] - total[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))
    return words, np.searchsorted(begin, bounds)


def release() -> None:
    """Give freed memory back to the system: Python workers stay alive, idle, between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim is not None:
        trim(0)


_used: dict[str, float] = {}
_used_lock = threading.Lock()


def drop_when_idle(name: str, drop: Callable[[], None], seconds: float = 1.0) -> None:
    """Call ``drop`` when this worker has not said so again for ``seconds``: what is kept between the tasks of a
    stage is given back when other stages follow. ``drop`` must be harmless at any time."""
    with kept_while_used(name, drop, seconds):
        pass


@contextmanager
def kept_while_used(name: str, drop: Callable[[], None], seconds: float = 1.0) -> Iterator[None]:
    """Around work, however long, with what this worker keeps: ``drop`` is called, as by ``drop_when_idle``, when no
    such work has run for ``seconds``."""
    with _used_lock:
        waiting = name in _used
        _used[name] = math.inf

    def wait() -> None:
        while True:
            with _used_lock:
                if time.monotonic() - _used[name] >= seconds:
                    del _used[name]
                    break
            time.sleep(seconds / 4)
        drop()
        release()
    if not waiting:
        threading.Thread(target=wait, daemon=True).start()
    try:
        yield
    finally:
        with _used_lock:
            _used[name] = time.monotonic()


def release_when_idle() -> None:
    """``release`` once this worker rests: while it works, the batch in hand is still held, and what is freed after a
    task's last batch would stay with the allocators of each idle worker."""
    drop_when_idle("freed memory", gc.collect)


def arrow_map(df: DataFrame, f, schema: str) -> DataFrame:
    """``f(batch) -> RecordBatch``s (or one, or None) over the Arrow batches of each partition."""
    ship(df.sparkSession)
    small_reader_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = f(batch)
                if out is not None:
                    yield from ([out] if isinstance(out, pa.RecordBatch) else out)
                del out
            del batch
            release()
            release_when_idle()
        release()
    return df.mapInArrow(run, schema)
