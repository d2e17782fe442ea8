"""Spark session helpers.

Cluster settings (executor sizing, ``spark.checkpoint.dir``) belong to whoever
launches the job; this module only fills in what is unset, so the same code runs
on a laptop test and on a large cluster.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (this is
# the size check behind every join whose side is not bounded by construction),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "tessera", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating one with ``DEFAULT_CONF`` if none runs."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only in local mode when unset.

    On a cluster the setting names a shared folder every executor can reach.
    Without it intermediate tables would land on each executor's own disk, so
    this raises. The fallback is for local runs (one machine holds driver and
    executors): a fresh folder under the system temp dir.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        path = fallback or tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


#: Rows that Spark's Parquet reader unpacks at once. A row of the corpus is a whole text: the reader's own 4096 of them
#: are arrays of tens of MB in every task, which a heap takes as huge objects of many regions and grows for.
READER_ROWS = ("spark.sql.parquet.columnarReaderBatchSize", "256")


def small_reader_batches(spark: SparkSession) -> None:
    """Let the session read whole texts a few at a time, unless it names a number of rows itself."""
    name, rows = READER_ROWS
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, rows)


#: The JVM never compiles a method of more bytecode than this; it runs it interpreted.
_LARGEST_COMPILED = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def _holding(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compiled_code(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, a stage whose generated code would be one method too large for the JVM's compiler runs operator
    by operator, with code that is compiled. The session's own setting comes back afterwards."""
    return _holding(spark, *_LARGEST_COMPILED)


#: Without it shuffle files stay until the driver's garbage collector finds that nothing refers to their plan.
_SHUFFLES_FREED = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, an action's shuffle files are removed when it ends. For actions that run their plan once: a plan made
    within and run again makes its shuffles again. The session's own setting comes back afterwards."""
    return _holding(spark, *_SHUFFLES_FREED)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint dir for materialised intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
