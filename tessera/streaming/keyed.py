"""State of a stream as a table by key: read by what a batch touches, never grown by history.

Rows live under ``root/bucket=b/epoch=e/base=x``, where the bucket is a hash of one column. A batch adds its
rows as a delta to the buckets it touches. Every ``compact_every`` batches that touch a bucket, the
delta is written as the bucket's base instead: what is kept of all its rows, the latest of each key. A bucket's
rows are its last base and the deltas after it. A batch sees only what earlier epochs wrote, so a batch that is
run again after a failure writes the same partitions again. What a base replaces is removed one batch later, when the
batch that wrote it is known to have been committed.

Files are sorted by the bucket's column and hold a Bloom filter on it: a batch of few keys names them in its filter, and
row groups without them are not read; larger ones are semi-joined. A batch's rows are dealt by a finer hash of the same
column before they are written, so a bucket gets files by its size and not one from every task; the filters are as
large as a file's keys need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys of a batch that are named in the scan's filter at most.
MAX_NAMED = 200

#: Compression of the files.
CODEC = "zstd"


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key (nulls are a key) with the largest ``order`` (columns); make ``order`` total."""
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return out.select(*[F.col(k) if k in keys else F.col(f"__row.{k}").alias(k) for k in rows.columns])


class KeyedTable:
    """``by``: the column whose hash names the bucket and that lookups go by; ``keys``: what names a row;
    ``order``: the columns whose largest value is a row's latest version."""

    def __init__(self, spark: SparkSession, root: str, by: str, keys: Sequence[str], order: Sequence[str],
                 buckets: int = 64, compact_every: int = 8):
        self.spark, self.root, self.by, self.keys, self.order = spark, root.rstrip("/"), by, list(keys), list(order)
        self.buckets, self.compact_every = buckets, compact_every

    def bucket(self, column: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.by) if column is None else column), F.lit(self.buckets)).cast("int")

    # what is there --------------------------------------------------------------------
    def _parts(self, before: int | None) -> dict[int, list[tuple[int, int]]]:
        """Per bucket its (epoch, base) folders of epochs before ``before``; names only, at most buckets x compact_every live ones."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.root}/bucket=*/epoch=*/base=*")
        found = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
        out: dict[int, list[tuple[int, int]]] = {}
        for status in found:
            b, e, x = (int(p.split("=")[1]) for p in status.getPath().toString().rsplit("/", 3)[1:])
            if before is None or e < before:
                out.setdefault(b, []).append((e, x))
        return out

    @staticmethod
    def _live(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
        last = max((e for e, x in parts if x), default=None)
        return sorted((e, x) for e, x in parts if last is None or e > last or (e == last and x))

    def _read(self, parts: dict[int, list[tuple[int, int]]], schema: T.StructType | None) -> DataFrame | None:
        paths = [f"{self.root}/bucket={b}/epoch={e}/base={x}" for b in sorted(parts) for e, x in self._live(parts[b])]
        if not paths:
            return None if schema is None else self.nothing(schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(
            T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("epoch", T.LongType()), T.StructField("base", T.IntegerType())]))
        return reader.option("basePath", self.root).parquet(*paths).drop("bucket", "epoch", "base")

    def nothing(self, schema: T.StructType) -> DataFrame:
        """No rows; the filter tells the optimizer so, which drops the joins and unions with them."""
        return self.spark.createDataFrame([], schema).where(F.lit(False))

    def is_empty(self, epoch: int) -> bool:
        """Whether no epoch before ``epoch`` wrote anything."""
        return not self._parts(epoch)

    def current(self) -> DataFrame | None:
        """The latest version of every row; None where nothing was ever written."""
        rows = self._read(self._parts(None), None)
        return None if rows is None else latest(rows, self.keys, self.order)

    def lookup(self, touched: DataFrame, epoch: int, schema: T.StructType, more: DataFrame | None = None) -> DataFrame:
        """The latest rows, as of before ``epoch``, whose ``by`` is one of those in ``touched``; only their buckets are read.
        Rows of ``more`` count too: one aggregation takes the latest of both."""
        if self.is_empty(epoch):
            return self.nothing(T.StructType(list(schema.fields))) if more is None else latest(more, self.keys, self.order)
        wanted = touched.select(F.col(self.by).alias("__k")).distinct()
        hit = {r[0] for r in wanted.select(self.bucket(F.col("__k"))).distinct().collect()}         # at most ``buckets`` numbers
        rows = self._read({b: p for b, p in self._parts(epoch).items() if b in hit}, schema)
        few = wanted.limit(MAX_NAMED + 1).collect()
        if len(few) <= MAX_NAMED and all(r[0] is not None for r in few):
            rows = rows.where(F.col(self.by).isin([r[0] for r in few]))
        else:
            rows = rows.join(wanted, rows[self.by].eqNullSafe(wanted["__k"]), "left_semi")
        return latest(rows if more is None else rows.unionByName(more), self.keys, self.order)

    # writing --------------------------------------------------------------------------
    def add(self, rows: DataFrame, epoch: int) -> None:
        """Add a batch's rows: deltas, and the base of the buckets whose turn it is."""
        parts = self._parts(epoch)
        self._remove({b: [p for p in ps if p not in self._live(ps)] for b, ps in parts.items()})
        due = sorted(b for b, ps in parts.items() if sum(1 for _, x in self._live(ps) if not x) >= self.compact_every - 1)
        rows = rows.withColumn("bucket", self.bucket())
        touched = rows.where(F.col("bucket").isin(due)).select("bucket").distinct().collect() if due else []
        due = sorted(r[0] for r in touched)
        out = (rows.where(~F.col("bucket").isin(due)) if due else rows).withColumn("base", F.lit(0))
        if due:
            schema = T.StructType([f for f in rows.schema.fields if f.name != "bucket"])
            whole = self._read({b: parts[b] for b in due}, schema).unionByName(rows.where(F.col("bucket").isin(due)).drop("bucket"))
            out = out.unionByName(latest(whole, self.keys, self.order).withColumns({"bucket": self.bucket(), "base": F.lit(1)}))
        # a hot key's or bucket's rows are split over tasks again by their size (rebalance)
        fine = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets) * self.buckets
        out = out.withColumn("__fine", F.pmod(F.xxhash64(self.by), F.lit(fine))).hint("rebalance", F.col("__fine")).drop("__fine")
        (out.withColumn("epoch", F.lit(epoch).cast("long")).sortWithinPartitions("bucket", "epoch", "base", self.by)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).option(f"parquet.bloom.filter.enabled#{self.by}", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.candidates.number", "10")
         .partitionBy("bucket", "epoch", "base").parquet(self.root))

    def _remove(self, parts: dict[int, list[tuple[int, int]]]) -> None:
        for b, gone in parts.items():
            for e, x in gone:
                _delete(self.spark, f"{self.root}/bucket={b}/epoch={e}/base={x}")


class Staging:
    """A batch's intermediate tables, as files under ``root``. Unlike cached rows they hold no memory, nor the
    shuffles they were made with; a batch that is run again writes them again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Remove the tables named, all of them if none is."""
        for path in [f"{self.root}/{n}" for n in names] or [self.root]:
            _delete(self.spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
