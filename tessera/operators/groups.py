"""Group statistics attached to rows, deduplication, duplicate reports.

Skew model: any one key may hold a large share of all rows. Rows are
partitioned on (key, salt): keys whose row count exceeds ``rows_per_task`` are
spread over ``ceil(count / rows_per_task)`` buckets by a deterministic hash of
the row, every other key has a single bucket. Joins to one-row-per-key sides
replicate only the heavy keys' rows once per bucket (``SaltPlan.join``), and
group statistics (``attach_group_stats``) are a window over (key, salt) -- exact
for every light key, with no new shuffle when the input is already partitioned
that way -- corrected for the heavy keys by a broadcast aggregate over their
rows. A window over the key alone would put a hot key's rows in one task; nothing here does.

Heavy keys come from a table of counts per key where there is one, and otherwise
from a mergeable sketch of frequent items, which moves no key: every task
sends one sketch of bounded size. Either way at most ``MAX_HEAVY`` keys, the largest, are split
(and broadcast); a key beyond these holds at most one in ``MAX_HEAVY`` of all rows. Which keys
are split never changes a result, only where rows are worked on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "__salt"
HEAVY = "__heavy"            # row belongs to a key split over several buckets
TOTAL = "__total"            # a total of the row's group, brought along by a join on the key
SALT_COLUMNS = (SALT, HEAVY, TOTAL)   # internal columns: never published
_BUCKETS = "__buckets"
_N = "__n"

# Rows of one key handled by one task before the key is split; a session can
# override it with the conf key below (tuning without code changes).
DEFAULT_ROWS_PER_TASK = 2_000_000
ROWS_PER_TASK_CONF = "tessera.salt.rowsPerTask"

# Keys that are split at most, and items that a sketch keeps: it finds every key with
# more than about 1 / (4 * MAX_HEAVY) of all rows, and counts exactly while there are fewer keys than items.
MAX_HEAVY = 4096
_SKETCH_ITEMS = 4 * MAX_HEAVY
_SKETCH_PARTS = 64           # sketches are merged in two steps: by part, then these few
_SKETCHED = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def rows_per_task_for(df: DataFrame, rows_per_task: int | None = None) -> int:
    """Explicit value, else the session's ``tessera.salt.rowsPerTask``, else the default."""
    if rows_per_task is not None:
        return int(rows_per_task)
    return int(df.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK)))


@dataclass
class SaltPlan:
    """Bucket counts for the heavy keys of one fact table.

    Build it once per fact and reuse it for every join on the same keys, so the
    fact keeps one (key, salt) partitioning across joins (no re-shuffle)."""
    keys: tuple[str, ...]
    heavy: DataFrame             # keys + __buckets, only keys above the threshold
    null_safe: bool = True

    @classmethod
    def from_counts(cls, counts: DataFrame, keys: Sequence[str], count_col: str,
                    rows_per_task: int | None = None, null_safe: bool = True) -> "SaltPlan":
        rows_per_task = rows_per_task_for(counts, rows_per_task)
        heavy = (counts.where(F.col(count_col) > rows_per_task)
                 .orderBy(F.col(count_col).desc(), *keys).limit(MAX_HEAVY)
                 .select(*keys, F.ceil(F.col(count_col) / F.lit(rows_per_task)).cast("int").alias(_BUCKETS)))
        return cls(tuple(keys), heavy, null_safe)

    @classmethod
    def for_fact(cls, fact: DataFrame, keys: Sequence[str],
                 rows_per_task: int | None = None, null_safe: bool = True) -> "SaltPlan":
        """Heavy keys of ``fact``: by a sketch for one key of text or whole numbers, else by exact counts.

        The sketch is read here, in a job of its own, and becomes part of the plan: merged in another order it
        could name other keys, and all joins must split the same ones."""
        if len(keys) == 1 and isinstance(fact.schema[keys[0]].dataType, _SKETCHED):
            rows_per_task = rows_per_task_for(fact, rows_per_task)
            rows = [(k, -(-n // rows_per_task)) for k, n in frequent_keys(fact, keys[0]) if n > rows_per_task]
            schema = T.StructType([T.StructField(keys[0], fact.schema[keys[0]].dataType), T.StructField(_BUCKETS, T.IntegerType())])
            heavy = fact.sparkSession.createDataFrame(rows, schema)
            return cls(tuple(keys), heavy if rows else heavy.where(F.lit(False)), null_safe)
        counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
        return cls.from_counts(counts, keys, _N, rows_per_task, null_safe)

    def _with_buckets(self, df: DataFrame) -> DataFrame:
        h = F.broadcast(self.heavy.select(*[F.col(k).alias(f"__h_{k}") for k in self.keys], _BUCKETS))
        cond = None
        for k in self.keys:
            c = df[k].eqNullSafe(h[f"__h_{k}"]) if self.null_safe else df[k] == h[f"__h_{k}"]
            cond = c if cond is None else cond & c
        return df.join(h, cond, "left").drop(*[f"__h_{k}" for k in self.keys])

    def salt_fact(self, fact: DataFrame, salt_from: Sequence[str]) -> DataFrame:
        """Add ``__salt`` = hash of ``salt_from`` modulo the key's bucket count.
        The hash is deterministic, so a recomputed task (lost executor) sends
        every row to the same bucket again."""
        if SALT in fact.columns:
            return fact
        f = self._with_buckets(fact)
        return (f.withColumns({SALT: F.pmod(F.xxhash64(*salt_from), F.coalesce(F.col(_BUCKETS), F.lit(1))).cast("int"),
                               HEAVY: F.col(_BUCKETS).isNotNull()})
                .drop(_BUCKETS))

    def replicate(self, side: DataFrame) -> DataFrame:
        """One copy of each side row per bucket of its key (one copy for light keys)."""
        s = self._with_buckets(side)
        return (s.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_BUCKETS), F.lit(1)) - 1)))
                .drop(_BUCKETS))

    def join(self, fact: DataFrame, side: DataFrame, how: str = "left",
             salt_from: Sequence[str] | None = None) -> DataFrame:
        """Equi-join ``fact`` to ``side`` (at most one row per key) on (key, salt),
        skew-safe. Null keys never match (plain equality), so the output stays
        hash-partitioned and sorted on (key, salt): a later window or join on the
        same columns adds no exchange. Output keeps ``__salt``."""
        f = self.salt_fact(fact, salt_from or fact.columns)
        s = self.replicate(side)
        s = s.select(*[F.col(k).alias(f"__s_{k}") for k in self.keys], F.col(SALT).alias("__s_salt"),
                     *[c for c in s.columns if c not in self.keys and c != SALT])
        cond = None
        for k in self.keys:
            c = f[k] == s[f"__s_{k}"]
            cond = c if cond is None else cond & c
        cond = cond & (f[SALT] == s["__s_salt"])
        return f.join(s, cond, how).drop(*[f"__s_{k}" for k in self.keys], "__s_salt")


def frequent_keys(df: DataFrame, key: str, most: int = MAX_HEAVY) -> list[tuple]:
    """(value, estimated rows) of the most frequent values of ``key``, at most ``most`` of them, the null among them.

    No value is listed that the sketch is not sure of; none with more than about a 1 / (4 * MAX_HEAVY) of
    the rows is missing (if ``most`` allows)."""
    # by the task that read a row, so that rows stay where they are until they are in a sketch
    parts = df.select(F.col(key).alias("k"), F.pmod(F.spark_partition_id(), F.lit(_SKETCH_PARTS)).alias("part")).groupBy("part") \
        .agg(F.expr(f"approx_top_k_accumulate(k, {_SKETCH_ITEMS})").alias("sketch"), F.count_if(F.col("k").isNull()).alias("nulls"))
    found = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {_SKETCH_ITEMS})").alias("sketch"), F.sum("nulls").alias("nulls")) \
        .select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top"), "nulls").first()
    if found is None:                        # no rows
        return []
    values = [(r["item"], r["count"]) for r in found.top if r["item"] is not None] + ([(None, found.nulls)] if found.nulls else [])
    return sorted(values, key=lambda v: (-v[1], v[0] is not None, v[0] if v[0] is not None else 0))[:most]


def attach_group_stats(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
                       salt_from: Sequence[str] | None = None, plan: SaltPlan | None = None,
                       rows_per_task: int | None = None, keep_salt: bool = False) -> DataFrame:
    """Add per-group aggregates to every row: the skew-safe form of
    ``agg OVER (PARTITION BY keys)``. Null keys form one group, as in SQL.

    ``aggs`` are aggregate columns usable both in ``groupBy().agg`` and
    ``over()`` (avg, sum, count, min, max, ...). Without a ``plan`` the heavy
    keys are found by ``SaltPlan.for_fact``."""
    if plan is None:
        plan = SaltPlan.for_fact(df, keys, rows_per_task)
    f = plan.salt_fact(df, salt_from or df.columns)
    w = Window.partitionBy(*keys, SALT)
    out = f.withColumns({n: c.over(w) for n, c in aggs.items()})
    # heavy keys span several buckets: aggregate their rows across buckets. The
    # filter is on a column set when salting, so it is pushed below the shuffle:
    # this branch reads the fact again but moves only the heavy keys' rows.
    hv = (f.where(F.col(HEAVY)).groupBy(*keys)
          .agg(*[c.alias(f"__hv_{n}") for n, c in aggs.items()]))
    hv = F.broadcast(hv.select(*[F.col(k).alias(f"__hvk_{k}") for k in keys], *[f"__hv_{n}" for n in aggs],
                               F.lit(True).alias("__hv_hit")))
    on = None
    for k in keys:
        c = out[k].eqNullSafe(hv[f"__hvk_{k}"])
        on = c if on is None else on & c
    out = out.join(hv, on, "left")
    out = out.withColumns({n: F.when(F.col("__hv_hit"), F.col(f"__hv_{n}")).otherwise(F.col(n)) for n in aggs})
    out = out.drop(*[f"__hvk_{k}" for k in keys], *[f"__hv_{n}" for n in aggs], "__hv_hit")
    return out if keep_salt else out.drop(*SALT_COLUMNS)


def group_size(df: DataFrame, keys: Sequence[str], name: str = "nb_etablissements",
               salt_from: Sequence[str] | None = None, **kw) -> DataFrame:
    """Attach the row count of each row's group (group + left merge)."""
    return attach_group_stats(df, keys, {name: F.count(F.lit(1))}, salt_from, **kw)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (give a total order for a
    deterministic result). Implemented as a ``max_by`` style aggregate over a
    struct, so partial aggregation keeps a hot key's shuffle at one row per map
    task instead of ranking all its rows in one task."""
    cols = [c for c in df.columns if c not in keys]
    # min of struct(order keys..., row) picks the first row by order; descending
    # order keys are expressed by the caller (e.g. negate or use desc-able keys).
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], F.struct(*cols).alias("__row"))
    agg = df.groupBy(*keys).agg(F.min(packed).alias("__m"))
    return agg.select(*keys, *[F.col(f"__m.__row.{c}").alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """Keys appearing at least ``min_count`` times, with their counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_occurrences"))
            .where(F.col("nb_occurrences") >= min_count))


def latest_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order_date: Column,
                   tie_break: Sequence[Column], default_days: int = -10**9, name: str = "p") -> DataFrame:
    """Latest row per key by a date (missing date = oldest), ties resolved by
    ``tie_break`` ascending: the row form of ``functions.latest_struct``.

    ``min_by`` over a struct key is partially aggregated, so a key with a huge
    history ships one candidate per map task instead of one array of all rows."""
    days = F.coalesce(F.datediff(order_date, F.lit("1970-01-01").cast("date")), F.lit(default_days))
    order = F.struct((F.lit(0) - days).alias("__d"), *[c.alias(f"__t{i}") for i, c in enumerate(tie_break)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias(name))
