"""Incremental ingestion and scoring with Structured Streaming.

ST1  landed JSON pages -> raw table, exactly once and resumable: file source +
     checkpoint location + ``availableNow`` trigger (a restart resumes after the
     last committed file).
ST2  a record landed again (same SIRET on a later page or re-extraction) is
     dropped. With ``key_index`` that holds whenever it lands again: keys are kept in a
     table by hash bucket (``keyed.KeyedTable``), a batch looks up its own
     buckets only, and the stream itself keeps no state. Without it the stream's state
     drops it with ``dropDuplicatesWithinWatermark``, within ``delay`` (30 days). The event
     time is then the time of the micro-batch that reads the record, which only grows:
     no record is ever late, however old its file is (backfills and copies keep
     their old times). The file source is told to take old files too. Both drop a
     changed record of a known key too: changes are for ``score_stream``.
ST3  establishments are scored as they land. The segment of a row depends on
     every active establishment of its entity, so each micro-batch recomputes the
     touched entities: those of the new records, and those that a record left (a
     table of each establishment's entity finds them). Of several versions of an
     establishment the one with the largest own date counts, then the one landed
     last, then the larger hash; that order is kept in the state, so an older version
     read later (a backfill) changes nothing. Closed establishments are
     left out before sites are counted. Rows that leave the result are written as
     deleted. The three tables are ``KeyedTable``s: a batch reads the buckets it
     touches, as bases merge them, and a replayed batch rewrites its own files.
     They hold the columns that scoring reads; what a batch uses twice is staged in
     files until it ends, and shuffle files go with the step that made them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import compiled_code, freed_shuffles
from ..sources.readers import flatten_structs
from .keyed import KeyedTable, Staging, latest

LANDED_AT, INGESTED_AT = "landed_at", "ingested_at"

# Files of any age count (the source would leave out those a week older than the newest).
MAX_FILE_AGE = "36500d"


def _landed(spark: SparkSession, landing: str, schema: T.StructType, files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("maxFileAge", MAX_FILE_AGE).json(landing)
            .withColumn(LANDED_AT, F.col("_metadata.file_modification_time")))


def ingest_pages(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                 files_per_trigger: int = 1, flatten: bool = True, dedup_key: str | None = None,
                 event_time: str | None = None, delay: str = "30 days", key_index: str | None = None, buckets: int = 64) -> None:
    """Run the ingestion until every landed file is processed (availableNow).

    With ``dedup_key`` a key read again is dropped: ever, if ``key_index`` names a folder for the keys (the sink is
    then partitioned by ``lot``, the micro-batch); else within ``delay`` of ``event_time``, which
    defaults to the time of the reading micro-batch (column ``ingested_at``)."""
    s = _landed(spark, landing, schema, files_per_trigger).withColumn(INGESTED_AT, F.current_timestamp())
    if flatten:
        s = flatten_structs(s)
    if dedup_key and key_index:
        def batch(df: DataFrame, epoch: int) -> None:
            _add_unseen(df, epoch, sink, dedup_key, KeyedTable(df.sparkSession, key_index, dedup_key, [dedup_key], [dedup_key], buckets))
        writer = s.writeStream.foreachBatch(batch)
    else:
        if dedup_key:
            s = s.withWatermark(event_time or INGESTED_AT, delay).dropDuplicatesWithinWatermark([dedup_key])
        writer = s.writeStream.format("parquet").option("path", sink).outputMode("append")
    with compiled_code(spark):
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _add_unseen(df: DataFrame, epoch: int, sink: str, key: str, index: KeyedTable) -> None:
    """Write the batch's first record of every key that no earlier batch had, and remember the keys."""
    if df.isEmpty():
        return
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(LANDED_AT, F.xxhash64(*df.columns))).alias("__r")) \
        .select(*[F.col(key) if c == key else F.col(f"__r.{c}").alias(c) for c in df.columns]).persist()
    try:
        seen = index.lookup(first, epoch, first.select(key).schema).withColumnRenamed(key, "__seen")
        new = first.join(seen, first[key].eqNullSafe(seen["__seen"]), "left_anti")
        (new.withColumn("lot", F.lit(epoch).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("lot").parquet(sink))
        index.add(new.select(key), epoch)
    finally:
        first.unpersist()


#: A version's place among those of its establishment, largest last.
ORDER = ("__date", "__landed", "__hash")


def _scored_tables(spark: SparkSession, root: str, key: str, entity: str, buckets: int, compact_every: int) -> tuple[KeyedTable, KeyedTable, KeyedTable]:
    """Establishments by entity, the entity of each establishment, scored rows by establishment."""
    root = root.rstrip("/")
    return (KeyedTable(spark, f"{root}/establishments", entity, [entity, key], ORDER, buckets, compact_every),
            KeyedTable(spark, f"{root}/owners", key, [key], ORDER, buckets, compact_every),
            KeyedTable(spark, f"{root}/scored", key, [key], ["__epoch"], buckets, compact_every))


def score_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str,
                 score_entities: Callable[[DataFrame], DataFrame], key: str = "siret", entity: str = "siren",
                 active: str | None = None, files_per_trigger: int = 1, buckets: int = 64, own_date: str | None = None,
                 compact_every: int = 8, reads: Sequence[str] | None = None) -> None:
    """ST3: score landed establishments per micro-batch, recomputing touched entities.

    ``active`` is a condition; rows that fail it are neither scored nor counted. ``own_date`` names the column with
    the date of a record's state (ISO text or a date; null is oldest); without it versions go by landing time.
    ``reads`` names the columns that ``score_entities`` and ``active`` read, besides ``key`` and ``entity``: the state and
    the shuffles hold no others (a state that was kept without a column has nulls there). Versions are told apart by all columns."""
    landed = [f.name for f in schema.fields]
    columns = landed if reads is None else [c for c in landed if c in (key, entity, *reads)]
    rest = [c for c in columns if c not in (key, entity)]
    gone = "__gone"

    def batch(df: DataFrame, epoch: int) -> None:
        if df.isEmpty():
            return
        date = F.coalesce(F.col(own_date).cast("string"), F.lit("")) if own_date else F.lit("")
        versions = df.select(*columns, date.alias(ORDER[0]), F.col(LANDED_AT).alias(ORDER[1]), F.xxhash64(*landed).alias(ORDER[2]))
        _score_batch(latest(versions, [key], ORDER), epoch)

    def _score_batch(new: DataFrame, epoch: int) -> None:
        session = new.sparkSession
        sites, owners, out = _scored_tables(session, root, key, entity, buckets, compact_every)
        staging = Staging(session, f"{root.rstrip('/')}/_staged")
        try:
            new = staging.put("new", new)
            if owners.is_empty(epoch):           # all are fresh, none left another entity
                fresh, old, moved = new, F.col(entity), F.lit(False)
            else:
                known = owners.lookup(new, epoch, new.select(key, entity, *ORDER).schema) \
                    .select(F.col(key).alias("__key"), F.col(entity).alias("__old"), F.struct(*ORDER).alias("__known"))
                newer = new.join(known, new[key].eqNullSafe(known["__key"]), "left") \
                    .where(F.col("__known").isNull() | (F.struct(*ORDER) > F.col("__known")))
                moved = F.col("__known").isNotNull() & ~F.col("__old").eqNullSafe(F.col(entity))
                fresh, old, moved = staging.put("fresh", newer.select(*new.columns, "__old", moved.alias("__moved"))), F.col("__old"), F.col("__moved")
                staging.drop("new")
            left = fresh.where(moved).select(key, old.alias(entity), *ORDER, F.lit(True).alias(gone))
            kept = fresh.select(key, entity, *rest, *ORDER, F.lit(False).alias(gone)).unionByName(left, allowMissingColumns=True)
            if kept.isEmpty():
                return                       # older versions only
            # the rows of the touched entities; without a state those are the batch's, one an establishment
            rows = kept if sites.is_empty(epoch) else staging.put("rows", sites.lookup(kept, epoch, kept.schema, kept))
            sites.add(kept, epoch)
            owners.add(fresh.select(key, entity, *ORDER), epoch)
            live = rows.where(~F.col(gone))
            live = live.where(active) if active else live
            scored = staging.put("scored", score_entities(live.select(*columns)))
            # what moved away in an earlier batch is its new entity's matter
            here = rows.where(~F.col(gone)).select(key).unionByName(left.select(key)).distinct()
            removed = here.join(scored.select(F.col(key).alias("__k")), F.col(key).eqNullSafe(F.col("__k")), "left_anti")
            out.add(scored.withColumn("deleted", F.lit(False)).unionByName(removed.withColumn("deleted", F.lit(True)), allowMissingColumns=True)
                    .withColumn("__epoch", F.lit(epoch).cast("long")), epoch)
        finally:
            staging.drop()

    with compiled_code(spark), freed_shuffles(spark):
        (_landed(spark, landing, schema, files_per_trigger).writeStream.foreachBatch(batch)
         .option("checkpointLocation", f"{root.rstrip('/')}/_checkpoint").trigger(availableNow=True).start().awaitTermination())


def latest_scored(spark: SparkSession, root: str, key: str = "siret") -> DataFrame:
    """Current scored rows: the latest version per establishment, without those that left."""
    rows = KeyedTable(spark, f"{root.rstrip('/')}/scored", key, [key], ["__epoch"]).current()
    return rows.where(~F.col("deleted")).drop("deleted", "__epoch")
