"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed place on a hash line. Of a source that must give
``budget`` words, the documents below a threshold on that line are taken. The
threshold is found without sorting: words are summed by (source, hash bucket),
the bucket in which the running sum passes the budget is the boundary, and only
the boundary bucket is looked into again with finer buckets, until single hash
values are left. Rows with one id share a place: if they are the boundary, they are told
apart by a hash of their text, then of all their columns, and equal rows by their own place in
their file, each by such a search again. A document too large for what is left of the budget ends a
pass; the next pass fills the gap from documents that still fit. In the end one document
more is taken if that brings the source nearer to its target.

Handling of odd rows: null text counts as size 0 (taken 0); a null source is a
source of its own, last in order; rows with equal id (repeats, null ids) are
taken one by one; of equal rows any may be the ones taken; an empty table gives
an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import running_sums
from .common import WORD, materialise, own_place, own_places

#: Bits of the hash line, and of one histogram level.
LINE_BITS, LEVEL_BITS = 60, 12

#: A row's place: on the hash line by its id, then by its text, by all its columns, and last a number of its own.
KEYS = ("line", "by_text", "by_row", "own")

#: The table of sources is broadcast up to this many rows (a few MB).
MAX_BROADCAST_SOURCES = 50_000

#: Passes of the threshold search; each later pass fills the gap its predecessor left.
PASSES = 3


def hash_line(col: Column) -> Column:
    """The place of an id on the hash line: the first 60 bits of the MD5 of its text."""
    digest = F.md5(F.concat(F.coalesce(col.cast("string"), F.lit("null")), F.lit("|mix")))
    return F.conv(F.substring(digest, 1, LINE_BITS // 4), 16, 10).cast("long")


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words), line (place on the hash line), by_text and by_row (places among rows with one id, and one text)."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_line(F.col(id_col)).alias("line"), _bits(F.xxhash64(F.col(text_col))).alias("by_text"),
        _bits(F.xxhash64(*[docs[f"`{c}`"] for c in _hashable(docs)])).alias("by_row"))


def _hashable(docs: DataFrame) -> list[str]:
    """Columns that Spark can hash: those without a map or variant in them."""
    return [f.name for f in docs.schema if not re.search(r"\b(map<|variant\b)", f.dataType.simpleString())]


def _bits(hashed: Column) -> Column:
    """A hash cut to the bits of the line."""
    return hashed.bitwiseAND(F.lit((1 << LINE_BITS) - 1))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """source, source_size, target: all words shared out by weight, no target above
    ``max_epochs`` times its source; what a full source can't take is shared out again.

    The fixed point of that resharing is one level per unit of weight: sources
    in order of (cap / weight), the level is what is left after the full ones.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # sources may be as many as hosts or addresses: numbers and sums come from ranges and their offsets
    by_name = F.col("source").asc_nulls_last()
    named = running_sums(per_source, [by_name], {}, rank="number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    caps = (named.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(max_epochs))
            .withColumn("cap_level", F.col("cap") / F.col("weight")).drop("number"))
    summed = running_sums(caps, [F.col("cap_level").asc(), by_name], {"caps_to": "cap", "weights_to": "weight"},
                          totals={"words": "source_size", "all_weights": "weight"})
    level = ((F.col("words") - (F.col("caps_to") - F.col("cap")))
             / (F.col("all_weights") - (F.col("weights_to") - F.col("weight"))))
    levels = summed.withColumn("level", level)
    fixed = levels.agg(F.max(F.when(F.col("cap_level") >= F.col("level"), F.col("level")))).scalar()
    return levels.select("source", "source_size",
                         F.least(F.col("cap").cast("double"), fixed * F.col("weight")).alias("target"))


def _boundary(rows: DataFrame, bucket: Column) -> DataFrame:
    """Per source: the first bucket in which the running sum passes the gap, and the sum before it."""
    hist = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
    upto = W.partitionBy("source").orderBy("bucket")
    hist = hist.withColumn("upto", F.sum("words").over(upto)).filter(F.col("upto") > F.col("gap"))
    return hist.groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"))).alias("b")) \
        .select("source", "b.bucket", "b.below")


def _same_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    renamed = right.withColumnRenamed("source", "_source")
    return left.join(renamed, left["source"].eqNullSafe(renamed["_source"]), how).drop("_source")


def _threshold(rows: DataFrame, key: str, hint) -> DataFrame:
    """Per source that can't be taken whole: ``upto``, the largest value of ``key`` such
    that the sizes of all rows up to it stay within the gap, ``used``, their sum, ``at``, the
    next value, and ``n``, its rows.

    ``rows``: source, size, gap and ``key``. Three nested levels: buckets, buckets of
    the boundary bucket, single hash values of its boundary bucket. ``hint``
    marks a table of one row a source for broadcasting if that is small.
    """
    high, low = LINE_BITS - LEVEL_BITS, LINE_BITS - 2 * LEVEL_BITS
    mask = F.lit((1 << LEVEL_BITS) - 1)
    first = materialise(_boundary(rows, F.shiftright(key, high)), "mix-level")
    inner = _same_source(rows, hint(first), "inner") \
        .filter(F.shiftright(key, high) == F.col("bucket")) \
        .select("source", "size", key, F.col("gap").alias("whole_gap"), (F.col("gap") - F.col("below")).alias("gap"),
                (F.col("bucket") * F.lit(1 << high)).alias("start"))
    second = _boundary(inner, F.shiftright(key, low).bitwiseAND(mask))
    last = _same_source(inner, hint(second), "inner") \
        .filter(F.shiftright(key, low).bitwiseAND(mask) == F.col("bucket")) \
        .select("source", "size", key, "whole_gap", (F.col("gap") - F.col("below")).alias("gap"),
                (F.col("start") + F.col("bucket") * F.lit(1 << low)).alias("start"))
    values = last.groupBy("source", key).agg(F.sum("size").alias("words"), F.count("size").alias("n"), F.first("gap").alias("gap"),
                                             F.first("start").alias("start"), F.first("whole_gap").alias("whole_gap"))
    values = values.withColumn("total", F.sum("words").over(W.partitionBy("source").orderBy(key)))
    fits = F.col("total") <= F.col("gap")
    used = F.first("whole_gap") - F.first("gap") + F.coalesce(F.max(F.when(fits, F.col("total"))), F.lit(0))
    return values.groupBy("source").agg(F.coalesce(F.max(F.when(fits, F.col(key))), F.min("start") - 1).alias("upto"), used.alias("used"),
                                        F.min(F.when(~fits, F.struct(F.col(key).alias("at"), "n"))).alias("stop")) \
        .select("source", "upto", "used", "stop.at", "stop.n")


def _thresholds(rows: DataFrame, hint) -> DataFrame:
    """Per source that can't be taken whole: ``used``, and for each of ``KEYS`` ``upto_`` and ``at_``.

    Rows up to ``upto_`` of a key are within the gap; those at ``at_``, where there are several, are
    told apart by the next key (null if it isn't needed).
    """
    steps: list[DataFrame] = []
    for key in KEYS:
        found = materialise(_threshold(rows, key, hint), "mix-threshold")
        steps.append(found)
        tied = found.filter("n > 1").select("source", F.col("at").alias("_at"), F.col("used").alias("_used"))
        if key == KEYS[-1] or not tied.limit(1).count():
            break
        rows = _same_source(rows, hint(tied), "inner").filter(F.col(key) == F.col("_at")) \
            .withColumn("gap", F.col("gap") - F.col("_used")).drop("_at", "_used")
    out = steps[0].select("source", "used", F.col("upto").alias(f"upto_{KEYS[0]}"), F.col("at").alias(f"at_{KEYS[0]}"))
    for k, key in enumerate(KEYS[1:], 1):
        if k < len(steps):
            more = steps[k].select("source", F.col("upto").alias(f"upto_{key}"), F.col("at").alias(f"at_{key}"), F.col("used").alias("_more"))
            out = _same_source(out, hint(more), "left").withColumn("used", F.col("used") + F.coalesce("_more", F.lit(0))).drop("_more")
        else:
            out = out.withColumn(f"upto_{key}", F.lit(None).cast("long")).withColumn(f"at_{key}", F.lit(None).cast("long"))
    return out


def _plan(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int):
    """The sources' targets (source, source_size, target, whole, gap), the thresholds of each
    pass (``sizes`` with ``KEYS``), the place of a last document, and the broadcast hint for tables of one row a source.

    No document that fits is left then or the passes are over; the one whose size is
    nearest to the gap is taken too, if that brings the source nearer to its target.
    """
    targets = source_targets(sizes, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = materialise(targets.withColumn("whole", whole)
                          .withColumn("gap", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    hint = F.broadcast if targets.count() <= MAX_BROADCAST_SOURCES else (lambda df: df)
    passes: list[DataFrame] = []
    gaps = targets.select("source", "gap")
    for _ in range(PASSES):
        here = _same_source(sizes, hint(gaps), "inner")
        here = _taken(here, passes, hint).filter(~F.col("extra") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))).drop("extra")
        everything = here.groupBy("source").agg(F.sum("size").alias("everything"))
        found = _same_source(_same_source(gaps, hint(_thresholds(here, hint)), "left"), hint(everything), "left").select(
            "source", F.col("gap").alias("limit"), F.coalesce(f"upto_{KEYS[0]}", F.lit((1 << LINE_BITS) - 1)).alias(f"upto_{KEYS[0]}"),
            f"at_{KEYS[0]}", *[f"{x}_{key}" for key in KEYS[1:] for x in ("upto", "at")],
            (F.col("gap") - F.coalesce("used", "everything", F.lit(0))).alias("gap"))
        found = materialise(found, "mix-threshold")
        gaps = found.select("source", "gap")
        passes.append(found)
    here = _taken(_same_source(sizes, hint(gaps), "inner"), passes, hint) \
        .filter(~F.col("extra") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")))
    nearest = here.withColumn("off", F.abs(F.col("size") - F.col("gap"))).filter("off < gap") \
        .groupBy("source").agg(F.min(F.struct("off", *KEYS)).alias("n"))
    last = _same_source(gaps.select("source"), hint(nearest), "left").select("source", *[F.col("n")[key].alias(f"_last_{key}") for key in KEYS])
    last = materialise(last, "mix-last")
    return targets, passes, last, hint


def _taken(rows: DataFrame, passes: list[DataFrame], hint) -> DataFrame:
    """``rows`` with ``extra``: whether one of the passes so far took the row."""
    extra, kept = F.lit(False), rows.columns
    for k, found in enumerate(passes):
        named = found.drop("gap")
        rows = _same_source(rows, hint(named.toDF("source", *[f"_{c}{k}" for c in named.columns[1:]])), "inner")
        within = F.lit(False)
        for key in reversed(KEYS):
            within = (F.col(key) <= F.col(f"_upto_{key}{k}")) | ((F.col(key) == F.col(f"_at_{key}{k}")) & within)
        extra = extra | ((F.col("size") > 0) & (F.col("size") <= F.col(f"_limit{k}")) & F.coalesce(within, F.lit(False)))
    return rows.withColumn("extra", extra).select(*kept, "extra")


def _decided(rows: DataFrame, targets: DataFrame, passes: list[DataFrame], last: DataFrame, hint) -> DataFrame:
    """``rows`` (source, size, KEYS and others) with source_size, target and copies."""
    named = targets.select("source", "source_size", "target", "whole")
    rows = _same_source(rows, hint(named), "inner")
    rows = _same_source(_taken(rows, passes, hint), hint(last), "inner")
    is_last = F.lit(True)
    for key in KEYS:
        is_last = is_last & F.coalesce(F.col(key) == F.col(f"_last_{key}"), F.lit(False))
    extra = F.col("extra") | ((F.col("size") > 0) & is_last)
    return rows.withColumn("copies", F.col("whole") + extra.cast("long")).drop("whole", "extra", *[f"_last_{key}" for key in KEYS])


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often each document enters the mix.

    Returns doc_id, size, source, source_size, target, copies (0 to
    ``max_epochs``), one row per input row. A source whose target is q times its
    size is taken floor(q) times whole and once more up to a hash threshold.
    """
    sizes = materialise(document_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    sizes = sizes.withColumn("own", _bits(F.xxhash64(*own_place(sizes))))
    return _decided(sizes, *_plan(sizes, weights, max_epochs)).drop(*KEYS)


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: ``docs``, all columns, each document repeated as often as ``mix`` says.

    The thresholds are applied to the documents where they lie: only sizes are
    shuffled, never texts.
    """
    numbered = own_places(docs, "mix-docs")
    doc = F.col("_doc")
    own = _bits(F.xxhash64("file", "place")).alias("own")
    by_row = _bits(F.xxhash64(*[doc.getField(c) for c in _hashable(docs)])).alias("by_row")
    fields = numbered.select("_doc", own, by_row, doc[id_col].alias("_id"), doc[text_col].alias("_text"), doc[source_col].alias("_source"))
    size = F.coalesce(F.regexp_count(F.col("_text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    rows = fields.select("_doc", F.col("_source").alias("source"), size, hash_line(F.col("_id")).alias("line"),
                         _bits(F.xxhash64("_text")).alias("by_text"), "by_row", "own")
    plan = _plan(materialise(rows.drop("_doc"), "mix-sizes"), weights, max_epochs)
    decided = _decided(rows, *plan).filter("copies > 0")
    return decided.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")
