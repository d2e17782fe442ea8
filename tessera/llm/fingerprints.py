"""Document fingerprints by consistent weighted sampling.

A text's terms are its lower-cased words, weighted by how often each occurs. For
sample number j every term gets, from hashes of the term and j, r and c drawn from
Gamma(2, 1) and b drawn from (0, 1); with t = floor(ln(weight) / r + b) and
ln(a) = ln(c) - r (t - b) - r the sample is the (term, t) of the smallest a. Two texts
agree in a sample with the probability of their generalised Jaccard similarity, the sum
of the smaller weights over the sum of the larger. A fingerprint is the samples' 16-bit
tags in hex; ``likeness`` is the share of equal tags.

a and the tag share one long (46 bits of ln(a) above 16 bits of tag), so a sample is a plain
minimum, which needs no sort and combines in a task's hash map.

``edited_fingerprints`` also compares each text with an edited one, which takes
the beginning of the next document. Documents are dealt by ranges of the order; the
first one of a range is copied to the end of the range before, so that a window over a
range sees every neighbour. Texts move in one shuffle, and all later steps group by the
range, so they need no other.

Only DataFrame functions are used. Handling of odd rows: a null text is
empty; an empty text has the fingerprint of tag 0 only, like itself (1) and like
nothing else (0); null ids come last in descending order; rows with one id are ordered by
a hash of their text, then by their place in their file; repeated rows are rows of their
own; a single document is its own next; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, own_places
from .order import numbered

#: Samples of a fingerprint, and bits of a tag. Samples that a row of the work computes together.
SAMPLES, TAG_BITS, BLOCK = 32, 16, 8

#: Ranges that documents are dealt to: at least and at most, and documents of one in between.
MIN_RANGES, MAX_RANGES, RANGE_ROWS = 1024, 65_536, 4096

SEPARATOR = "[\\x20\\x09-\\x0D]+"


def with_terms(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` with ``out``: array of struct(term: hash of a word, weight: its occurrences) of ``text``."""
    words = F.filter(F.split(F.lower(text), SEPARATOR), lambda w: w != "")
    df = df.withColumn("_h", F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))).withColumn("_n", F.size("_h"))
    places = F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(places, lambda i: (i == 0) | (F.get("_h", i) != F.get("_h", i - 1)))
    df = df.withColumn("_p", first)
    return df.withColumn(out, F.transform("_p", lambda i, k: F.struct(
        F.get("_h", i).alias("term"), (F.coalesce(F.get("_p", k + 1), F.col("_n")) - i).alias("weight")))).drop("_h", "_n", "_p")


def _unit(bits: Column, width: int) -> Column:
    """A number between 0 and 1 from ``width`` bits."""
    return (bits + F.lit(0.5)) * F.lit(2.0 ** -width)


def sample(term: Column, log_weight: Column, j: Column) -> Column:
    """Sample ``j`` of a term as one long: ln(a) above, the tag below."""
    g, h = F.xxhash64(term, j * 2), F.xxhash64(term, j * 2 + 1)
    r = -F.ln(_unit(F.shiftrightunsigned(g, 32), 32) * _unit(g.bitwiseAND(F.lit((1 << 32) - 1)), 32))
    c = -F.ln(_unit(F.shiftrightunsigned(h, 43), 21) * _unit(F.shiftrightunsigned(h, 22).bitwiseAND(F.lit((1 << 21) - 1)), 21))
    b = _unit(h.bitwiseAND(F.lit((1 << 22) - 1)), 22)
    t = F.floor(log_weight / r + b)
    # ln(c) >= -15, r <= 46 and ln(weight) <= 22, so ln(a) + 100 lies between 0 and 128
    log_a = F.ln(c) - r * (t - b) - r
    tag = F.pmod(F.xxhash64(g, t), F.lit((1 << TAG_BITS) - 1)) + 1
    return F.shiftleft(F.floor((log_a + 100) * F.lit(2.0 ** 39)), TAG_BITS).bitwiseOR(tag)


def signatures(rows: DataFrame, keys: list[str], terms: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``tags`` (array of int; 0: no term) of every row. ``keys`` name a row.

    A term is taken once a block of ``BLOCK`` samples, so that the generated code stays small enough to be compiled.
    """
    blocks = -(-samples // BLOCK)
    rows = rows.select(*keys, F.inline_outer(terms)).withColumn("weight", F.ln(F.col("weight").cast("double"))) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    least = rows.groupBy(*keys, "block").agg(*[
        F.min(sample(F.col("term"), F.col("weight"), F.col("block") * BLOCK + i)).alias(f"s{i}") for i in range(BLOCK)])
    tag = [F.coalesce(F.col(f"s{i}").bitwiseAND(F.lit((1 << TAG_BITS) - 1)), F.lit(0)).cast("int") for i in range(BLOCK)]
    parts = F.sort_array(F.collect_list(F.struct("block", F.array(*tag).alias("tags"))))
    return least.groupBy(*keys).agg(F.slice(F.flatten(parts["tags"]), 1, samples).alias("tags"))


def as_text(tags: Column) -> Column:
    """A fingerprint as hex digits, four a tag."""
    return F.array_join(F.transform(tags, lambda x: F.lower(F.lpad(F.hex(x), TAG_BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tags: an estimate of the generalised Jaccard similarity of the two texts."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a).cast("double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """id, fingerprint of every row, for use on its own: one shuffle of the samples by row, none of texts."""
    rows = own_places(docs, "prints-docs").select(F.col(f"_doc.{id_col}").alias("_id"), F.col(f"_doc.{text_col}").alias("_text"), "file", "place")
    rows = with_terms(rows, F.coalesce("_text", F.lit("")), "terms")
    return signatures(rows, ["file", "place", "_id"], "terms", samples) \
        .select(F.col("_id").alias(id_col), as_text(F.col("tags")).alias("fingerprint"))


def _in_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``key``) with ``part`` and ``guard``: every row in its range, and the first row
    of each range once more, as the guard at the end of the range before."""
    names = rows.columns
    keys = numbered(rows.select("key"), [F.col("key")], "prints-order")
    n = keys.count()
    step = max(1, -(-n // min(MAX_RANGES, max(MIN_RANGES, n // RANGE_ROWS))))
    firsts = materialise(keys.filter(F.col("idx") % step == 0).select("key"), "prints-ranges")
    # the first keys of the ranges in chunks: a row finds its chunk, then its range in it
    ranges, chunk = max(1, -(-n // step)), max(1, int((n / step) ** 0.5))
    bounds = firsts.agg(F.sort_array(F.collect_list("key")).alias("b")) \
        .select(F.transform(F.sequence(F.lit(1), F.lit(ranges), F.lit(chunk)), lambda i: F.slice("b", i, chunk)).alias("b"))
    rows = rows.withColumn("_b", bounds.scalar())
    rows = rows.withColumn("_c", F.size(F.filter("_b", lambda x: F.get(x, F.lit(0)) <= F.col("key"))) - 1)
    rows = rows.withColumn("_mine", F.get("_b", F.col("_c")))
    rows = rows.withColumn("_i", F.size(F.filter("_mine", lambda x: x <= F.col("key"))) - 1)
    part = (F.col("_c") * chunk + F.col("_i")).cast("int")
    own = F.struct(part.alias("part"), F.lit(0).alias("guard"))
    ahead = F.struct(F.pmod(part - 1, F.lit(ranges)).cast("int").alias("part"), F.lit(1).alias("guard"))
    ahead = F.when(F.get("_mine", F.col("_i")) == F.col("key"), ahead)
    return rows.select(*names, F.inline(F.array(own, ahead))).filter("part IS NOT NULL")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 3,
                        samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last floor(n_chars / ``share``) code points replaced by the first as many of
    the next document in descending order of ids (after the last: the first).
    """
    rows = own_places(docs, "prints-docs").select(
        F.col(f"_doc.{id_col}").cast("long").alias("doc_id"), F.coalesce(F.col(f"_doc.{text_col}"), F.lit("")).alias("text"), "file", "place")
    # ~id falls as the id rises, and never overflows
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"),
                   F.xxhash64("text").alias("h"), "file", "place")
    rows = _in_ranges(rows.select("doc_id", "text", key.alias("key")))

    along = W.partitionBy("part").orderBy("guard", "key")
    rows = rows.withColumns({"at": F.row_number().over(along), "n_chars": F.length("text").cast("long"), "_next": F.lead("text").over(along)})
    cut = F.floor(F.col("n_chars") / share).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("_next"), F.lit(1), cut))
    rows = rows.withColumn("edited", F.when(F.col("guard") == 0, edited))
    rows = rows.withColumn("sha", F.unhex(F.sha2("edited", 256)))
    # both texts as rows of one range: grouping by the range and more needs no exchange
    two = F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))
    row = ["part", "at", "guard", "doc_id", "n_chars", "sha"]
    bodies = rows.select(*row, F.inline(two)).filter("body IS NOT NULL")
    tags = signatures(with_terms(bodies, F.col("body"), "terms"), [*row, "version"], "terms", samples)
    of = [F.max(F.when(F.col("version") == v, F.col("tags"))).alias(name) for v, name in ((0, "own"), (1, "changed"))]
    tags = tags.groupBy(*row).agg(*of)
    tags = tags.withColumn("_next", F.lead("own").over(W.partitionBy("part").orderBy("at")))
    return tags.filter("guard = 0").select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("_next")).alias("near_next"))
