"""Near-duplicate documents by HyperMinHash.

A document's set holds the distinct runs of ``words`` lower-cased words, as 64-bit
hashes. Documents with equal sets are one class. A class's sketch has 128 buckets;
of each bucket's smallest hash it stores the number of leading zeros and the ten
bits after the leading one (16 bits). Four registers are a band; classes that
share a band are candidates:

1. every member of a band's bucket with the bucket's smallest member;
2. of what is linked so, the members of one bucket that are in different components and
   look similar are suspects; they are compared with the bucket's most central
   suspect, the one with the fewest shingles that no other suspect has;
3. suspects still in different components are compared with each other, by sketches of 2048
   buckets of a byte first.

So a bucket's members are compared until all that could still join are, without
listing the pairs of a group. Candidates pass an estimate of the Jaccard
similarity, corrected for chance collisions of registers, that leaves five
standard errors of room; in the last two steps they also pass an exact bound: shingles
that no other suspect has are in no intersection. What passes is confirmed on
the full sets.

With 32 bands of 4 registers, a pair with similarity 0.8 shares no band with
probability 5e-8 (buckets empty in both count as equal, unless the whole band is empty).

Handling of odd rows: null, empty and blank texts have an empty set and are
linked with nothing; texts with fewer words than a run have the whole sequence
as their one element; rows with equal texts are one class; rows that share an
id are told apart by their sets; a null id is never a component's id, but
for a component of null ids alone; an empty table gives an empty table. Where
one document of each component is to stay, one row stays: that with the smallest id
(null last); rows that are equal in id and text and have an empty set are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_column, hashed_words, materialise, mix64, own_places, release, release_when_idle, slices
from .components import components

BUCKET_BITS, BANDS = 7, 32
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10

#: Second sketch, made for suspects only.
WIDE_BITS = 11
WIDE_BUCKETS = 1 << WIDE_BITS
_REST = 64 - BUCKET_BITS

#: Ids of candidate documents are broadcast up to this many (16 MB), else joined by a shuffle.
MAX_BROADCAST_IDS = 2_000_000

#: Members of a band's bucket that are compared in one task; larger buckets are cut into pairs of such parts.
PART_ROWS = 512


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``words`` words of each text."""
    hashes, of = hashed_words(raw, bounds)
    n = len(hashes) - words + 1
    runs = np.zeros(max(n, 0), np.uint64)
    for k in range(words):
        runs = (runs + hashes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15) if n > 0 else runs
    runs = mix64(runs)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(runs[a:b - words + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix64(whole ^ hashes[k:k + 1]) + np.uint64(1)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(_REST)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """sets x 128 registers: (leading zeros + 1) and the bits after the leading one; 0 for an empty bucket."""
    smallest = np.zeros((len(sets), BUCKETS), np.uint64)
    there = np.zeros((len(sets), BUCKETS), bool)
    for k, hashes in enumerate(sets):
        if len(hashes):
            at = np.searchsorted(hashes, _STARTS)
            value = hashes[np.minimum(at, len(hashes) - 1)]
            there[k] = (at < len(hashes)) & (value >> np.uint64(_REST) == np.arange(BUCKETS, dtype=np.uint64))
            smallest[k] = value
    low = smallest & np.uint64((1 << _REST) - 1)
    # 53 bits are exact as a double, whose exponent is the bit length
    zeros = (53 - np.frexp((low >> np.uint64(_REST - 53)).astype(np.float64))[1]).astype(np.uint64)
    after = ((low << (zeros + np.uint64(1))) & np.uint64((1 << _REST) - 1)) >> np.uint64(_REST - MANTISSA_BITS)
    return np.where(there, ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | after, 0).astype(np.uint16)


def estimated_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of the sketches in the rows of ``a`` and ``b``, and its standard error at 0.8."""
    used = ((a != 0) | (b != 0)).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    # two different minima share a register if their leading zeros agree (1/3 at equal rates) and their mantissas do
    chance = 1 / 3 / (1 << MANTISSA_BITS)
    share = equal / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), np.sqrt(0.16 / np.maximum(used, 1))


def wide_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """sets x 2048 registers of one byte: bits of each bucket's smallest hash; 0 for an empty bucket."""
    starts = np.arange(WIDE_BUCKETS, dtype=np.uint64) << np.uint64(64 - WIDE_BITS)
    out = np.zeros((len(sets), WIDE_BUCKETS), np.uint8)
    for k, hashes in enumerate(sets):
        bucket = (hashes >> np.uint64(64 - WIDE_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        out[k, bucket[first]] = 1 + (mix64(hashes[first]) % np.uint64(255)).astype(np.uint8)
    return out


def wide_passes(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Whether wide sketches allow a similarity of ``least``, with five standard errors and 0.01 of room.

    The buckets' minima are a draw without replacement from the union, which has
    (na + nb) / (1 + least) elements at most if the sets are similar enough; small sets
    are seen almost whole, so that their error is small."""
    used = np.maximum(((a != 0) | (b != 0)).sum(1), 1)
    share = (((a == b) & (a != 0)).sum(1) / used - 1 / 255) * 255 / 254
    union = (na + nb) / (1 + least)
    error = np.sqrt(0.16 / used * np.clip((union - used) / union, 0, 1))
    return share >= least - 5 * error - 0.01


def _sketches(words: int):
    def run(batch: pa.RecordBatch):
        *others, text = batch.columns
        raw, bounds = binary_column(text)
        for at, to in slices(bounds):
            sets = shingle_sets(raw[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], words)
            sketch = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(at, to - at) for c in others), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) for s in sets], pa.int64()), pa.array([r.tobytes() for r in sketch], pa.binary())],
                [*batch.schema.names[:-1], "n", "class", "sketch"])
    return run


def set_key(hashes: np.ndarray) -> int | None:
    """A 64-bit name of a set of hashes; None for the empty set."""
    if not len(hashes):
        return None
    sums = np.array([mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64), hashes.sum(dtype=np.uint64), len(hashes)], np.uint64)
    return int(mix64(mix64(mix64(sums[:1]) + sums[1:2]) + sums[2:]).view(np.int64)[0])


def _bands(batch: pa.RecordBatch) -> pa.RecordBatch:
    raw, _ = binary_column(batch.column(1))
    band = raw.view(np.uint64).reshape(batch.num_rows, BANDS)
    key = mix64(band ^ _BAND_NAMES[None, :])
    row, which = np.nonzero(band)
    return pa.RecordBatch.from_arrays([pa.array(key[row, which].view(np.int64)), batch.column(0).take(pa.array(row))], ["band", "class"])


def _passes(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    share, error = estimated_jaccard(a, b)
    return (share >= least - 5 * error) & (np.minimum(na, nb) >= least * np.maximum(na, nb) - 1e-9)


def _estimate(least: float):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (binary_column(batch.column(k))[0].view(np.uint16).reshape(batch.num_rows, BUCKETS) for k in (2, 3))
        na, nb = (batch.column(k).to_numpy() for k in (4, 5))
        keep = pa.array(np.flatnonzero(_passes(a, b, na, nb, least)))
        return pa.RecordBatch.from_arrays([batch.column(k).take(keep) for k in (0, 1)], ["a", "b"])
    return run


def _could(na: np.ndarray, nb: np.ndarray, ua: np.ndarray, ub: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these sizes, of which ``ua`` and ``ub`` elements are in no other set, can be similar enough."""
    most = np.minimum(na - ua, nb - ub)
    return den * most >= num * (na + nb - most)


_BAND_NAMES = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))


def _pairs_of_groups(starts: np.ndarray, stops: np.ndarray, part: np.ndarray):
    """(left, right) rows of every pair in each group of rows, some groups at a time: all pairs of a
    group of one part, else those of its first part with its second."""
    left, right, held = [], [], 0
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        m = b - a
        if part[a] == part[b - 1]:
            x, y = np.triu_indices(m, 1) if m > 2 else (np.zeros(m - 1, np.int64), np.ones(m - 1, np.int64))
        else:
            cut = int(np.searchsorted(part[a:b], part[b - 1]))
            x, y = np.repeat(np.arange(cut), m - cut), np.tile(np.arange(cut, m), cut)
        left.append(x + a)
        right.append(y + a)
        held += len(x)
        if held > 1 << 17:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
    if left:
        yield np.concatenate(left), np.concatenate(right)


#: Pairs whose sketches are compared at once (their wide sketches are 4 KB a pair).
_PAIRS = 1 << 12


def _across(num: int, den: int, pairs: bool):
    """Of one part pair of a bucket, what is in different components, could be similar enough and passes the
    estimate: the pairs (each only in the first band that it shares; by wide sketches), or only the classes in them.

    Rows come sorted by (band, i, j, part)."""
    def solve(rows: pa.Table) -> pa.RecordBatch | None:
        band, i, j, part, key, root, n, alone = (rows[c].to_numpy() for c in ("band", "i", "j", "part", "class", "root", "n", "alone"))
        new = np.concatenate([[True], (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        starts = np.flatnonzero(new)
        stops = np.append(starts[1:], len(band))
        sketch = binary_column(rows["sketch"])[0].view(np.uint16).reshape(len(band), BUCKETS)
        bands = sketch.view(np.uint64)
        wide = binary_column(rows["wide"])[0].reshape(len(band), WIDE_BUCKETS) if pairs else None
        out: list[np.ndarray] = []
        for left, right in _pairs_of_groups(starts, stops, part):
            good = (root[left] != root[right]) & _could(n[left], n[right], alone[left], alone[right], num, den)
            left, right = left[good], right[good]
            for at in range(0, len(left), _PAIRS):
                a, b = left[at:at + _PAIRS], right[at:at + _PAIRS]
                if pairs:
                    shared = (bands[a] == bands[b]) & (bands[a] != 0)
                    first = bands[a, shared.argmax(1)] ^ _BAND_NAMES[shared.argmax(1)]
                    here = mix64(first).view(np.int64) == band[a]
                    a, b = a[here], b[here]
                good = _passes(sketch[a], sketch[b], n[a], n[b], num / den)
                a, b = a[good], b[good]
                if pairs:
                    good = wide_passes(wide[a], wide[b], n[a], n[b], num / den)
                    a, b = a[good], b[good]
                out.append(np.stack([key[a], key[b]]))
        if not out:
            return None
        a, b = np.concatenate(out, 1)
        if not pairs:
            return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([a, b])))], ["class"])
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4 * PART_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            last = np.ones(rows.num_rows, bool)
            for c in ("band", "i", "j"):
                column = rows[c].to_numpy()
                last &= column == column[-1]
            whole = int(np.argmax(last))                     # the last group may go on
            if whole:
                out = solve(rows.slice(0, whole))
                if out is not None:
                    yield out
            held = rows.slice(whole).to_batches()
        if held and sum(b.num_rows for b in held):
            out = solve(pa.Table.from_batches(held))
            if out is not None:
                yield out
        release()
        release_when_idle()
    return run


def _parts_of_buckets(members: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, once for every pair (i, j) of parts that they are in."""
    mixed = members.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("class").alias("m")) \
        .filter("lo < hi").select("band", F.ceil(F.col("m") / PART_ROWS).cast("int").alias("parts"))
    rows = members.join(mixed, "band").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    every = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
        F.least(p, F.col("part")).alias("i"), F.greatest(p, F.col("part")).alias("j")))
    rows = rows.withColumn("at", F.explode(every)).withColumns({"i": F.col("at.i"), "j": F.col("at.j")}).drop("at", "parts")
    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "part")


def _confirm(num: int, den: int):
    """Pairs whose sets have ``den`` * intersection >= ``num`` * union."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (left, lb), (right, rb) = (binary_column(batch.column(k)) for k in (2, 3))
        keep = []
        for k in range(batch.num_rows):
            a, b = left[lb[k]:lb[k + 1]].view(np.uint64), right[rb[k]:rb[k + 1]].view(np.uint64)
            at = np.searchsorted(b, a)
            both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            if den * both >= num * (len(a) + len(b) - both):
                keep.append(k)
        keep = pa.array(keep, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(k).take(keep) for k in (0, 1)], ["a", "b"])
    return run


def _sets(words: int):
    def run(batch: pa.RecordBatch):
        raw, bounds = binary_column(batch.column(0))
        for at, to in slices(bounds):
            sets = shingle_sets(raw[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], words)
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["class", "hashes"])
    return run


def _classes(base: DataFrame, words: int, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """``base`` (doc_id, others, text) with n, class and sketch instead of text, and class, root and
    component_id of every class. The class is null where the set is empty."""
    num, den = least
    share = num / den
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    sketches = materialise(arrow_map(base, _sketches(words), f"{kinds}, n long, class long, sketch binary"), "dedup-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "n", "sketch"))
    classes = materialise(sketches.filter("class is not null").groupBy("class").agg(first.alias("f"))
                          .select("class", "f.doc_id", "f.n", "f.sketch"), "dedup-classes")
    bands = arrow_map(classes.select("class", "sketch"), _bands, "band long, class long")
    shared = bands.groupBy("band").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a < z").select("band", "a")
    members = materialise(bands.join(shared, "band"), "dedup-members")

    def sets_of(wanted_classes: DataFrame) -> DataFrame:
        """class, hashes of the classes: their texts are read again, only theirs are shuffled."""
        wanted = materialise(classes.join(wanted_classes, "class", "left_semi").select(F.col("doc_id").alias("_id")).distinct(), "dedup-wanted")
        wanted = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST_IDS else wanted
        texts = base.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        return arrow_map(texts.select("text"), _sets(words), "class long, hashes binary")

    def confirmed(pairs: DataFrame) -> DataFrame:
        sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct())
        # one row a class (rows may share an id), as a plain table: the joins below can be split where a class is hot
        sets = materialise(sets.groupBy("class").agg(F.first("hashes").alias("hashes")), "dedup-sets")
        side = {x: sets.select(F.col("class").alias(x), F.col("hashes").alias(f"s{x}")) for x in "ab"}
        full = pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "sa", "sb")
        return materialise(arrow_map(full, _confirm(num, den), "a long, b long"), "dedup-links")

    def likely(pairs: DataFrame, name: str) -> DataFrame:
        """Of (a, b) pairs, those that pass the estimate."""
        for x in "ab":
            pairs = pairs.join(classes.select(F.col("class").alias(x), F.col("sketch").alias(f"s{x}"), F.col("n").alias(f"n{x}")), x)
        pairs = pairs.select("a", "b", "sa", "sb", "na", "nb")
        return materialise(arrow_map(pairs, _estimate(share), "a long, b long"), name)

    def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
        return rows.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))

    # 1. with the smallest member
    tried = likely(members.filter("class <> a").select("a", F.col("class").alias("b")).distinct(), "dedup-pairs")
    links = confirmed(tried)
    roots = components(links)

    # 2. what is still apart though it shares a bucket and looks similar, with the most central one
    placed = with_roots(members.select("band", "class"), roots).join(classes.select("class", "n", "sketch"), "class")
    rows = _parts_of_buckets(placed.withColumn("alone", F.lit(0).cast("long")))
    suspects = materialise(rows.mapInArrow(_across(num, den, False), "class long").distinct(), "dedup-suspects")
    if suspects.limit(1).count():
        def spread(batch: pa.RecordBatch):
            hashes, bounds = binary_column(batch.column(1))
            for at, to in slices(bounds):
                each = pa.array(np.repeat(np.arange(at, to), np.diff(bounds[at:to + 1]) // 8))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[bounds[at]:bounds[to]].view(np.int64)), batch.column(0).take(each)], ["hash", "class"])

        own = arrow_map(sets_of(suspects), spread, "hash long, class long").groupBy("hash") \
            .agg(F.min("class").alias("class"), F.max("class").alias("other")).filter("class = other")
        alone = suspects.join(own.groupBy("class").agg(F.count("hash").alias("alone")), "class", "left").fillna(0, ["alone"])
        inside = materialise(members.select("band", "class").join(alone, "class"), "dedup-suspect-members")
        central = inside.groupBy("band").agg(F.min(F.struct("alone", "class")).alias("c")).select("band", F.col("c.class").alias("p"))
        near = inside.join(central, "band").filter("class <> p").select(F.least("p", "class").alias("a"), F.greatest("p", "class").alias("b")).distinct()
        near = likely(near.join(tried, ["a", "b"], "left_anti"), "dedup-pairs")
        links = links.unionByName(confirmed(near))
        roots = components(links)

        # 3. what is still apart then
        def widen(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, bounds = binary_column(batch.column(1))
            rows = wide_sketches([hashes[a:b].view(np.uint64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["class", "wide"])

        wide = arrow_map(sets_of(suspects), widen, "class long, wide binary").groupBy("class").agg(F.first("wide").alias("wide"))
        rows = _parts_of_buckets(with_roots(inside, roots).join(classes.select("class", "n", "sketch"), "class").join(wide, "class"))
        rest = rows.mapInArrow(_across(num, den, True), "a long, b long").distinct()
        rest = materialise(rest.join(tried.unionByName(near), ["a", "b"], "left_anti"), "dedup-pairs")
        if rest.limit(1).count():
            roots = components(links.unionByName(confirmed(rest)))

    named = classes.select("class", "doc_id").join(roots.withColumnRenamed("node", "class"), "class", "left") \
        .select("class", F.coalesce("root", "class").alias("root"), "doc_id")
    least_id = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return sketches, materialise(named.join(least_id, "root").select("class", "root", "component_id"), "dedup-named")


def near_duplicates(docs: DataFrame, words: int = 5, least: tuple[int, int] = (80, 100), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Linked are documents whose sets of ``words``-word runs have
    ``least[1] * intersection >= least[0] * union``.
    """
    sketches, by_class = _classes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words, least)
    out = sketches.select("doc_id", "n", "class").join(by_class.drop("root"), "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, least: tuple[int, int] = (80, 100), id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each component: its smallest id's, where ids are
    null or repeated the one with the smallest hash of the text. Rows without a component (an empty set)
    stay, but for repeats of the same id and text."""
    numbered = own_places(docs, "dedup-docs")
    doc = F.col("_doc")
    base = numbered.select(doc[id_col].alias("doc_id"), "file", "place", F.xxhash64(doc[text_col]).alias("tie"), doc[text_col].alias("text"))
    sketches, by_class = _classes(base, words, least)
    rows = materialise(sketches.select("doc_id", "file", "place", "tie", "class").join(by_class.select("class", "root"), "class", "left")
                       .drop("class"), "dedup-rows")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "tie", "file", "place")

    def others(some: DataFrame, keys: list[str]) -> DataFrame:
        """file, place of all but the first row of each group."""
        first = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("f")).filter("n > 1")
        first = materialise(first.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("f.file").alias("_file"), F.col("f.place").alias("_place")), "dedup-kept")
        first = F.broadcast(first) if first.count() <= MAX_BROADCAST_IDS else first
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return some.join(first, same).filter("file <> _file or place <> _place").select("file", "place")

    gone = others(rows.filter("root is not null"), ["root"]).unionByName(others(rows.filter("root is null"), ["doc_id", "tie"]))
    gone = materialise(gone, "dedup-gone")
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone
    return numbered.join(gone, ["file", "place"], "left_anti").select("_doc.*")
