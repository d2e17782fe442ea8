"""Toxicity scores from a factorization machine over hashed terms.

Terms are whole words and word beginnings (3 to 7 letters of longer words), hashed to 40 bits.
Terms that the same training rows have (a word and its beginnings, mostly) are one feature, whose
value is the share of them that a text has. The machine learns a weight and a small vector for
each, so that besides the sum of weights the inner products of every two present features count
(an insult together with a group mention, say).

A feature is used if its rows are toxic more or less often than chance explains. With a share p of toxic rows, a of
a feature's n rows toxic and G = a ln(a / np) + (n - a) ln((n - a) / n(1 - p)), Chernoff's bound gives chance at most
exp(-G) on either side. Of V features those with G >= ln V stay, so that chance alone would bring about one a side, whatever the
number of rows: few rows suffice in a small vocabulary, and there is no bound on how many stay.
The bound asks for independent rows, so near copies with one label are learned from once.

Handling of odd rows: null and empty texts score the base rate; labels null or
without a document are not learned; of several labels of one id the largest
counts; without any training row all score 0.05; repeated rows are scored each;
an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_column, materialise, mix64, powers, random_words, slices
from .language import text_slices
from .near_dedup import shingle_sets

#: Training documents: of a larger labelled set, a share by a hash of the id that gives about this many.
MAX_TRAINING_ROWS = 20_000

#: Factors of each feature.
FACTORS = 8

#: Words of a shingle and minima kept of each text, to tell near copies among the training rows.
COPY_WORDS, COPY_KEYS = 4, 4

PREFIXES = (3, 4, 5, 6, 7)
TERM_BITS = 40
_FILTER_BITS = 18

_tables: list[np.ndarray] = []


def _points() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and its 64-bit value."""
    if not _tables:
        _tables.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
        _tables.append(random_words(1009, 0x110000))
    return _tables[0], _tables[1]


def hashed_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every occurrence: hashes of lower-cased words and word beginnings."""
    texts = ["" if t is None else t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, value = _points()
    inside = letter[points]
    edge = np.diff(inside.astype(np.int8))
    begin, stop = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    power, inverse = powers(len(points))
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(value[points] * power, out=total[1:])
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    owner = np.searchsorted(ends, begin, "right")
    shift = inverse[begin]
    terms = [mix64((total[stop] - total[begin]) * shift)]
    owners = [owner]
    for size in PREFIXES:
        long = stop - begin > size
        b = begin[long]
        terms.append(mix64((total[b + size] - total[b]) * shift[long] + np.uint64(size)))
        owners.append(owner[long])
    return np.concatenate(owners), np.concatenate(terms) >> np.uint64(64 - TERM_BITS)


def _distinct(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term), texts in a slice below 2^24."""
    key = np.unique((owner.astype(np.uint64) << np.uint64(TERM_BITS)) | term)
    return (key >> np.uint64(TERM_BITS)).astype(np.int64), key & np.uint64((1 << TERM_BITS) - 1)


class TermFinder:
    """Finds the features of texts by their terms: a small bit table passes most other terms by."""

    def __init__(self, terms: np.ndarray, feature: np.ndarray):
        order = np.argsort(terms)
        self.terms, self.feature = terms[order], feature[order]
        self.share = (1 / np.bincount(self.feature))[self.feature] if len(terms) else np.zeros(0)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(terms & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, value), each pair once, by text: value is the share of the feature's terms that the text has."""
        owner, term = hashed_terms(texts)
        some = self.maybe[(term & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]
        owner, term = owner[some], term[some]
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        hit = self.terms[at] == term if len(self.terms) else np.zeros(0, bool)
        pairs = np.unique((owner[hit].astype(np.int64) << 32) | at[hit])
        owner, at = pairs >> 32, pairs & ((1 << 32) - 1)
        found, where = np.unique((owner << 32) | self.feature[at], return_inverse=True)
        return found >> 32, found & ((1 << 32) - 1), np.bincount(where, self.share[at], len(found))


@dataclass
class Machine:
    """A trained factorization machine; ``terms[i]`` belongs to ``feature[i]``, which has a weight and a vector."""

    terms: np.ndarray
    feature: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, owner: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(owner, self.weights[feature] * value, n)
        pairs = np.zeros(n)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[feature, f] * value
            pairs += np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def base_rate(positive: int, total: int) -> float:
    """Log odds of the label before a term is seen; 5 % without any row."""
    return float(np.log((positive + 0.05) / (total - positive + 0.95)))


def fit(rows: list[np.ndarray], label: np.ndarray, m: int, steps: int = 600, batch: int = 512,
        rate: float = 0.01, decay: float = 0.01) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and vectors of ``m`` features, from the features of each row (ascending, each once) and its label.

    Mini-batch Adam on the logistic loss; a step touches only the features of its rows. Weights
    start at the features' log odds, held back as if each were also seen in a few rows of the usual kind. Deterministic.
    """
    rng = np.random.default_rng(10)
    n = len(rows)
    label = label.astype(np.float32)
    bias = base_rate(int(label.sum()), n)
    weights = np.zeros(m, np.float32)
    vectors = rng.normal(0, 0.02, (m, FACTORS)).astype(np.float32)
    if n == 0 or m == 0 or label.min() == label.max():
        return bias, weights.astype(np.float64), np.zeros((m, FACTORS))
    sizes = np.array([len(r) for r in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(rows).astype(np.int64)
    number = np.bincount(flat, minlength=m)
    toxic = np.bincount(flat, np.repeat(label, sizes), m)
    share, few = label.mean(), 8.0
    odds = np.log((toxic + few * share) / label.sum()) - np.log((number - toxic + few * (1 - share)) / (n - label.sum()))
    weights[:] = np.clip(odds, -6, 6)
    params = [np.array([bias], np.float32), weights, vectors]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    everything = np.arange(1)
    for step in range(1, steps + 1):
        chosen = rng.integers(0, n, batch) if n > batch else np.arange(n)
        size = sizes[chosen]
        owner = np.repeat(np.arange(len(chosen)), size)
        place = np.repeat(starts[chosen] - np.cumsum(size) + size, size) + np.arange(size.sum())
        seen, where = np.unique(flat[place], return_inverse=True)
        x = np.zeros((len(chosen), len(seen)), np.float32)
        x[owner, where] = 1
        y, b, w, v = label[chosen], params[0], weights[seen], vectors[seen]
        xv = x @ v
        z = b + x @ w + ((xv ** 2).sum(1) - (x @ (v ** 2)).sum(1)) / 2
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        slope = x.T @ off
        grads = [np.array([off.sum()]), slope, x.T @ (off[:, None] * xv) - slope[:, None] * v]
        for p, g, a, s, at in zip(params, grads, mean, square, (everything, seen, seen), strict=True):
            a[at] = 0.9 * a[at] + 0.1 * g
            s[at] = 0.99 * s[at] + 0.01 * g * g
            move = (a[at] / (1 - 0.9 ** step)) / (np.sqrt(s[at] / (1 - 0.99 ** step)) + 1e-6)
            p[at] -= rate * (move + (decay * p[at] if p is not params[0] else 0))
    return float(params[0][0]), weights.astype(np.float64), vectors.astype(np.float64)


def _counted(batches):
    """term, toxic, rows, same (XOR of the rows' hashes) of the terms of (label, text, hash) batches."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        mark = batch.column(2).to_numpy(zero_copy_only=False)
        for at, to in text_slices(batch.column(1)):
            owner, term = _distinct(*hashed_terms(batch.column(1).slice(at, to - at).to_pylist()))
            if not len(term):
                continue
            order = np.argsort(term, kind="stable")
            owner, term = owner[order], term[order]
            begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(term[begin].astype(np.int64)), pa.array(np.add.reduceat(label[at:to][owner].astype(np.int64), begin)),
                 pa.array(np.diff(np.append(begin, len(term)))), pa.array(np.bitwise_xor.reduceat(mark[at:to][owner], begin))],
                ["term", "toxic", "rows", "same"])


def telling_features(labelled: DataFrame) -> DataFrame:
    """feature (a hash of its rows), terms: sets of terms of the same rows that tell more than chance (see above).

    ``labelled``: label, text, mark (a hash of the row). Features of a single row stay out.
    """
    positive, total = (x or 0 for x in labelled.agg(F.sum("label"), F.count("label")).first())
    if not 0 < positive < total:
        return labelled.sparkSession.createDataFrame([], "feature long, terms array<long>")
    counts = labelled.select("label", "text", "mark").mapInArrow(_counted, "term long, toxic long, rows long, same long") \
        .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("rows").alias("n"), F.bit_xor("same").alias("feature")) \
        .filter(F.col("n") >= 2)
    counts = materialise(counts, "toxicity-terms")
    features = counts.select("feature", "a", "n").distinct()
    a, b, n = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double"), F.col("n").cast("double")
    share = positive / total

    def part(k: Column, p: float) -> Column:
        return F.when(k > 0, k * F.log(k / (n * F.lit(p)))).otherwise(0.0)

    gain = part(a, share) + part(b, 1 - share)
    telling = features.filter(gain >= float(np.log(max(features.count(), 1))))
    return counts.join(telling, ["feature", "a", "n"], "left_semi").groupBy("feature").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def learn(labelled: DataFrame) -> Machine:
    """Train on ``labelled`` (label 0/1, text, mark; at most about ``MAX_TRAINING_ROWS`` rows).

    What reaches the driver comes from these rows alone: the features that tell, and for each
    row the numbers of those that it has.
    """
    kept = sorted((r.feature, r.terms) for r in telling_features(labelled).collect())
    terms = np.array([t for _, own in kept for t in own], np.uint64)
    feature = np.array([k for k, (_, own) in enumerate(kept) for _ in own], np.int64)
    finder = TermFinder(terms, feature)

    def find(batches):
        for batch in batches:
            for at, to in text_slices(batch.column(1)):
                owner, found, _ = finder(batch.column(1).slice(at, to - at).to_pylist())
                bounds = np.searchsorted(owner, np.arange(to - at + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.ListArray.from_arrays(pa.array(bounds), pa.array(found.astype(np.int32)))],
                                                 ["label", "found"])

    # sorted, so that a training run doesn't depend on how rows are spread
    examples = sorted(labelled.select("label", "text").mapInArrow(find, "label int, found array<int>").collect())
    rows = [np.array(found, np.int64) for _, found in examples]
    return Machine(terms, feature, *fit(rows, np.array([float(x) for x, _ in examples]), len(kept)))


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with toxic_score."""
    finder = TermFinder(machine.terms, machine.feature)
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch):
        parts = []
        for at, to in text_slices(batch.column(place)):
            parts.append(machine.scores(*finder(batch.column(place).slice(at, to - at).to_pylist()), to - at))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], [f"c{k}" for k in range(batch.num_columns + 1)])

    # positional names inside, so that no column of the input can clash
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema))
    return arrow_map(numbered, run, f"{schema}, c{len(docs.columns)} double").toDF(*docs.columns, "toxic_score")


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned: CRC-32 of the id's text is 0 modulo 5."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """label, text, mark (a hash of the text) of the labelled documents (a share of them beyond ``max_rows``), copies once.

    The chosen labels are a bounded table, broadcast, so texts aren't shuffled.
    """
    chosen = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).dropna() \
        .groupBy("_id").agg(F.max("label").alias("label"))
    chosen = materialise(chosen, "toxicity-labels")
    n = chosen.count()
    if n > max_rows:
        chosen = chosen.filter(F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    # copies of one text would make any of its words look telling
    rows = rows.groupBy(F.xxhash64("text").alias("mark")).agg(F.max_by(F.struct("label", "text"), F.struct("label", "_doc")).alias("row"))
    rows = materialise(rows.select("row.label", "row.text", "mark"), "toxicity-training")
    return rows.join(F.broadcast(without_copies(rows)), "mark", "left_semi").select("label", "text", "mark")


def without_copies(rows: DataFrame) -> DataFrame:
    """mark of the ``rows`` (label, text, mark) to learn from: those that have the smallest mark of the rows
    with their label and minimum, for each of ``COPY_KEYS`` min-hashes of their shingles.

    Two texts of similarity s both stay with a chance of (1 - s)^4; of a group of copies one stays at least.
    """
    def run(batches):
        for batch in batches:
            raw, bounds = binary_column(batch.column(1))
            for at, to in slices(bounds):
                sets = shingle_sets(raw[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], COPY_WORDS)
                keys = np.array([[mix64(s ^ np.uint64(k)).min() if len(s) else 0 for k in range(COPY_KEYS)] for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(c).slice(at, to - at).to_numpy(zero_copy_only=False), COPY_KEYS)) for c in (0, 2)]
                    + [pa.array(np.tile(np.arange(COPY_KEYS, dtype=np.int32), to - at)), pa.array(keys.reshape(-1).astype(np.int64))],
                    ["label", "mark", "k", "key"])

    keys = rows.select("label", "text", "mark").mapInArrow(run, "label int, mark long, k int, key long")
    first = keys.groupBy("label", "k", "key").agg(F.min("mark").alias("mark"))
    return materialise(first.groupBy("mark").count().filter(F.col("count") == COPY_KEYS).select("mark"), "toxicity-rows")


def score_corpus(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Learn from the labels that are not held out and score all: doc_id, held_out, score, predicted."""
    machine = learn(training_rows(docs, labels.filter(~held_out(F.col(id_col))), id_col, text_col, label_col))
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), machine)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
