"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds (multiplies)
its letters' vectors, the first rolled by two places, the second by one. A text's
vector bundles (adds) the vectors of all its trigrams; a language's prototype
bundles the unit vectors of its training texts. A text gets the language whose
prototype has the largest cosine with it. Anything that is no letter is one
boundary symbol.

Handling of odd rows: null text and texts without a letter get ``und`` and score
0; null languages are not learned; repeated rows count as often as they occur;
ties of the cosine go to the first language by code point; with no labelled row
at all every text is ``und``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import random_words, release, release_when_idle, ship

#: Length of the vectors.
DIMENSIONS = 512

#: Symbols: 0 is the boundary, letters share 1..63 (a to z have one each).
SYMBOLS = 64

#: Training texts: of a larger labelled set, a share chosen by a hash of the id that gives about this many.
MAX_TRAINING_ROWS = 40_000

#: Characters and texts worked on at once (memory is texts x distinct trigrams).
SLICE_CHARS, SLICE_ROWS = 1 << 18, 128

UNDETERMINED = "und"

#: Fixed-point scale of the prototypes' sums, so that reruns agree to the last bit.
_SCALE = 1 << 24

_symbol_of: list[np.ndarray] = []
_letters: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """The symbol of every code point."""
    if not _symbol_of:
        points = np.arange(0x110000, dtype=np.uint64)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        hashed = (points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        symbol = np.where(letter, 27 + hashed % np.uint64(SYMBOLS - 27), 0).astype(np.uint8)
        symbol[ord("a"):ord("z") + 1] = np.arange(1, 27)
        symbol[ord("A"):ord("Z") + 1] = np.arange(1, 27)
        _symbol_of.append(symbol)
    return _symbol_of[0]


def letter_vectors() -> np.ndarray:
    """One vector of +1 and -1 a symbol."""
    if not _letters:
        bits = random_words(71, SYMBOLS * DIMENSIONS // 64)
        signs = np.unpackbits(bits.view(np.uint8)).reshape(SYMBOLS, DIMENSIONS)
        _letters.append(signs.astype(np.float32) * 2 - 1)
    return _letters[0]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    letters = letter_vectors()
    return (np.roll(letters, 2, 1)[codes >> 12] * np.roll(letters, 1, 1)[(codes >> 6) & 63] * letters[codes & 63])


def bundles(texts: list[str | None]) -> np.ndarray:
    """The vector of each text (zero without a letter). Runs of other characters count as one boundary."""
    texts = ["" if t is None else t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = symbol_table()[points].astype(np.int32)
    # text k ends with the boundary at stops[k], where the next one begins
    stops = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    text_of = np.repeat(np.arange(len(texts)), np.diff(stops, prepend=0))
    text_of = np.concatenate([[0], text_of])
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0)
    keep[stops] = True                      # so that no trigram spans two texts
    symbol, text_of = symbol[keep], text_of[keep]
    codes = (symbol[:-2] << 12) | (symbol[1:-1] << 6) | symbol[2:]
    good = (symbol[1:-1] != 0)              # the middle is a letter: its text's
    codes, owner = codes[good], text_of[1:-1][good]
    if not len(codes):
        return np.zeros((len(texts), DIMENSIONS), np.float32)
    present = np.bincount(codes, minlength=SYMBOLS ** 3) > 0
    dense = np.cumsum(present) - 1
    seen = np.flatnonzero(present)
    counts = np.bincount(owner * len(seen) + dense[codes], minlength=len(texts) * len(seen))
    return counts.reshape(len(texts), len(seen)).astype(np.float32) @ trigram_vectors(seen)


def text_slices(col: pa.Array) -> list[tuple[int, int]]:
    """Runs of at most ``SLICE_ROWS`` rows of about ``SLICE_CHARS`` characters together."""
    import pyarrow.compute as pc
    upto = np.cumsum(pc.fill_null(pc.utf8_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    out, at = [], 0
    while at < len(upto):
        before = upto[at - 1] if at else 0
        to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(upto, before + SLICE_CHARS, "right"))))
        out.append((at, to))
        at = to
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(1, keepdims=True))
    return np.divide(vectors, norm, out=np.zeros(vectors.shape), where=norm > 0)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          max_rows: int = MAX_TRAINING_ROWS) -> dict[str, np.ndarray]:
    """Unit prototype of each language in ``labelled`` (rows with a null language are left out).

    Beyond ``max_rows`` labelled rows, a share of them by a hash of the id.
    Each task sends one vector a language; what reaches the driver is languages
    x ``DIMENSIONS`` numbers.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null")
    ship(rows.sparkSession)
    n = rows.select("lang").count()
    if n > max_rows:
        rows = rows.filter(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), batch.column(2)
            for at, to in text_slices(texts):
                vectors = np.rint(unit(bundles(texts.slice(at, to - at).to_pylist())) * _SCALE).astype(np.int64)
                names = np.array(langs[at:to], object)
                for lang in set(langs[at:to]):
                    sums[lang] = sums.get(lang, 0) + vectors[names == lang].sum(0)
        release()
        release_when_idle()
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(sums), object), DIMENSIONS)),
                 pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))), pa.array(np.concatenate(list(sums.values())))],
                ["lang", "dim", "total"])

    sums = rows.mapInArrow(bundle, "lang string, dim int, total long").groupBy("lang", "dim").agg(F.sum("total").alias("total"))
    out: dict[str, np.ndarray] = {}
    for lang, dim, total in sums.collect():
        out.setdefault(lang, np.zeros(DIMENSIONS))[dim] = total
    return {lang: unit(v[None])[0] for lang, v in sorted(out.items()) if v.any()}


def predictor(prototypes: dict[str, np.ndarray]) -> Callable[[Column], Column]:
    """From a text column to struct(lang, score: the cosine, 0 to 1). Only texts go to Python, only predictions come back."""
    names = list(prototypes)
    matrix = np.array([prototypes[x] for x in names]).reshape(len(names), DIMENSIONS)
    known = np.array([*names, UNDETERMINED], object)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for at, to in text_slices(texts):
                vectors = unit(bundles(texts.slice(at, to - at).to_pylist()))
                told = vectors.any(1) & bool(names)
                cosines = vectors @ matrix.T if names else np.zeros((to - at, 1))
                best.append(np.where(told, cosines.argmax(1), -1))
                score.append(np.where(told, cosines.max(1), 0.0))
            yield pa.StructArray.from_arrays([pa.array(known[np.concatenate(best)], pa.string()),
                                              pa.array(np.clip(np.concatenate(score), 0.0, 1.0))], ["lang", "score"])
        release()
        release_when_idle()
    return predict


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
             names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """``docs``, all columns, followed by the predicted language and its score under ``names``
    (a name that ``docs`` has too is then there twice; give others to select by name)."""
    ship(docs.sparkSession)
    # positional names inside, so that no column of the input can clash
    columns = [f"c{k}" for k in range(len(docs.columns))]
    told = docs.toDF(*columns).withColumn("told", predictor(prototypes)(F.col(columns[docs.columns.index(text_col)])))
    return told.select(*columns, "told.lang", "told.score").toDF(*docs.columns, *names)


def determinable(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language can be told, with their columns as they are, whatever their names."""
    ship(docs.sparkSession)
    return docs.filter(predictor(prototypes)(F.col(f"`{text_col}`"))["lang"] != UNDETERMINED)


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def identify_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    prototypes = learn(docs.filter(~held_out(F.col(id_col))), text_col, lang_col, id_col)
    predicted = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), prototypes)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
