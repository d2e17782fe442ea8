"""Packing token runs into sequences of a fixed length: best-fit decreasing per
part, with bins certified by dual-feasible-function lower bounds.

Documents become pieces of at most ``capacity`` tokens (only longer documents
are cut). Pieces are dealt over parts of bounded size; each part packs its own by
best-fit decreasing and compares its bin count with a lower bound. A part that
meets its bound is proven optimal and keeps its bins, but for those with much room. Parts
with a gap keep their full bins only. The pieces of the other bins go into a common pool,
which, dealt anew over fewer parts, is packed again. The last round keeps what it gets.

Handling of odd rows: null or empty text is a document of the end token alone;
repeated rows (equal ids included) are packed as often as they occur; null ids
are kept; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, kept_while_used, materialise, release_when_idle, slices

CAPACITY = 4096

#: Tokens of one part: bounds the pieces that a packing task holds (as many as this, if all had one token).
PART_TOKENS = 1 << 20

#: Rounds of packing; pieces of parts with a gap go from one to the next.
ROUNDS = 3

#: A proven part keeps bins with at most this fraction (1 / SLACK) of the capacity empty.
SLACK = 32

#: Known runs of a tokenizing worker (about 15 MB, kept between the tasks of a stage); beyond, those of the last slice stay.
KNOWN_RUNS = 300_000

#: Bytes of texts whose distinct runs are looked up together, and new words tokenized in one call.
SLICE_BYTES, CALL_WORDS = 1 << 21, 10_000

#: Lower-case Latin letters, and marks that no special token has and no contraction begins with.
_LATIN = "[" + "".join(chr(c) for c in range(0x61, 0x250) if chr(c).isalpha() and chr(c).lower() == chr(c)) + "]"
_MARKS = r"[!\"#$%&()*+,./:;=?@^~-]"

#: Marks that end a run after a letter; set apart, so that the word is known without them.
_TAIL = f"({_LATIN})({_MARKS}+)( |$)"


class WordTokenizer:
    """Token ids of whole texts by a ``tokenizers`` file, as little-endian unsigned 32-bit words.

    For a byte-level tokenizer that lower-cases, drops white space, splits at it and between letters and
    marks, and tells the last token of a word by a suffix: a text's ids are those of its
    white-space-free runs, one after the other, so each distinct run is tokenized once and looked
    up after that, all runs of a slice of texts together. New runs of lower-case Latin letters
    go to the tokenizer's model, many in a call; all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # known runs, the number of ids of each, and the ids end to end
        self.runs = pa.array([], pa.large_string())
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def whole(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and their number for each of ``runs``, by the whole tokenizer."""
        ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *ids]), np.array([len(x) for x in ids], np.int64)

    def latin(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``whole``, for words of lower-case Latin letters."""
        out = [(np.zeros(0, "<u4"), np.zeros(0, np.int64))]
        for at in range(0, len(words), CALL_WORDS):
            some = words.slice(at, CALL_WORDS).to_pylist()
            ids = np.array(self.words.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            out.append((ids, np.diff(stops, prepend=0)) if len(stops) == len(some) else self.whole(some))
        ids, sizes = zip(*out, strict=True)
        return np.concatenate(ids), np.concatenate(sizes)

    def learn(self, runs: pa.Array) -> np.ndarray:
        """Tokenize the distinct ``runs`` where they are new; the place of each among the known ones."""
        place = pc.index_in(runs, self.runs).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place
        easy = pc.match_substring_regex(runs.take(pa.array(new)), f"^{_LATIN}+$").to_numpy(zero_copy_only=False)
        new = np.concatenate([new[easy], new[~easy]])
        place[new] = np.arange(len(new)) + len(self.runs)
        words, others = (runs.take(pa.array(x)) for x in np.split(new, [int(easy.sum())]))
        parts = [self.latin(words), self.whole(others.to_pylist())]
        self.runs = pa.concat_arrays([self.runs, words, others])
        self.ids = np.concatenate([self.ids, *(x for x, _ in parts)])
        self.sizes = np.concatenate([self.sizes, *(x for _, x in parts)])
        return place

    def of(self, place: np.ndarray) -> np.ndarray:
        """The ids of known runs, end to end."""
        begin, size = (np.cumsum(self.sizes) - self.sizes)[place], self.sizes[place]
        return self.ids[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    @staticmethod
    def plain(text: str | None) -> str:
        text = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ")
        # lower-casing first changes nothing but for a final sigma, a dotted capital i,
        # marks not yet composed, and the names of special tokens
        if "\u03a3" not in text and "\u0130" not in text and "<|" not in text and unicodedata.is_normalized("NFC", text):
            return text.lower()
        return text

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        column = pc.replace_substring_regex(pa.array([self.plain(t) for t in texts], pa.large_string()), _TAIL, r"\1 \2\3")
        runs = pc.split_pattern(column, " ")
        coded = runs.values.dictionary_encode()
        known = self.learn(coded.dictionary)
        place = known[coded.indices.to_numpy()]
        stops = np.concatenate([[0], np.cumsum(self.sizes[place])])[runs.offsets.to_numpy()]
        ids = self.of(place)
        if len(self.runs) > KNOWN_RUNS:
            self.runs, self.sizes, self.ids = coded.dictionary, self.sizes[known], self.of(known)
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(stops.tolist())]


_tokenizers: dict[str, WordTokenizer] = {}


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and an end id, cut at ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch):
        texts, ids = batch.column(1), batch.column(0)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
        for at, to in slices(np.concatenate([[0], np.cumsum(sizes)]), SLICE_BYTES):
            with kept_while_used("tokenizers", _tokenizers.clear):
                tokens = _tokenizers.get(tokenizer_path)
                if tokens is None:
                    tokens = _tokenizers[tokenizer_path] = WordTokenizer(tokenizer_path)
                codes = tokens(texts.slice(at, to - at).to_pylist())
                del tokens
            rows: list[tuple] = []
            for k, code in enumerate(codes, at):
                code += end
                for piece, start in enumerate(range(0, len(code), 4 * capacity)):
                    part = code[start:start + 4 * capacity]
                    rows.append((k, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            k, *rest = (np.array(x) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(k)), *(pa.array(x, t) for x, t in zip(rest, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), cut,
                     f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY, most_k: int = 30) -> int:
    """Bins that any packing of ``lengths`` needs, by dual-feasible functions: the sizes as
    they are, sizes with those above ``capacity - e`` as full and those below ``e`` as
    nothing for every ``e``, and sizes rounded to multiples of ``capacity / k``."""
    if not len(lengths):
        return 0
    best = -(-int(lengths.sum()) // capacity)
    count = np.bincount(lengths, minlength=capacity + 1)
    number, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    e = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    middle = total[capacity - e] - total[e - 1]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, most_k + 1):
        scaled = lengths * (k + 1)
        exact = scaled % capacity == 0
        # in units of capacity * k, so that all is whole numbers
        value = np.where(exact, lengths * k, (scaled // capacity) * capacity)
        best = max(best, -(-int(value.sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the room left in each bin. Ties by input order."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some: list[int] = []                     # the rooms that some open bin has, ascending
    for k in order.tolist():
        size = int(lengths[k])
        at = bisect_left(some, size)
        if at == len(some):
            bin_, room = len(rooms), capacity
            rooms.append(capacity)
        else:
            room = some[at]
            bin_ = by_room[room].pop()
            if not by_room[room]:
                del some[at]
        bins[k], offsets[k] = bin_, capacity - room
        rooms[bin_] = room = room - size
        if room:
            if not by_room[room]:
                some.insert(bisect_left(some, room), room)
            by_room[room].append(bin_)
    return bins, offsets, np.array(rooms, np.int64)


def _pack_part(capacity: int, last: bool, step: int):
    def run(table: pa.Table) -> pa.Table:
        release_when_idle()
        table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_numpy().astype(np.int64)
        part = table.column("_part")[0].as_py()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        done = np.ones(len(rooms), bool)
        if not last:
            if len(rooms) > lower_bound(lengths, capacity):
                done = rooms == 0
            else:
                done = rooms <= capacity // SLACK          # proven, but bins with much room may serve others
        # a sequence number holds the round, the part and the bin
        sequence = (np.int64(step) << np.int64(60)) | (np.int64(part) << np.int64(24)) | bins
        out = {c: table.column(c) for c in ("_row", "doc_id", "piece", "start", "length", "ids_crc32")}
        return pa.table(out | {"sequence_id": sequence, "offset": offsets, "_done": done[bins]})
    return run


def pack(piece_rows: DataFrame, capacity: int = CAPACITY, part_tokens: int = PART_TOKENS, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` rows with ``sequence_id`` and ``offset``; sequences are filled from 0 without gaps.

    A piece of the full capacity is a bin of its own in whatever part it falls. Pieces are dealt by a number of
    their row, given when they are written, so equal rows (one id, one text, however many) are spread like any others.
    """
    piece_rows = materialise(piece_rows.withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    kind = piece_rows.schema["doc_id"].dataType.simpleString()
    schema = f"_row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, _done boolean"
    packed: list[DataFrame] = []
    pool = piece_rows
    for step in range(rounds):
        tokens = pool.agg(F.sum("length")).first()[0] or 0
        parts = max(1, -(-tokens // part_tokens))
        last = step == rounds - 1 or parts == 1
        dealt = pool.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(step)), F.lit(parts)))
        out = materialise(dealt.groupBy("_part").applyInArrow(_pack_part(capacity, last, step), schema), "pack-round")
        packed.append(out.filter("_done").drop("_done", "_row"))
        if last:
            break
        pool = out.filter("not _done").select("_row", "doc_id", "piece", "start", "length", "ids_crc32")
    result = packed[0]
    for more in packed[1:]:
        result = result.unionByName(more)
    return result


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for all of ``docs``."""
    return pack(pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), capacity, part_tokens)
