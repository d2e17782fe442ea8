"""Removal of repeated byte strings by a deep-shallow suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a
document with a smaller id, or earlier in the same one). Strings of that length
are the suffixes cut to ``length`` bytes; equal ones have to be found, and the first of
each.

Not all suffixes are sorted together. A suffix belongs to the anchor that its
first ``length`` bytes name by content alone: the leftmost of its ``GRAM``-byte strings with the
smallest hash. Equal suffixes have equal anchors at the same place, and
neighbouring suffixes mostly share one, so a run of suffixes travels as one short string. Anchors
that occur once in the corpus settle their suffixes without any sort. The runs
of the others are dealt by anchor and sorted there: a multikey quicksort, whose
characters are eight bytes, goes down to ``SHALLOW`` bytes, and blind tries order the groups that
still agree. An anchor with very many occurrences (a line in a third of all
documents) is not given to one task: its suffixes are dealt one by one, each
distinct one reduced to its first occurrence before the shuffle.

Handling of odd rows: null text is empty; texts shorter than ``length`` lose
nothing; rows with equal id and text are one document, listed as often as they occur; rows
that share an id with different texts are ordered by a hash of the text; null ids
come last, ordered likewise; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_column, materialise, mix64, powers, random_words, release, release_when_idle, slices

LENGTH = 100

#: Bytes of the strings that anchors are chosen by.
GRAM = 32

#: Depth of the multikey quicksort, in bytes.
SHALLOW = 24

#: Occurrences of an anchor up to which its runs are sorted in one task.
HOT = 4096

#: Bytes of runs that a sorting task works on at once.
CHUNK_BYTES = 1 << 21

#: Bytes of distinct runs that a task holds before it sends them on.
HELD_BYTES = 1 << 23

#: Suffixes whose anchors are looked for at once.
SEGMENT = 1 << 18

#: Suffixes of which blind tries are built at once; a group is never cut.
TRIE_ROWS = 1 << 15

_POSITION_BITS = 24
_BYTES = random_words(404, 256)
_NULL_ID = (1 << 63) - 1


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring suffixes with one anchor: first suffix, last suffix, key of the anchor.

    Suffixes are places in ``raw`` at which ``length`` bytes of one text begin.
    """
    n = len(raw)
    gram = min(GRAM, length)
    window = length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[raw] * power[:n], out=total[1:])
    grams = mix64((total[gram:] - total[:-gram]) * inverse[:n - gram + 1])
    low = np.uint64((1 << _POSITION_BITS) - 1)
    order = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)     # ties to the left
    step, least = 1, order
    while 2 * step <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:
        least = np.minimum(least[:len(least) - (window - step)], least[window - step:])
    at = (least & low).astype(np.int64)
    sizes = np.diff(bounds)
    whole = np.repeat(bounds[1:], sizes)                                # end of the text that each byte is in
    inside = np.flatnonzero(np.arange(len(at)) + length <= whole[:len(at)])
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchor = at[inside]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    last = np.concatenate([first[1:], [len(inside)]]) - 1
    return inside[first], inside[last], grams[anchor[first]]


def _runs(raw: np.ndarray, bounds: np.ndarray, length: int):
    """(text, first suffix, last suffix, key) of all texts, suffixes counted from the text's start."""
    for at, to in slices(bounds, SEGMENT):
        base = bounds[at]
        if to == at + 1 and bounds[to] - base > 4 * SEGMENT:
            # one very long text: suffix ranges that overlap by a string's length
            for start in range(0, int(bounds[to] - base), SEGMENT):
                part = raw[base + start:min(base + start + SEGMENT + length - 1, bounds[to])]
                a, b, key = anchors(part, np.array([0, len(part)]), length)
                yield np.full(len(a), at), a + start, b + start, key
            continue
        a, b, key = anchors(raw[base:bounds[to]], bounds[at:to + 1] - base, length)
        text = np.searchsorted(bounds[at:to + 1] - base, a, "right") - 1
        start = bounds[at + text] - base
        yield text + at, a - start, b - start, key


def _count_anchors(length: int):
    def run(batch: pa.RecordBatch):
        for _, _, _, key in _runs(*binary_column(batch.column(2)), length):
            seen, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n)], ["key", "n"])
    return run


def _list_anchors(length: int):
    def run(batch: pa.RecordBatch):
        for text, a, b, key in _runs(*binary_column(batch.column(2)), length):
            rows = pa.array(text)
            # a run is at most length - GRAM + 1 suffixes long: its place and size share a long
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                                              pa.array((a << 10) | (b - a))], ["key", "doc", "tie", "run"])
    return run


def _unpack(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bounds, first suffix, size, key and hot flag of a column of runs."""
    bounds = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values
    run = flat.field("run").to_numpy(zero_copy_only=False)
    key = flat.field("key").to_numpy(zero_copy_only=False)
    hot = flat.field("hot").to_numpy(zero_copy_only=False).astype(bool)
    return bounds, run >> 10, (run & 1023) + 1, key, hot


def _strings(length: int):
    """Runs of texts as strings, each distinct one of a batch once, at its first place. Runs of
    hot anchors give their suffixes one by one."""
    def run(batch: pa.RecordBatch):
        docs, ties = (batch.column(k).to_numpy() for k in ("doc", "tie"))
        raw, bounds = binary_column(batch.column("text"))
        data = raw.tobytes()
        lists, first, size, key, hot = _unpack(batch.column("runs"))
        seen: dict[tuple[int, bytes], tuple] = {}

        def out():
            keys, places = list(seen), list(seen.values())
            seen.clear()
            doc, tie, start, number = (np.array(x, np.int64) for x in zip(*places, strict=True))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([s for _, s in keys], pa.binary()),
                                               pa.array(doc), pa.array(tie), pa.array(start.astype(np.int32)), pa.array(number.astype(np.int32))],
                                              ["key", "string", "doc", "tie", "start", "number"])

        held = 0
        for row in np.lexsort((ties, docs)).tolist():
            doc, tie, at = int(docs[row]), int(ties[row]), int(bounds[row])
            a, b = lists[row], lists[row + 1]
            order = np.argsort(first[a:b], kind="stable") + a
            for start, number, name, many in zip(first[order].tolist(), size[order].tolist(), key[order].tolist(), hot[order].tolist(), strict=True):
                if many:
                    for s in range(start, start + number):
                        seen.setdefault((0, data[at + s:at + s + length]), (doc, tie, s, 0))
                    held += number * length
                else:
                    seen.setdefault((name, data[at + start:at + start + number + length - 1]), (doc, tie, start, number))
                    held += number + length
            if held > HELD_BYTES:
                yield out()
                held = 0
        if seen:
            yield out()
    return run


def blind_tries(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """New group numbers, ascending in string order, that are equal only for equal rows of one old group.

    ``rows``: strings as rows of bytes; ``group``: ascending numbers. Builds a blind trie for every
    group at once, a branching level at a time: a group branches at the first
    byte in which any of its rows differs from its first row; bytes between
    branches are never ordered by.
    """
    n, depth = rows.shape
    place = np.arange(n)
    done = np.zeros(n, np.int64)
    finished: list[np.ndarray] = []
    path = [group.copy()]
    while len(place):
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        number = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]).astype(np.int64))
        differs = rows[place] != rows[place[starts]][number]
        where = np.where(differs.any(1), differs.argmax(1), depth)
        branch = np.minimum.reduceat(where, starts)[number]
        leaf = branch == depth
        finished.append(place[leaf])
        byte = np.where(leaf, 0, rows[place, np.minimum(branch, depth - 1)])
        level = np.full(n, -1, np.int64)
        level[place] = byte
        path.append(level)
        order = np.lexsort((byte[~leaf], number[~leaf]))
        place = place[~leaf][order]
        group = (number[~leaf][order] << 8) | byte[~leaf][order]
    order = np.lexsort(path[::-1])
    keys = np.stack(path, 1)[order]
    done[order] = np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).any(1)]))
    return done


def deep_shallow(data: np.ndarray, suffixes: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for suffixes of one group that agree in their first ``length`` bytes.

    ``data`` needs eight spare bytes at its end.
    """
    words, strings = sliding_window_view(data, 8), sliding_window_view(data, length)      # views: only what is picked is copied
    out = np.zeros(len(suffixes), np.int64)
    place, next_number, depth = np.arange(len(suffixes)), 0, 0
    order = np.argsort(group, kind="stable")
    place, group = place[order], group[order]

    def settle(rows: np.ndarray, numbers: np.ndarray):
        nonlocal next_number
        out[rows] = numbers + next_number
        next_number += int(numbers.max(initial=-1)) + 1

    while depth < min(SHALLOW, length - 8):
        # multikey quicksort, all groups at once: order by the next eight bytes, keep those that agree
        character = words[suffixes[place] + depth].view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((character, group))
        place, group, character = place[order], group[order], character[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (character[1:] != character[:-1])])
        group = np.cumsum(new) - 1
        count = np.bincount(group) if len(group) else np.zeros(0, np.int64)
        alone = count[group] == 1
        settle(place[alone], np.arange(int(alone.sum())))
        place, group = place[~alone], group[~alone]
        depth += 8
        if not len(place):
            return out
    for part in _group_parts(group, TRIE_ROWS):
        settle(place[part], blind_tries(strings[suffixes[place[part]]][:, depth:], group[part]))
    return out


def _group_parts(group: np.ndarray, size: int):
    """Slices of about ``size`` rows that do not cut a group (``group`` ascends)."""
    at = 0
    while at < len(group):
        to = min(at + size, len(group))
        if to < len(group):
            edge = int(np.searchsorted(group, group[to - 1], "left"))
            to = edge if edge > at else int(np.searchsorted(group, group[to - 1], "right"))
        yield slice(at, to)
        at = to


def _first_suffixes(length: int):
    """Of runs dealt and sorted by anchor: the suffixes that no equal one precedes, as ranges."""
    def solve(rows: pa.Table):
        key, doc, tie, start = (rows[c].to_numpy() for c in ("key", "doc", "tie", "start"))
        order = np.lexsort((start, tie, doc, key))           # earlier rows of an anchor come first
        # whole runs that are equal need no sort: all suffixes of the later ones are repeats
        seen: set[tuple[int, bytes]] = set()
        keys, strings = key.tolist(), rows["string"].to_pylist()
        first = []
        for k in order.tolist():
            size = len(seen)
            seen.add((keys[k], strings[k]))
            if len(seen) > size:
                first.append(k)
        del seen, strings
        rows = rows.take(pa.array(first))
        key, doc, tie = (rows[c].to_numpy() for c in ("key", "doc", "tie"))
        start, number = (rows[c].to_numpy().astype(np.int64) for c in ("start", "number"))
        raw, bounds = binary_column(rows["string"])
        rank = np.arange(len(key))
        _, group = np.unique(key, return_inverse=True)
        size = np.bincount(group)[group]
        new = np.ones(int(number.sum()), bool)
        owner = np.repeat(np.arange(len(key)), number)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        several = np.flatnonzero(size[owner] > 1)
        if len(several):
            data = np.concatenate([raw, np.zeros(8, np.uint8)])
            same = deep_shallow(data, (bounds[:-1][owner] + offset)[several], group[owner][several], length)
            by_rank = np.lexsort((rank[owner[several]], same))
            first = np.concatenate([[True], same[by_rank][1:] != same[by_rank][:-1]])
            new[several] = False
            new[several[by_rank[first]]] = True
        at = np.flatnonzero(new)
        if not len(at):
            return None
        begin = np.concatenate([[True], (owner[at][1:] != owner[at][:-1]) | (at[1:] != at[:-1] + 1)])
        begin = np.flatnonzero(begin)
        stop = np.concatenate([begin[1:], [len(at)]]) - 1
        which = owner[at[begin]]
        s = start[which] + offset[at[begin]]
        return pa.RecordBatch.from_arrays([pa.array(doc[which]), pa.array(tie[which]), pa.array((s << 10) | (at[stop] - at[begin]))], ["doc", "tie", "run"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < CHUNK_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            key = rows["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1], "left"))       # the last anchor may go on
            if whole:
                out = solve(rows.slice(0, whole).combine_chunks())
                if out is not None:
                    yield out
            held = rows.slice(whole).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
        if held and sum(b.num_rows for b in held):
            out = solve(pa.Table.from_batches(held).combine_chunks())
            if out is not None:
                yield out
        release()
        release_when_idle()
    return run


def covered(n: int, runs: tuple[np.ndarray, np.ndarray], firsts: tuple[np.ndarray, np.ndarray], length: int) -> np.ndarray:
    """Which of a text's ``n`` bytes go: those of suffixes in ``runs`` (start, size) but not in ``firsts``."""
    repeated = np.zeros(n + 1, np.int8)
    for (start, size), value in ((runs, 1), (firsts, 0)):
        if len(start):
            at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            repeated[at] = value
    at = np.flatnonzero(repeated)
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + length, -1)
    return np.cumsum(edges[:n]) > 0


def _apply(length: int, finish):
    """``finish(bytes, mask)`` of every document of a batch, with the bytes that go."""
    def run(batch: pa.RecordBatch) -> list:
        raw, bounds = binary_column(batch.column("text"))
        lists, first, size, _, _ = _unpack(batch.column("runs"))
        f = batch.column("firsts")
        f_bounds, f_run = np.asarray(f.offsets).astype(np.int64), f.values.to_numpy(zero_copy_only=False)
        out = []
        for k in range(batch.num_rows):
            text = raw[bounds[k]:bounds[k + 1]]
            a, b, c, d = lists[k], lists[k + 1], f_bounds[k], f_bounds[k + 1]
            mask = covered(len(text), (first[a:b], size[a:b]), (f_run[c:d] >> 10, (f_run[c:d] & 1023) + 1), length) if b > a else np.zeros(len(text), bool)
            out.append(finish(text, mask))
        return out
    return run


def _documents(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, other) as doc, tie, text, other: a document is told apart by (doc, tie).

    The tie is 0, or a hash of the text where rows share an id.
    """
    named = rows.select(F.coalesce(F.col("id").cast("long"), F.lit(_NULL_ID)).alias("doc"), "text", "other")
    repeated = materialise(named.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc"), "suffix-repeated-ids")
    if not repeated.limit(1).count():
        return named.select("doc", F.lit(0).cast("long").alias("tie"), "text", "other")
    marked = named.join(repeated.withColumn("again", F.lit(True)), "doc", "left")
    return materialise(marked.select("doc", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0)).alias("tie"), "text", "other"), "suffix-documents")


def _with_runs(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` (doc, tie, text, other) with their runs of repeated anchors, and of those the
    suffixes that are first occurrences.

    Texts are shuffled once, by document; that exchange serves the two joins.
    """
    counted = arrow_map(docs.select("doc", "tie", "text"), _count_anchors(length), "key long, n long") \
        .groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    counted = materialise(counted, "suffix-anchors")      # a plain table: the join below can be split where an anchor is hot
    listed = arrow_map(docs.select("doc", "tie", "text"), _list_anchors(length), "key long, doc long, tie long, run long")
    entry = F.struct("run", "key", (F.col("n") > HOT).alias("hot"))
    runs = materialise(listed.join(counted, "key").groupBy("doc", "tie").agg(F.collect_set(entry).alias("runs")), "suffix-runs")
    texts = docs.join(runs, ["doc", "tie"], "left") \
        .select("doc", "tie", "text", "other", F.coalesce("runs", F.array().cast(runs.schema["runs"].dataType)).alias("runs"))
    strings = arrow_map(texts, _strings(length), "key long, string binary, doc long, tie long, start int, number int")
    cold = strings.filter("number > 0").repartition("key").sortWithinPartitions("key") \
        .mapInArrow(_first_suffixes(length), "doc long, tie long, run long")
    hot = strings.filter("number = 0").groupBy("string").agg(F.min(F.struct("doc", "tie", "start")).alias("f")) \
        .select("f.doc", "f.tie", F.shiftleft(F.col("f.start").cast("long"), 10).alias("run"))
    firsts = cold.unionByName(hot).groupBy("doc", "tie").agg(F.collect_set("run").alias("firsts"))
    return texts.join(firsts, ["doc", "tie"], "left") \
        .select("doc", "tie", "text", "other", "runs", F.coalesce("firsts", F.array().cast("array<long>")).alias("firsts"))


def repeated_bytes(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``."""
    def digest(text: np.ndarray, mask: np.ndarray):
        spans = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
        return len(text), int(mask.sum()), spans, hashlib.sha256(text[~mask].tobytes()).hexdigest()

    work = _apply(length, digest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, spans, sha = zip(*work(batch), strict=True)
        return pa.RecordBatch.from_arrays([batch.column("other"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                           pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                                          ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("other"))
    return materialise(arrow_map(_with_runs(_documents(rows), length), run,
                                 "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "suffix-digests")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, their texts without the characters whose bytes all go. Null texts stay null."""
    def keep(text: np.ndarray, mask: np.ndarray) -> bytes:
        if not mask.any():
            return text.tobytes()
        start = np.flatnonzero((text & 0xC0) != 0x80)
        whole = np.logical_and.reduceat(mask, start)
        return text[~np.repeat(whole, np.diff(np.append(start, len(text))))].tobytes()

    work = _apply(length, keep)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("other"), pa.array(work(batch), pa.binary()).cast(pa.string())], ["other", "text"])

    # positional names inside, so that no column of the input can clash
    names = [f"c{k}" for k in range(len(docs.columns))]
    numbered = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in (id_col, text_col)}
    others = [F.col(n) for n in names if n != at[text_col]]
    rows = numbered.select(F.col(at[id_col]).alias("id"), F.col(at[text_col]).alias("text"),
                           F.struct(*others, F.col(at[text_col]).isNull().alias("null")).alias("other"))
    kind = rows.schema["other"].dataType.simpleString()
    kept = arrow_map(_with_runs(_documents(rows), length), run, f"other {kind}, text string")
    text = F.when(~F.col("other.null"), F.col("text"))
    return kept.select(*[(text if n == at[text_col] else F.col(f"other.{n}")).alias(c) for n, c in zip(names, docs.columns, strict=True)])
