"""HyperMinHash near-duplicates against brute force on full shingle sets."""

import random
import re

import numpy as np
import pytest

from tessera.llm import near_dedup as nd
from tessera.llm.common import table
from tessera.llm.components import components


def brute_sets(rows, words):
    out = []
    for i, text in rows:
        w = [t for t in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if t]
        runs = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        out.append((i, frozenset(runs)))
    return out


def brute_components(rows, words, num=80, den=100):
    sets = brute_sets(rows, words)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by_run = {}
    for k, (_, s) in enumerate(sets):
        for r in s:
            by_run.setdefault(r, []).append(k)
    pairs = {(a, b) for ks in by_run.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        if den * len(x & y) >= num * len(x | y):
            root[find(b)] = find(a)
    groups = {}
    for k in range(len(sets)):
        groups.setdefault(find(k), []).append(k)
    comp = {}
    for members in groups.values():
        ids = [sets[k][0] for k in members if sets[k][0] is not None]
        for k in members:
            comp[k] = min(ids) if ids else None
    return sorted(((sets[k][0], len(sets[k][1]), comp[k]) for k in comp), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_against_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = nd.near_duplicates(docs, words=4)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute_components(rows, 4)


def test_odd_rows_chains_and_groups(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for k in range(40):                           # a chain: each step changes a few words of the one before
        base = base.copy()
        base[rng.randrange(120)] = f"x{k}"
        rows.append((1000 - k, " ".join(base)))
    rows += [(1, None), (2, ""), (3, " \t\n "), (4, "One"), (5, "one"), (6, "a b c"), (7, "A  b\tC"), (8, "a b c"),
             (8, "a b c"), (9, "a b d"), (None, rows[3][1]), (None, "lonely words that nobody else has here"),
             (10, "é" * 3), (11, "É" * 3), (12, "same id first text here now"), (12, "same id second text is else"),
             (13, " ".join(f"long{k}" for k in range(30000)))]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, class int")
    got = nd.near_duplicates(frame, words=4)
    assert result(got) == brute_components(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())
    kept = nd.drop_near_duplicates(frame.filter("doc_id > 3 and doc_id < 10"), words=5)
    assert kept.columns == ["doc_id", "text", "n", "class"]
    assert sorted(r.doc_id for r in kept.collect()) == [4, 6, 9]
    assert nd.near_duplicates(frame.limit(0), words=4).count() == 0


def test_one_row_of_each_component_stays(spark):
    story, other = " ".join(f"w{k}" for k in range(100)), " ".join(f"v{k}" for k in range(100))
    lone = " ".join(f"u{k}" for k in range(100))
    rows = [(None, story), (None, story + " end"), (None, story)]                      # null ids alone
    rows += [(5, other), (5, other), (None, other), (9, other + " end")]               # repeated, null and larger ids
    rows += [(7, lone), (7, "this id has a second text of its own"), (7, other)]       # one id in three components
    rows += [(8, ""), (8, ""), (8, None), (None, ""), (None, ""), (10, " ")]           # empty sets
    frame = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, file int, _place string")
    kept = nd.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    stories = [g for g in got if g[0] is None and g[1]]
    assert len(stories) == 1 and stories[0] in rows[:3]
    want = [*stories, (5, other), (7, lone), (7, "this id has a second text of its own"), (8, ""), (8, None), (None, ""), (10, " ")]
    assert got == sorted(want, key=str)
    # a table that was read in twice
    twice = nd.drop_near_duplicates(frame.unionByName(frame).repartition(3))
    assert sorted(((r.doc_id, r.text) for r in twice.collect()), key=str) == got


def test_members_left_apart_by_the_first_round_are_joined(spark, monkeypatch):
    """Bucket mates that are no match for the smallest member are still compared with each other, in parts."""
    monkeypatch.setattr(nd, "PART_ROWS", 2)
    rng = random.Random(9)
    core = [f"c{k}" for k in range(100)]
    rows = []
    for k in range(6):                            # three pairs; pairs share half their words
        tail = [f"t{k // 2}_{j}" for j in range(60)]
        extra = [f"e{k}_{rng.random()}"]
        rows.append((k, " ".join(core + tail + extra)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4)
    assert result(got) == brute_components(rows, 4)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (20, 21), (22, 21), (30, 30), (None, 4)] + [(100 + k, 101 + k) for k in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 22: 20} | {100 + k: 100 for k in range(51)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_estimate_is_near_the_similarity(share):
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        union = rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        both = union[:int(1000 * share)]
        half = (1000 - len(both)) // 2
        a, b = np.unique(union[:len(both) + half]), np.unique(np.concatenate([both, union[len(both) + half:]]))
        got, _ = nd.estimated_jaccard(nd.registers([a]), nd.registers([b]))
        errors.append(got[0] - len(both) / 1000)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_a_register_follows_from_the_smallest_hash():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64))
    got = nd.registers([hashes])[0]
    for bucket in range(nd.BUCKETS):
        mine = [int(h) & ((1 << 57) - 1) for h in hashes if int(h) >> 57 == bucket]
        if not mine:
            assert got[bucket] == 0
            continue
        zeros = 57 - min(mine).bit_length()
        after = ((min(mine) << (zeros + 1)) & ((1 << 57) - 1)) >> 47
        assert got[bucket] == ((zeros + 1) << 10) | after


@pytest.mark.parametrize("size", [60, 400, 6000])
def test_wide_sketches_never_reject_similar_sets(size):
    rng = np.random.default_rng(size)
    kept = []
    for share in (0.8, 0.82, 0.9) * 60 + (0.6, 0.65) * 60:
        union = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        both = int(np.ceil(len(union) * share))
        half = both + (len(union) - both) // 2
        order = rng.permutation(len(union))
        a = np.sort(union[order[:half]])
        b = np.sort(union[np.concatenate([order[:both], order[half:]])])
        passed = nd.wide_passes(nd.wide_sketches([a]), nd.wide_sketches([b]), np.array([len(a)]), np.array([len(b)]), 0.8)[0]
        kept.append((share, passed))
    assert all(p for share, p in kept if share >= 0.8)
    assert sum(p for share, p in kept if share < 0.7) == 0
