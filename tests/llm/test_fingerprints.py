"""Fingerprints: edited texts against a plain version, likeness against the generalised Jaccard similarity."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tessera.llm.fingerprints import edited_fingerprints, fingerprints

SCHEMA = "doc_id long, text string, lang string"


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit(1), "key": F.lit("k"), "at": F.lit(0), "place": F.lit(2)}) \
        .repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def words(text):
    return Counter(w for w in re.split("[\x20\t\n\x0b\x0c\r]+", text.lower()) if w)


def jaccard(a, b):
    a, b = words(a), words(b)
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def edited(rows):
    """doc_id -> (text, edited, next) of rows with distinct ids."""
    order = sorted(((i, t or "") for i, t, _ in rows), key=lambda x: -x[0])
    out = {}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        out[i] = text, text[:len(text) - cut] + after[:cut], after
    return out


def make(n, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(rng.choice(list("abcdefghié"), 6)) for _ in range(3000)]
    return [(k, " ".join(rng.choice(vocabulary, rng.integers(60, 200))), "en") for k in range(n)]


def test_edited_texts_and_likeness(spark, tmp_path):
    rows = make(120) + [(500, None, "x"), (501, "", "x"), (502, "𝔘nicode ✓ é" * 7, None), (503, " \t", "x"), (504, "aa bb aa", "y"), (505, "AA  aa bb", "y")]
    out = {r.doc_id: r for r in edited_fingerprints(write(spark, rows, tmp_path / "d"), samples=256).collect()}
    plain = edited(rows)
    assert out.keys() == plain.keys()
    off_edited, off_next = [], []
    for i, (text, changed, after) in plain.items():
        r = out[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 1024 and 0 <= r.near_next <= 1
        off_edited.append(r.near_edited - jaccard(text, changed))
        off_next.append(r.near_next - jaccard(text, after))
        if words(text) == words(changed):
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
    # 256 samples: a standard error of at most 0.032 each
    assert max(map(abs, off_edited + off_next)) < 0.14 and abs(np.mean(off_edited)) < 0.01 and abs(np.mean(off_next)) < 0.01
    assert out[504].fingerprint == out[505].fingerprint != out[502].fingerprint
    assert out[500].fingerprint == out[501].fingerprint == "0" * 1024


def test_one_interface_agrees_with_the_other(spark, tmp_path):
    docs = write(spark, make(30) + [(None, "the same", "x"), (None, "the same", "x"), (3, "twice the id", "x"), (70, "a" * 200_000, "x")], tmp_path / "d")
    one = sorted((r.doc_id is not None, r.doc_id or 0, r.fingerprint) for r in fingerprints(docs).collect())
    two = sorted((r.doc_id is not None, r.doc_id or 0, r.fingerprint) for r in edited_fingerprints(docs).collect())
    assert one == two and len(one) == 34


def test_next_runs_across_ranges_and_around(spark, tmp_path, monkeypatch):
    rows = make(40, seed=5) + [(None, "last in order", "x")] * 20
    got = []
    for most in (1, 7, 1024):
        monkeypatch.setattr("tessera.llm.fingerprints.MIN_RANGES", most)
        monkeypatch.setattr("tessera.llm.fingerprints.RANGE_ROWS", 10 ** 9)
        got.append(sorted(map(repr, edited_fingerprints(write(spark, rows, tmp_path / str(most))).collect())))
    assert got[0] == got[1] == got[2] and len(got[0]) == 60


def test_small_tables(spark, tmp_path):
    assert edited_fingerprints(write(spark, [], tmp_path / "a")).collect() == []
    one, = edited_fingerprints(write(spark, [(5, "one two three four", "x")], tmp_path / "b")).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"one two threone tw").hexdigest()
