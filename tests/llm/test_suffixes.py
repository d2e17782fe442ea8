"""Repeated byte strings against a plain pass over all strings, and the sort against sorted()."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffixes as sx
from tessera.llm.common import table, random_words


def brute(rows, length):
    seen, out = {}, {}
    last = 1 << 63
    order = sorted(set(rows), key=lambda r: (last if r[0] is None else r[0]))
    for i, text in order:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            part = data[s:s + length]
            if seen.setdefault(part, (i, text, s)) != (i, text, s):
                gone[s:s + length] = True
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[i, text] = (i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((out[r] for r in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sx.repeated_bytes(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result(got) == brute(rows, 100)


def odd_rows():
    rng = np.random.default_rng(2)
    text = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 700))
    return [(5, None), (6, ""), (7, text[:99]), (8, text[:100]), (9, text), (9, text), (10, "é" * 400), (11, text[300:450] + "é" * 90),
            (12, "ab" * 500), (4, "zz" + text[100:260] + "yy" + text[100:260]), (None, text[50:300]), (13, "x" + text[:600]),
            (14, text[:140] + "q" + text[141:])]


def test_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    frame = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, doc int, key string")
    want = brute(rows, 100)
    assert result(sx.repeated_bytes(frame)) == want
    monkeypatch.setattr(sx, "HOT", 1)                 # every repeated anchor by single suffixes
    assert result(sx.repeated_bytes(frame)) == want
    monkeypatch.setattr(sx, "HOT", 4096)
    monkeypatch.setattr(sx, "SEGMENT", 64)            # every text is a long one
    monkeypatch.setattr(sx, "CHUNK_BYTES", 300)       # groups go on in the next batch
    assert result(sx.repeated_bytes(frame)) == want
    kept = {r.doc_id: r for r in sx.remove_repeats(frame).collect()}
    assert kept[5].text is None and kept[6].text == "" and kept[8].doc == 1 and kept[8].key == "k"
    assert kept[9].text.encode() == odd_rows()[4][1].encode()[100:] or len(kept[9].text) < 700
    assert len(kept) == len({i for i, _ in rows})
    assert sx.repeated_bytes(frame.limit(0)).count() == 0 and sx.remove_repeats(frame.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    a, b = "".join(chr(97 + k % 23) + str(k) for k in range(80)), "".join(chr(65 + k % 19) + str(k) for k in range(90))
    rows = [(1, a), (1, b), (1, a), (2, a + b), (None, b + a)]
    got = result(sx.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert len(got) == 5
    assert [g[2] for g in got if g[0] == 1] == [0, 0, 0]
    # only the strings that span the seam are new
    assert all(g[2] == g[1] for g in got if g[0] == 2) or all(g[2] > g[1] - 200 for g in got if g[0] == 2)


words = st.lists(st.binary(min_size=0, max_size=40).map(lambda x: bytes(b % 3 + 97 for b in x)), min_size=1, max_size=12)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(words, st.integers(0, 3))
def test_deep_shallow_tells_equal_strings_apart(parts, groups):
    length = 40
    data = b"".join(p + b"x" * 45 for p in parts)
    places = [k for k in range(0, len(data) - length)]
    group = np.array([k % (groups + 1) for k in places])
    got = sx.deep_shallow(np.frombuffer(data + b"\0" * 8, np.uint8), np.array(places), group, length)
    names = {}
    for k, number in zip(places, got.tolist(), strict=True):
        assert names.setdefault((k % (groups + 1), data[k:k + length]), number) == number
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(min_size=5, max_size=5).map(lambda x: bytes(b % 3 for b in x))), min_size=1, max_size=30))
def test_blind_tries_order_groups(rows):
    rows = sorted(rows, key=lambda r: r[0])
    matrix = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, 5)
    got = sx.blind_tries(matrix, np.array([r[0] for r in rows]))
    ranked = sorted(set(rows))
    assert [ranked.index(r) for r in rows] == got.tolist()


@settings(max_examples=40, deadline=None, derandomize=True)
@given(st.binary(min_size=0, max_size=300).map(lambda x: bytes(b % 2 + 97 for b in x)), st.binary(min_size=0, max_size=50))
def test_equal_strings_have_equal_anchors(text, before):
    length = 50
    name = {}
    for part in (text, before + text):
        raw = np.frombuffer(part, np.uint8)
        first, last, key = sx.anchors(raw, np.array([0, len(raw)]), length)
        seen = []
        for a, b, k in zip(first.tolist(), last.tolist(), key.tolist(), strict=True):
            for s in range(a, b + 1):
                seen.append(s)
                assert name.setdefault(part[s:s + length], k) == k
        assert seen == list(range(max(0, len(raw) - length + 1)))


def test_random_words_are_fixed():
    assert random_words(1, 2).tolist() == random_words(1, 3)[:2].tolist()


def test_powers_of_a_long_text_go_when_the_worker_is_idle():
    import time
    from tessera.llm import common
    power, inverse = common.powers(100_000)
    assert len(power) == len(inverse) == 100_000 and (power * inverse == 1).all() and (power[1:2] * power[2:3] == power[3:4]).all()
    assert sum(x.nbytes for x in common._powers.values()) >= 1_600_000
    time.sleep(2.5)
    assert not common._powers
    again = common.powers(50)
    assert (again[0] == power[:50]).all() and (again[1] == inverse[:50]).all() and len(common.powers(0)[0]) == 0
