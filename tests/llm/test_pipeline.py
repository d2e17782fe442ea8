"""The corpus pipeline stage by stage against plain versions, and without its optional parts."""

import importlib.util
import unicodedata

import numpy as np
import pytest
from test_near_dedup import brute_components
from test_packing_mixing import check_mix, check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import mixing
from tessera.llm.common import materialise, table
from tessera.llm.queries import tokenizer_path


def without_repeats(rows, length=100):
    """(id, text) without the characters whose bytes an earlier string of ``length`` bytes covers."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(data[s:s + length])
        kept, at = [], 0
        for c in text or "":
            size = len(c.encode())
            if not gone[at:at + size].all():
                kept.append(c)
            at += size
        out[i] = None if text is None else "".join(kept)
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Documents of a small table with odd ones among them, and an extra column."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(120)
    rows = [tuple(r) + (7,) for r in docs.collect()]
    rows += [(9001, None, "en", "src1", 0, 1), (9002, "", "en", None, 0, 2), (9003, "12 34 !!", "de", "src2", 8, 3),
             (9004, "of the and to in is " * 4000, "en", "src3", 0, 4), (9005, rows[0][1], rows[0][2], "srcX", 5, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred int")


def test_stages(spark, odd):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "suffix_dedup", "mixing", "packing"]
    docs, before = materialise(odd, "test-docs"), None
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialise(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == odd.columns
        if name == "language":
            letters = {r.doc_id for r in before if any(unicodedata.category(c)[0] == "L" for c in r.text or "")}
            assert {r.doc_id for r in after} == letters and len(after) == len(letters)
        elif name == "near_dedup":
            comp = {i: c for i, _, c in brute_components([(r.doc_id, r.text) for r in before], 5)}
            assert {r.doc_id for r in after} == {i for i, c in comp.items() if i == c}
            assert 9005 not in {r.doc_id for r in after}
        elif name == "suffix_dedup":
            want = without_repeats([(r.doc_id, r.text) for r in before])
            assert {r.doc_id: r.text for r in after} == want
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "mixing":
            again = spark.createDataFrame([(r.doc_id, r.source, r.text) for r in before], "doc_id long, source string, text string")
            got = mixing.mix(again).collect()
            check_mix(got, [(r.doc_id, r.source, r.text) for r in before])
            copies = {r.doc_id: r.copies for r in got}
            for r in before:
                assert sum(a.doc_id == r.doc_id for a in after) == copies[r.doc_id]
        else:
            check_packing(after, [(r.doc_id, r.text) for r in before], Tokenizer.from_file(tokenizer_path()))


def test_run_and_empty_input(spark, sf_small, odd):
    rows = corpus_pipeline.run(spark, sf_small)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_small), "test-empty")
        assert docs.count() == 0


def test_the_entry_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("tessera.llm", "corpus_pipeline") else real(name, *a))
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(entry.queries()) > 120 and set(entry.oracle_sql()) <= set(entry.queries())
