"""The Merkle manifest against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.merkle import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    keys = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[k] = levels([leaf(r) for r in groups[k]])
    top = levels([built[k][-1][0] for k in keys])
    out = []
    for place, k in enumerate(keys):
        for at, row in enumerate(groups[k]):
            folded, proof = leaf(row, int(tampered(row[0]))), ""
            for path, i in ((built[k], at), (top, place)):
                for level in path[:-1]:
                    beside = level[i ^ 1] if i ^ 1 < len(level) else ""
                    folded = h(beside, folded) if i % 2 else h(folded, beside)
                    proof, i = proof + beside, i // 2
            out.append((row[0], leaf(row), built[k][-1][0], top[-1][0], h(proof), folded, folded == top[-1][0]))
    return out


def run(spark, rows, stride, tmp_path):
    hit = F.coalesce(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(7)) == 0, F.lit(False))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"digest": F.lit("x"), "node": F.lit(1), "idx": F.lit(2), "file": F.lit("f")})
    df.repartition(3).write.parquet(str(tmp_path / "docs"))
    return [tuple(r) for r in manifest(spark.read.parquet(str(tmp_path / "docs")), tampered=hit, stride=stride).collect()]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("stride", [1, 2, 8])
def test_against_plain(spark, tmp_path, stride):
    rows = [(k, f"text {k} é", ("en", "de", None, "fr")[k % 7 % 4], None if k % 5 == 0 else "web", k * 3) for k in range(23)]
    rows += [(None, None, "en", None, None), (None, "", "en", "", 0), (7, "again", "en", "web", None), (7, "again", "en", "web", None),
             (49, "only one of its language", "zz/1", "s", 2 ** 40), (50, "x" * 300_000, "", "s", 1)]
    got = run(spark, rows, stride, tmp_path)
    assert order(got) == order(plain(rows))
    assert {r[-1] for r in got} == {True, False}


def test_one_empty_and_hot(spark, tmp_path):
    assert run(spark, [], 8, tmp_path / "a") == []
    one = [(0, "a", "en", "s", 1)]
    assert run(spark, one, 8, tmp_path / "b") == plain(one)
    hot = [(None, "", None, None, 0)] * 300 + [(k, "t", None, None, 0) for k in range(300)]
    assert order(run(spark, hot, 3, tmp_path / "c")) == order(plain(hot))
