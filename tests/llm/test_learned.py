"""Language and toxicity: held-out accuracy, the maths against plain versions, odd rows."""

import numpy as np

from tessera.llm import language, toxicity
from tessera.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in language.identify_corpus(docs).collect()}
    held = [(r.lang, rows[r.doc_id].lang_pred) for r in docs.select("doc_id", "lang").collect() if rows[r.doc_id].held_out]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_bundle_is_the_sum_of_bound_trigrams():
    letters, table_ = language.letter_vectors(), language.symbol_table()
    texts = ["Abca!", None, "  x\n", "é--b", "12 34"]
    want = []
    for text in texts:
        symbols = [0]
        for c in (text or "").lower():
            s = int(table_[ord(c)])
            if s or symbols[-1]:
                symbols.append(s)
        if symbols[-1]:
            symbols.append(0)
        v = np.zeros(language.DIMENSIONS)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            if b:
                v += np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c]
        want.append(v)
    assert np.allclose(language.bundles(texts), np.array(want), atol=1e-3)


def test_language_odd_rows(spark):
    rows = [(k, "the cat and the dog of the house", "en") for k in range(12)] + [(20 + k, "der hund und die katze in dem haus", "de") for k in range(12)]
    odd = [(50, None, "en"), (51, "", "de"), (52, "123 !!!", "en"), (53, "the dog", None), (54, "the " * 60000, "en"), (None, "und die", "de"), (53, "the dog", None)]
    frame = spark.createDataFrame([(*r, 0.5, "x") for r in rows + odd], "doc_id long, text string, lang string, score double, lang_pred string")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in language.identify_corpus(frame).collect()), key=str)
    by_id = {g[0]: g for g in got}
    assert len(got) == len(rows) + len(odd)
    assert [by_id[k][1:] for k in (50, 51, 52)] == [("und", 0.0)] * 3
    assert by_id[53][1] == by_id[54][1] == "en" and by_id[None][1] == "de"
    assert all(g[1] == ("en" if g[0] < 12 else "de") for g in got if g[0] is not None and g[0] < 40)
    unlabelled = frame.withColumn("lang", frame["lang"].cast("string")).filter("doc_id = 53").drop("lang_pred")
    assert {r.lang_pred for r in language.identify_corpus(unlabelled).collect()} == {"und"}
    assert language.identify_corpus(frame.limit(0)).count() == 0
    kept = language.identify(frame, language.learn(frame))
    assert kept.columns == [*frame.columns, "lang_pred", "lang_score"]


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF.replace("0.01", "0.1"), "documents"), table(spark, SF.replace("0.01", "0.1"), "labels")
    scored = toxicity.score_corpus(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    toxic = [r for r in scored if r.toxic == 1]
    caught = [r for r in scored if r.predicted == 1]
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic)          # some labels are noise
    assert sum(r.toxic for r in caught) >= 0.9 * len(caught)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)


def test_the_machine_learns_pairs():
    """Toxic only if an insult and a group mention meet: no sum of weights can tell that from either alone twice."""
    rng = np.random.default_rng(1)
    present = rng.integers(0, 2, (3000, 4)).astype(np.float32)
    label = (present[:, 0] == present[:, 1]).astype(np.float64)
    machine = toxicity.Machine(np.arange(4, dtype=np.uint64), np.arange(4), *toxicity.fit([np.flatnonzero(r) for r in present], label, 4, steps=1500))
    owner, feature = np.nonzero(present)
    got = machine.scores(owner, feature, np.ones(len(owner)), len(present))
    assert ((got >= 0.5) == label).mean() > 0.95
    x = present.astype(np.float64)
    pairs = np.array([sum(machine.vectors[a] @ machine.vectors[b] * r[a] * r[b] for a in range(4) for b in range(a)) for r in x[:50]])
    plain = 1 / (1 + np.exp(-(machine.bias + x[:50] @ machine.weights + pairs)))
    assert np.allclose(plain, got[:50])


def test_terms_are_words_and_beginnings():
    owner, term = toxicity.hashed_terms(["Abcdefg abc!", None, "abcd"])
    first, last = set(term[owner == 0].tolist()), set(term[owner == 2].tolist())
    assert len(first) == 6 and len(term[owner == 0]) == 6 and not (owner == 1).any()
    assert len(last) == 2 and len(first & last) == 1          # the beginning abc


def test_telling_features_are_those_of_a_plain_count(spark):
    rng = np.random.default_rng(3)
    words = ["w" + "".join(chr(97 + int(d)) for d in f"{k:02d}") for k in range(60)] + ["idiotic", "moron"]
    rows = []
    for k in range(400):
        label = int(k % 10 == 0)
        text = " ".join(rng.choice(words[:60], 6)) + (" idiotic" if label and k % 20 == 0 else "") + (" moron" if k < 40 and label else "")
        rows.append((label, f"{text} {'z' * (k % 7)}", int(rng.integers(-2**62, 2**62))))
    got = toxicity.telling_features(spark.createDataFrame(rows, "label int, text string, mark long")).collect()

    having: dict[int, set] = {}
    for k, (_, text, _) in enumerate(rows):
        for term in set(toxicity.hashed_terms([text])[1].tolist()):
            having.setdefault(term, set()).add(k)
    features: dict[frozenset, list] = {}
    for term, own in having.items():
        if len(own) >= 2:
            features.setdefault(frozenset(own), []).append(term)
    p = sum(r[0] for r in rows) / len(rows)

    def gain(own):
        n, a = len(own), sum(rows[k][0] for k in own)
        return sum(k * np.log(k / (n * q)) for k, q in ((a, p), (n - a, 1 - p)) if k)

    want = sorted(sorted(t) for own, t in features.items() if gain(own) >= np.log(len(features)))
    assert sorted(r.terms for r in got) == want and len(want) >= 2
    idiotic = sorted(toxicity.hashed_terms(["idiotic"])[1].tolist())
    assert idiotic in want                       # a word and its beginnings are one feature

    finder = toxicity.TermFinder(np.array(idiotic, np.uint64), np.zeros(len(idiotic), np.int64))
    owner, feature, value = finder(["idiotic", None, "idiot idiot", "sir"])
    assert owner.tolist() == [0, 2] and feature.tolist() == [0, 0]
    assert np.allclose(value, [1, 2 / 5])        # the beginnings idi and idio, of five terms


def test_copies_are_learned_from_once(spark):
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + int(d)) for d in f"{k:04d}") for k in range(3000)]
    rows, groups = [], []
    for group in range(60):
        text = list(rng.choice(words, 200))
        for copy in range(5 if group < 20 else 1):
            rows.append((int(group % 2 and copy < 4), " ".join(text[:150 + copy] + text[150:])))
            groups.append(group)
    frame = spark.createDataFrame([(label, text, 31 * k + 7) for k, (label, text) in enumerate(rows)] + [(0, "", 3), (0, "one", 4)], "label int, text string, mark long")
    kept = {r.mark for r in toxicity.without_copies(frame).collect()}
    assert kept >= {3, 4}
    left = [(groups[k], rows[k][0]) for k in range(len(rows)) if 31 * k + 7 in kept]
    want = {(group, label) for group, (label, _) in zip(groups, rows)}
    assert set(left) == want and len(left) <= len(want) + 4          # one of each label stays; near copies go


def test_no_feature_is_left_out_for_its_rank(spark):
    """Six hundred insults in six toxic texts each: all are used."""
    insults = ["".join(chr(97 + int(d)) for d in f"{k:03d}") + "o" for k in range(600)]
    rows = [(1, f"you {insults[k % 600]} go") for k in range(3600)] + [(0, f"you sir go {'on' if k % 2 else 'off'}") for k in range(12000)]
    frame = spark.createDataFrame([(label, text, 104729 * k) for k, (label, text) in enumerate(rows)], "label int, text string, mark long")
    kept = {t for r in toxicity.telling_features(frame).collect() for t in r.terms}
    assert all(set(toxicity.hashed_terms([word])[1].tolist()) & kept for word in insults)


def test_toxicity_odd_rows(spark):
    rows = [(k, f"you idiot go away {k}" if k % 3 == 0 else f"have a good day sir {k}", int(k % 3 == 0)) for k in range(90)]
    odd = [(200, None, 1), (201, "", 0), (202, "good idiot day", None), (203, "nice " * 50000, 0), (None, "idiot", 1), (3, "you idiot go away 3", 1)]
    docs = spark.createDataFrame([(i, t, 1.0, "x") for i, t, _ in rows + odd], "doc_id long, text string, toxic_score double, label string")
    labels = spark.createDataFrame([(i, x, 9) for i, _, x in rows + odd] + [(999, 1, 9), (5, 0, 9)], "doc_id long, toxic int, text int")
    got = toxicity.score_corpus(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert by_id[200].score == by_id[201].score and 0 <= by_id[200].score <= 1
    assert all(by_id[i].predicted == x for i, _, x in rows)
    nothing = toxicity.score_corpus(docs, labels.limit(0)).collect()
    assert {round(r.score, 6) for r in nothing} == {0.05}
    assert toxicity.score_corpus(docs.limit(0), labels).count() == 0


def test_language_memory_is_bounded_on_short_texts():
    import tracemalloc
    import pyarrow as pa
    rng = np.random.default_rng(0)
    texts = pa.array(["".join(chr(97 + c) for c in row) for row in rng.integers(0, 26, (5000, 50))])
    runs = language.text_slices(texts)
    assert [a for a, _ in runs[1:]] == [b for _, b in runs[:-1]] and max(b - a for a, b in runs) <= language.SLICE_ROWS
    tracemalloc.start()
    for at, to in runs[:3]:
        language.bundles(texts.slice(at, to - at).to_pylist())
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_language_names_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en", 5, "x"), (2, "12", "en", 6, "y")], "doc_id long, text string, lang string, lang_pred int, told string")
    learned = language.learn(docs)
    assert [tuple(r) for r in language.determinable(docs, learned).collect()] == [(1, "the cat and the dog", "en", 5, "x")]
    told = language.identify(docs, learned, names=("a", "b"))
    assert told.columns == [*docs.columns, "a", "b"] and [r.a for r in told.orderBy("doc_id").collect()] == ["en", "und"]
    assert language.identify(docs, learned).columns == [*docs.columns, "lang_pred", "lang_score"]
