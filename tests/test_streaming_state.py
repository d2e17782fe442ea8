"""State by key: compaction, replays, record-time order, and the never-forgetting key index."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from tessera.streaming.ingest import ingest_pages, latest_scored, score_stream
from tessera.streaming.keyed import KeyedTable, Staging


def table(spark, **more):
    return KeyedTable(spark, tempfile.mkdtemp(prefix="tessera-keyed-") + "/t", "k", ["k"], ["at"], buckets=4, **more)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k long, at long, v string")


def folders(t):
    return {(b, e, x) for b, ps in t._parts(None).items() for e, x in ps}


def test_keyed_table_merges_and_forgets_history(spark):
    t = table(spark, compact_every=3)
    assert t.current() is None
    want = {}
    for epoch in range(12):
        new = [(k, epoch if k % 5 else -epoch, f"{k}-{epoch}") for k in range(epoch % 2, 20, 2)] + [(None, epoch, str(epoch))]
        t.add(rows(spark, new), epoch)
        for k, at, v in new:
            if k not in want or at > want[k][0]:
                want[k] = (at, v)
    assert {r.k: (r.at, r.v) for r in t.current().collect()} == want
    # a base and at most two deltas a bucket, and what the last base replaced
    for b, ps in t._parts(None).items():
        assert len(t._live(ps)) <= 3 and len(ps) <= 6
    like = rows(spark, []).schema
    got = t.lookup(rows(spark, [(3, 0, ""), (6, 0, ""), (999, 0, "")]), 12, like)
    assert {r.k: (r.at, r.v) for r in got.collect()} == {k: want[k] for k in (3, 6)}
    assert "In(" in got._jdf.queryExecution().toString() or "IN " in got._jdf.queryExecution().toString()
    many = t.lookup(rows(spark, [(k, 0, "") for k in range(300)] + [(None, 0, "")]), 12, like)
    assert {r.k: (r.at, r.v) for r in many.collect()} == want


def test_keyed_table_replayed_batch(spark):
    t = table(spark, compact_every=2)
    for epoch in range(3):
        t.add(rows(spark, [(k, epoch, f"{epoch}") for k in range(8)]), epoch)
    before = folders(t)
    t.add(rows(spark, [(k, 2, "2") for k in range(8)]), 2)            # the same batch again
    assert folders(t) == before and {r.v for r in t.current().collect()} == {"2"} and t.current().count() == 8
    # what epoch 3 sees does not depend on a batch 3 that failed half-way
    t.add(rows(spark, [(1, 3, "half")]), 3)
    seen = t.lookup(rows(spark, [(1, 0, "")]), 3, rows(spark, []).schema).first()
    assert seen.v == "2"


def aged(spark, df, folder, days):
    df.coalesce(1).write.json(folder)
    for name in os.listdir(folder):
        at = time.time() - days * 86400
        os.utime(os.path.join(folder, name), (at, at))


def scorer(live):
    """Stand-in for the scored view: a site's result is the number of live sites of its entity."""
    counts = live.groupBy("siren").agg(F.count(F.lit(1)).alias("n"))
    return live.join(counts, "siren").select("siret", "siren", "n", "state")


def run_states(spark, files, **more):
    """Score ``files`` (days old, rows) one after the other; siret -> (siren, n, state)."""
    root = tempfile.mkdtemp(prefix="tessera-st3-")
    schema = spark.createDataFrame([], "siret string, siren string, state string, since string").schema
    for k, (days, data) in enumerate(files):
        aged(spark, spark.createDataFrame(data, schema), f"{root}/landing/p{k}", days)
        score_stream(spark, f"{root}/landing/*", schema, f"{root}/out", scorer, active="state <> 'F'", buckets=4, **more)
    return root, {r.siret: (r.siren, r.n, r.state) for r in latest_scored(spark, f"{root}/out").collect()}


def test_older_versions_change_nothing(spark):
    first = (5, [("1", "a", "A", "2024-01-01"), ("2", "a", "A", "2024-01-01"), ("3", "b", "A", "2024-01-01")])
    closed = (0, [("1", "a", "F", "2024-03-01")])
    older = (60, [("1", "a", "A", "2024-01-01"), ("4", "b", "A", "2024-01-01")])
    _, got = run_states(spark, [first, closed, older])
    assert got == {"2": ("a", 1, "A"), "3": ("b", 2, "A"), "4": ("b", 2, "A")}
    # the record's own date counts before the file's: a new file with an old state changes nothing either
    _, got = run_states(spark, [first, closed, (-1, older[1])], own_date="since", compact_every=2)
    assert got == {"2": ("a", 1, "A"), "3": ("b", 2, "A"), "4": ("b", 2, "A")}


def test_moves_there_and_back(spark):
    site = lambda entity, since: [("1", entity, "A", since)]
    files = [(9, site("a", "2024-01-01") + [("2", "a", "A", "2024-01-01"), ("3", "b", "A", "2024-01-01")])]
    files += [(8 - k, site("ba"[k % 2], f"2024-02-0{k + 1}")) for k in range(4)]
    root, got = run_states(spark, files, own_date="since", compact_every=2)
    assert got == {"1": ("a", 2, "A"), "2": ("a", 2, "A"), "3": ("b", 1, "A")}
    # history does not pile up
    for name in ("establishments", "owners", "scored"):
        t = KeyedTable(spark, f"{root}/out/{name}", "siret", ["siret"], ["x"], buckets=4)
        assert all(len(ps) <= 4 for ps in t._parts(None).values())


def test_replays_are_dropped_however_late(spark):
    root = tempfile.mkdtemp(prefix="tessera-st2-")
    schema = spark.createDataFrame([], "siret string, v long").schema
    land = lambda k, days, ids: aged(spark, spark.createDataFrame([(str(i), k) for i in ids], schema), f"{root}/landing/p{k}", days)
    for k, (days, ids) in enumerate([(121, range(40)), (90, range(10, 50)), (31, range(60)), (0, range(0, 70, 3)), (0, [5, 5, 99])]):
        land(k, days, ids)
        ingest_pages(spark, f"{root}/landing/*", schema, f"{root}/raw", f"{root}/_ck", flatten=False, dedup_key="siret",
                     key_index=f"{root}/keys", buckets=4)
    out = spark.read.parquet(f"{root}/raw")
    got = {int(r.siret): r.v for r in out.collect()}
    first = {}
    for k, ids in enumerate([range(40), range(10, 50), range(60), range(0, 70, 3), [5, 99]]):
        for i in ids:
            first.setdefault(i, k)
    assert out.count() == len(got) and got == first


def test_keyed_table_writes_files_by_size(spark):
    """Not one file a task and bucket, each with a filter for a million keys."""
    t = table(spark)
    t.add(spark.range(2000).selectExpr("id AS k", "id AS at", "string(id) AS v").repartition(8), 0)
    files = [os.path.join(at, n) for at, _, names in os.walk(t.root) for n in names if n.endswith(".parquet")]
    assert len(files) <= 8 and sum(os.path.getsize(f) for f in files) < 1_000_000
    assert t.current().count() == 2000


def test_a_first_batch_meets_no_state(spark):
    """No joins or lookups against tables that hold nothing yet."""
    t = table(spark)
    got = rows(spark, [(1, 0, "a")]).join(t.lookup(rows(spark, [(1, 0, "")]), 0, rows(spark, []).schema).withColumnRenamed("k", "seen"),
                                          F.col("k") == F.col("seen"), "left")
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_landings_grow_by_files(spark, sf_small, monkeypatch):
    from tessera.plans import q_io
    monkeypatch.setattr(q_io, "_ROWS_PER_LANDING", 500)
    n, root = q_io._times(spark, sf_small), tempfile.mkdtemp(prefix="tessera-land-")
    assert n > 1
    q_io._land_pages(spark, sf_small, root, True)
    landed = {p: [f for f in os.listdir(f"{root}/{p}") if f.startswith("part-")] for p in ("p1", "p2")}
    assert len(landed["p1"]) == 6 * n and len(landed["p2"]) == 2 * n
    assert all(f.endswith(".json.gz") for fs in landed.values() for f in fs)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_a_batch_leaves_no_shuffle_or_staged_files(spark):
    """Shuffle files go with the step that made them, not when the driver collects garbage; no rows are cached."""
    spark.sparkContext._jvm.System.gc()
    cached = spark.sparkContext._jsc.sc().getRDDStorageInfo()
    before, cached, setting = shuffle_files(spark), len(cached), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, at_scoring = spark.conf.get(setting), []
    first = [(str(k), str(k % 5), "A", "2024-01-01") for k in range(40)]
    again = [(str(k), str(k % 3), "F" if k % 7 == 0 else "A", "2024-02-01") for k in range(0, 40, 2)]
    root = tempfile.mkdtemp(prefix="tessera-st3-")
    schema = spark.createDataFrame([], "siret string, siren string, state string, since string").schema

    def scoring(live):
        at_scoring.append(len(spark.sparkContext._jsc.sc().getRDDStorageInfo()))
        return scorer(live)

    for k, (days, data) in enumerate([(5, first), (0, again)]):
        aged(spark, spark.createDataFrame(data, schema), f"{root}/landing/p{k}", days)
        score_stream(spark, f"{root}/landing/*", schema, f"{root}/out", scoring, active="state <> 'F'", buckets=4)
    for _ in range(50):                  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and at_scoring and max(at_scoring) <= cached
    assert not os.path.exists(f"{root}/out/_staged") and spark.conf.get(setting) == was


def test_state_holds_what_scoring_reads(spark):
    """Other columns are not kept, but tell versions apart."""
    schema = spark.createDataFrame([], "siret string, siren string, state string, since string, note string").schema
    files = [(5, [("1", "a", "A", "x", "n"), ("2", "a", "A", "x", "n"), ("3", "b", "A", "x", "n")]), (0, [("1", "a", "F", "x", "m"), ("2", "b", "A", "y", "n")])]
    root = tempfile.mkdtemp(prefix="tessera-st3-")
    for k, (days, data) in enumerate(files):
        aged(spark, spark.createDataFrame(data, schema), f"{root}/landing/p{k}", days)
        score_stream(spark, f"{root}/landing/*", schema, f"{root}/out", scorer, active="state <> 'F'", buckets=4, reads=["state"])
    assert {r.siret: (r.siren, r.n, r.state) for r in latest_scored(spark, f"{root}/out").collect()} == {"2": ("b", 2, "A"), "3": ("b", 2, "A")}
    kept = spark.read.parquet(f"{root}/out/establishments")
    assert {"siret", "siren", "state"} < set(kept.columns) and not {"since", "note"} & set(kept.columns)
    assert kept.where("siret = '1'").select("__hash").distinct().count() == 2


def test_scored_from_names_all_that_scoring_reads(spark, sf_small):
    from tessera.plans import model, q_io
    from tessera.plans.q_core import context
    full = model.full(spark, sf_small)[0].drop(*q_io.SALT_COLUMNS)
    score = q_io._entity_scorer(context(spark, sf_small)[2])
    want = score(full.where(q_io._ACTIVE))
    got = score(full.select("siret", "siren", *q_io._SCORED_FROM).where(q_io._ACTIVE))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lookup_with_more_rows(spark):
    t = table(spark)
    like, more = rows(spark, []).schema, rows(spark, [(1, 5, "new"), (2, -1, "old"), (8, 0, "first")])
    assert {r.k: r.v for r in t.lookup(more, 0, like, more).collect()} == {1: "new", 2: "old", 8: "first"}
    t.add(rows(spark, [(k, 1, str(k)) for k in range(5)]), 0)
    assert {r.k: r.v for r in t.lookup(more, 1, like, more).collect()} == {1: "new", 2: "2", 8: "first"}


def test_staged_tables(spark):
    staging = Staging(spark, tempfile.mkdtemp(prefix="tessera-staged-") + "/_staged")
    one = staging.put("one", rows(spark, [(1, 2, "a"), (None, 3, None)]))
    two = staging.put("two", rows(spark, []))
    assert sorted(map(str, one.collect())) == sorted(map(str, rows(spark, [(1, 2, "a"), (None, 3, None)]).collect()))
    assert two.isEmpty() and two.columns == one.columns
    staging.drop("one")
    assert os.listdir(staging.root) == ["two"]
    staging.drop()
    assert not os.path.exists(staging.root)
