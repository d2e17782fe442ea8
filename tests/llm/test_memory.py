"""What keeps the memory of executors and their Python workers bounded."""

import time
import weakref

import pyarrow as pa

import corpus_pipeline
from tessera.llm import common

READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def test_whole_texts_are_read_a_few_at_a_time(spark, sf_small):
    """Every way to the documents sets the reader's batches, but never over what the session says itself."""
    plain = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").limit(20)
    ways = [lambda: common.table(spark, sf_small, "documents"), lambda: common.materialise(plain, "test-reader-rows"),
            lambda: common.arrow_map(plain, lambda batch: batch, "doc_id long, text string"),
            lambda: corpus_pipeline.packing_stage(spark, plain, sf_small)]
    before = spark.conf.get(READER_ROWS, None)
    try:
        for way in ways:
            spark.conf.unset(READER_ROWS)
            way()
            assert int(spark.conf.get(READER_ROWS)) <= 512
            spark.conf.set(READER_ROWS, "1024")
            way()
            assert spark.conf.get(READER_ROWS) == "1024"
    finally:
        spark.conf.unset(READER_ROWS) if before is None else spark.conf.set(READER_ROWS, before)


def test_freed_memory_goes_back_after_the_last_batch(spark, monkeypatch):
    """No batch is in hand at the task's last release, and a resting worker releases once more."""
    made, in_hand = [], []
    monkeypatch.setattr(common, "release", lambda: in_hand.append(sum(b() is not None for b in made)))

    class Frame:
        sparkSession = spark
        mapInArrow = staticmethod(lambda run, schema: run)

    def batches():
        for k in range(3):
            batch = pa.record_batch({"x": pa.array([k] * 10)})
            made.append(weakref.ref(batch))
            yield batch
            del batch

    run = common.arrow_map(Frame, lambda batch: pa.record_batch({"x": batch.column(0).slice(0, 1)}), "x long")
    assert sum(out.num_rows for out in run(batches())) == 3
    assert in_hand[-1] == 0
    before = len(in_hand)
    time.sleep(2.5)
    assert len(in_hand) > before
