"""Batches: rows reach an operator in short slices, whole and in order."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tutelage.llm import frames


def test_a_large_batch_comes_in_slices(spark):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array([batch.nbytes] * batch.num_rows, pa.int64())], names=["id", "seen"])

    rows = 4000
    docs = spark.range(rows, numPartitions=1).select("id", F.when(F.col("id") % 7 > 0, F.repeat(F.lit("x"), 3000)).alias("text"))  # one batch of 10 MB
    got = frames.batched(docs, run, "id bigint, seen bigint").collect()
    assert [r["id"] for r in got] == list(range(rows))
    assert max(r["seen"] for r in got) < 2 * frames.SLICE_BYTES


def test_slices_keep_rows_of_any_size():
    texts = ["a" * 5_000_000, None, "", "b" * 10, "c" * 3_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["id", "text"])
    parts = list(frames.slices(batch))
    assert len(parts) > 1 and pa.Table.from_batches(parts).to_pydict() == {"id": list(range(5)), "text": texts}
    assert [p.num_rows for p in frames.slices(batch.slice(1, 3))] == [3]


def test_the_pipeline_keeps_batches_small(spark):
    own, other = spark.newSession(), spark.newSession()
    rows = "spark.sql.parquet.columnarReaderBatchSize"
    other.conf.set(rows, "100")
    for session in (own, other):
        docs = session.createDataFrame([(1, "a", 1)], "doc_id long, text string, n_chars int")
        assert corpus_pipeline.replace_private(session, docs, "").collect() == [(1, "a", 1)]
    assert (own.conf.get(rows), other.conf.get(rows)) == (frames.LEAN[rows], "100")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "seen"])

    got = own.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 3000).alias("text")).mapInArrow(run, "n long, seen long").collect()
    assert sum(r["n"] for r in got) == 4000 and max(r["seen"] for r in got) < 2 * frames.SLICE_BYTES
