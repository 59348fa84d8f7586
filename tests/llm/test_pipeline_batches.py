"""How many texts of the pipeline stand in one Arrow batch."""

import pyarrow as pa

import corpus_pipeline


def test_stages_get_small_batches(spark, make_docs, monkeypatch):
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    docs = make_docs([(i, f"text {i}") for i in range(5000)]).coalesce(1)
    stage = corpus_pipeline._stage(lambda spark, docs, sf_dir: docs.mapInArrow(count, "n bigint"))
    try:
        sizes = [r["n"] for r in stage(spark, docs, "").collect()]
    finally:
        spark.conf.set(setting, before)
    assert sum(sizes) == 5000 and max(sizes) <= 1000
