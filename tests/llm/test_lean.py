"""Batches of long texts stay small in the pipeline's session."""

import pyarrow as pa

import corpus_pipeline
from moraine.llm.common import LEAN


def texts(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(60).selectExpr("id as doc_id", "repeat('word ', 40000) as text").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def test_a_stage_hands_long_texts_to_python_in_small_batches(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    own = spark.newSession()
    docs = texts(own, tmp_path)
    assert corpus_pipeline.tokenize(own, docs, "").count() == 60
    got = docs.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 60
    assert max(r["bytes"] for r in got) < 4_000_000


def test_settings_of_the_session_stay(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1000000b")
    corpus_pipeline.lean(own)
    assert own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1000000b"
    assert own.conf.get("parquet.block.size") == LEAN["parquet.block.size"]
    assert spark.conf.get("parquet.block.size", None) is None
