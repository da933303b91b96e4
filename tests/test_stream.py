from __future__ import annotations

from docflow.operators.review import evaluate
from docflow.streaming.review_stream import start_review_stream
from samples import TEXT_A, TEXT_B, documents, text_c


def test_stream_and_batch_agree(spark, tmp_path):
    docs = documents(spark, {"a": TEXT_A, "b": TEXT_B, "c": text_c(load="pounds")})
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.write.parquet(source)
    stream = spark.readStream.schema(docs.schema).parquet(source)
    query = start_review_stream(stream, out, str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    columns = ["file", "detected", "reasons", "errors", "capacity_lbs"]
    got = sorted(spark.read.parquet(out).select(columns).toJSON().collect())
    assert got == sorted(evaluate(docs).select(columns).toJSON().collect())
