"""Evaluating documents as they arrive.

Everything up to the review decision looks at one document at a time, so the
batch operators run unchanged on a stream, without state or watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docflow.certificate import CERTIFICATES
from docflow.operators.review import DEFAULT_THRESHOLD, evaluate
from docflow.spec import Spec


def start_review_stream(
    docs: DataFrame,
    path: str,
    checkpoint: str,
    spec: Spec = CERTIFICATES,
    threshold: float = DEFAULT_THRESHOLD,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Append evaluated documents to a table split by ``needs_review``."""
    return (
        evaluate(docs, spec, threshold)
        .writeStream.format("parquet")
        .partitionBy("needs_review")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
