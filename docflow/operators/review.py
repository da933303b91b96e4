"""Confidence and the review decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.functions import present
from docflow.operators.extract import routed
from docflow.operators.frames import settled
from docflow.operators.validate import validate
from docflow.spec import Spec

# A pattern either finds a value or does not, so a score is 1.0 or 0.0.
FOUND, MISSING = 1.0, 0.0
DEFAULT_THRESHOLD = 1.0


def _score(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.lit(FOUND)).otherwise(F.lit(MISSING))


def field_confidences(spec: Spec = CERTIFICATES) -> Column:
    """Map of field name to score."""
    names = F.array(*[F.lit(name) for name in spec.names])
    return F.map_from_arrays(names, F.array(*[_score(name) for name in spec.names]))


def low_confidence_fields(spec: Spec = CERTIFICATES, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Names of the fields that score below ``threshold``, in record order."""
    return present(*[F.when(_score(n) < F.lit(float(threshold)), F.lit(n)) for n in spec.names])


def missing_fields(spec: Spec = CERTIFICATES) -> Column:
    """Names of the null fields, in record order."""
    return present(*[F.when(F.col(name).isNull(), F.lit(name)) for name in spec.names])


def confidences_long(df: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """One row per document and field with its score."""
    entries = [
        F.struct(F.lit(name).alias("field"), _score(name).alias("score")) for name in spec.names
    ]
    return df.select("file", F.inline(F.array(*entries)))


def _reasons() -> Column:
    low = F.concat(F.lit("low-confidence/missing fields: "), F.array_join("low_confidence", ", "))
    own = present(
        F.when(F.col("no_extraction"), F.concat(F.lit("routing: "), F.col("note"))),
        F.when(F.size("low_confidence") > 0, low),
    )
    errors = F.coalesce(F.col("errors"), F.array().cast("array<string>"))
    return F.concat(own, F.transform(errors, lambda e: F.concat(F.lit("validation: "), e)))


def judge(
    documents: DataFrame, spec: Spec = CERTIFICATES, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Add confidence, validation and the review decision to routed documents.

    ``reasons`` names the routing failure, the missing fields and every
    validation error, in this order; any reason sends the document to review.
    """
    return (
        validate(documents, spec)
        .withColumns(
            {
                "confidences": field_confidences(spec),
                "low_confidence": low_confidence_fields(spec, threshold),
            }
        )
        .withColumn("reasons", _reasons())
        .withColumn("needs_review", F.size("reasons") > 0)
    )


def evaluate(
    docs: DataFrame, spec: Spec = CERTIFICATES, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """The whole per-document pipeline over ``(file, text)``, without the text.

    One narrow stage from the scan on: route, read, validate, score, decide.
    """
    judged = judge(routed(docs, spec), spec, threshold).drop("text")
    return settled(judged)


def clean(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(~F.col("needs_review"))


def to_review(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(F.col("needs_review"))


def write_split(evaluated: DataFrame, path: str) -> None:
    """Write both sets in one pass, as partitions ``queue=clean`` and ``queue=review``."""
    queue = F.when(F.col("needs_review"), F.lit("review")).otherwise(F.lit("clean"))
    split = evaluated.withColumn("queue", queue)
    split.write.mode("errorifexists").partitionBy("queue").parquet(path)


def queue_summary(evaluated: DataFrame) -> DataFrame:
    """One row: documents in all, clean, and to be reviewed."""
    return evaluated.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(~F.col("needs_review")).alias("clean"),
        F.count_if(F.col("needs_review")).alias("review"),
    )
