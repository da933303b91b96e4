"""Review decisions: what a reviewer submitted against what had been extracted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.operators.frames import as_text, require_columns
from docflow.functions import strip
from docflow.spec import Spec

APPROVE, CORRECT = "approve", "correct"


def iso_utc(at: Column) -> Column:
    """A timestamp in UTC, ISO 8601, whatever the session's time zone.

    Counted from the epoch without a zone: a UTC time that the session's zone skips
    in spring could not be written otherwise.
    """
    micros = F.unix_micros(at)
    fraction = F.pmod(micros, F.lit(1_000_000))
    seconds = ((micros - fraction) / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)
    day_and_time = F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(day_and_time, F.lit("."), F.lpad(fraction.cast("string"), 6, "0"), F.lit("+00:00"))


def now_iso() -> Column:
    """The query's start in UTC, ISO 8601."""
    return iso_utc(F.current_timestamp())


def blank_to_null(value: Column) -> Column:
    """A blank input confirms that the value is missing; it is not an empty value."""
    return F.nullif(strip(value), F.lit(""))


@dataclass(frozen=True)
class ReviewBatch:
    """Audit entries, and ``(file, documents, fields)`` of submitted files that have none
    because several documents bear the name."""

    entries: DataFrame
    rejects: DataFrame


def _reviewed(
    submitted: DataFrame, extracted: DataFrame, reviewer: Column | str, spec: Spec
) -> DataFrame:
    """Submitted fields with the old value and the number of documents of the file's name.

    The corpus is first narrowed to the reviewed files, which Spark does without
    shuffling it while the reviewed files are few. A name is then counted in the same
    shuffle that the join needs, so a repeated one never multiplies rows.
    """
    require_columns(submitted, ("file", "field", "new_value"), "the submission")
    if isinstance(reviewer, str):
        if not reviewer.strip():
            raise ValueError("a review needs a reviewer")
        reviewer = F.lit(reviewer)
    new = submitted.select(
        "file",
        "field",
        F.col("new_value").cast("string").alias("new_value"),
        reviewer.alias("reviewer"),
    )
    old = extracted.select("file", *spec.names).join(
        submitted.select("file").distinct(), "file", "left_semi"
    )
    by_name = old.groupBy("file").agg(
        F.count(F.lit(1)).alias("_documents"), *[F.first(name).alias(name) for name in spec.names]
    )
    old_value = F.coalesce(
        *[F.when(F.col("field") == f.name, as_text(F.col(f.name), f.dtype)) for f in spec.fields]
    )
    return new.join(by_name, "file", "left").withColumn("old_value", old_value)


def _entries(reviewed: DataFrame, timestamp: Column | None, action: Column) -> DataFrame:
    return reviewed.select(
        (now_iso() if timestamp is None else timestamp).alias("timestamp"),
        "reviewer",
        "file",
        "field",
        action.alias("action"),
        "old_value",
        "new_value",
    )


def _decision() -> Column:
    same = F.col("old_value").eqNullSafe(F.col("new_value"))
    return F.when(same, F.lit(APPROVE)).otherwise(F.lit(CORRECT))


def record_review(
    submitted: DataFrame,
    extracted: DataFrame,
    reviewer: Column | str,
    timestamp: Column | None = None,
    spec: Spec = CERTIFICATES,
) -> DataFrame:
    """Audit entries for ``submitted`` ``(file, field, new_value)``.

    One entry per submitted field, changed or not: ``approve`` if the value
    reads as the extracted one does (null as null), ``correct`` if not. A
    field the record does not have, or a file the corpus does not, has the old
    value null. All entries carry one timestamp. A file that names several documents
    is an error, which :func:`review_batch` lists instead.
    """
    several = F.concat(F.col("file"), F.lit(" names "), F.col("_documents"), F.lit(" documents"))
    action = F.when(F.col("_documents") > 1, F.raise_error(several)).otherwise(_decision())
    return _entries(_reviewed(submitted, extracted, reviewer, spec), timestamp, action)


def review_batch(
    submitted: DataFrame,
    extracted: DataFrame,
    reviewer: Column | str,
    timestamp: Column | None = None,
    spec: Spec = CERTIFICATES,
) -> ReviewBatch:
    """As :func:`record_review`, with the files that name several documents listed apart."""
    reviewed = _reviewed(submitted, extracted, reviewer, spec)
    several = F.coalesce(F.col("_documents"), F.lit(0)) > 1
    rejects = reviewed.filter(several).groupBy("file").agg(
        F.max("_documents").alias("documents"), F.count(F.lit(1)).alias("fields")
    )
    return ReviewBatch(_entries(reviewed.filter(~several), timestamp, _decision()), rejects)


def entries_for_file(log: DataFrame, file: str, spec: Spec = CERTIFICATES) -> DataFrame:
    """A document's history, oldest first, and in a record's order within a review.

    Of a log at rest, ``read_audit(spark, path, file=...)`` reads the file's bucket only.
    """
    place = F.array_position(F.array(*map(F.lit, spec.names)), F.col("field"))
    return log.filter(F.col("file") == file).orderBy("timestamp", place)


def decision_counts(entries: DataFrame) -> DataFrame:
    """Approved and corrected fields per document and batch."""
    return entries.groupBy("file", "timestamp").agg(
        F.count_if(F.col("action") == APPROVE).alias("approved"),
        F.count_if(F.col("action") == CORRECT).alias("corrected"),
    )


def review_state(queue: DataFrame, log: DataFrame) -> DataFrame:
    """Add ``state`` to queue items: ``reviewed`` if the log names the file."""
    reviewed = log.select("file").distinct().withColumn("_reviewed", F.lit(True))
    state = F.when(F.col("_reviewed"), F.lit("reviewed")).otherwise(F.lit("pending"))
    return queue.join(reviewed, "file", "left").withColumn("state", state).drop("_reviewed")
