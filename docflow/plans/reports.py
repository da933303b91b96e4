"""The engine's reports over a corpus.

Each takes frames and returns frames, in no order: sort what is shown. Several outputs of one report read the
same evaluated documents; pass a staged frame (:func:`evaluate_once`) so that
the patterns run once, not once per output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docflow.certificate import CERTIFICATES
from docflow.operators import classify as cl
from docflow.operators import gapfill as gf
from docflow.operators import score as sc
from docflow.operators import validate as va
from docflow.operators.extract import pack_fields, route
from docflow.operators.review import DEFAULT_THRESHOLD, clean, evaluate, queue_summary, to_review
from docflow.sources.answers import compact_answers, live_parts, read_answers, touched_prefixes
from docflow.sources.documents import tasks_for
from docflow.sources.scratch import staged
from docflow.sources.truth import normalize_truth, truth_rejects
from docflow.spec import Spec

# Appends to the answer table between two compactions.
COMPACT_AFTER = 64


def evaluate_once(
    docs: DataFrame, spec: Spec = CERTIFICATES, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Evaluated documents, written to the shared folder and read back."""
    return staged(evaluate(docs, spec, threshold), "evaluated")


@dataclass(frozen=True)
class ReviewQueue:
    summary: DataFrame
    review: DataFrame
    clean: DataFrame


def review_queue(evaluated: DataFrame, spec: Spec = CERTIFICATES) -> ReviewQueue:
    """Counts, the documents to review with their reasons, and the clean ones, by file."""
    return ReviewQueue(
        summary=queue_summary(evaluated),
        review=pack_fields(to_review(evaluated), spec),
        clean=pack_fields(clean(evaluated), spec),
    )


@dataclass(frozen=True)
class RoutingReport:
    documents: DataFrame
    counts: DataFrame
    accuracy: DataFrame
    misrouted: DataFrame
    conflicts: DataFrame


def routing_report(classified: DataFrame, truth_layouts: DataFrame) -> RoutingReport:
    """Where each document landed and where the key says it should have."""
    documents = sc.routing(classified, truth_layouts)
    return RoutingReport(
        conflicts=sc.conflicting_layouts(truth_layouts),
        documents=documents,
        counts=cl.layout_counts(classified),
        accuracy=sc.routing_accuracy(documents),
        misrouted=sc.misrouted(documents),
    )


@dataclass(frozen=True)
class ValidationReport:
    documents: DataFrame
    counts: DataFrame
    errors: DataFrame


def validation_report(evaluated: DataFrame) -> ValidationReport:
    return ValidationReport(
        documents=va.validation_status(evaluated),
        counts=va.validation_counts(evaluated),
        errors=va.validation_errors(evaluated),
    )


@dataclass(frozen=True)
class AccuracyReport:
    accuracy: DataFrame
    overall: DataFrame
    skipped: DataFrame
    mismatches: DataFrame
    rejects: DataFrame
    absent: DataFrame
    repeated: DataFrame


def accuracy_report(
    evaluated: DataFrame, truth: DataFrame, spec: Spec = CERTIFICATES
) -> AccuracyReport:
    """Scores against a key of strings, and everything that kept a row from a score.

    A name of the key that several documents bear is not scored against any of them,
    but listed in ``repeated``. Both sides of the join are dealt by number of rows: they
    are wide, and compress so well that tasks of so many bytes would hold ever more.
    """
    tasks = max(tasks_for(evaluated), tasks_for(truth))
    repeated = sc.repeated_names(evaluated, truth)
    unique = evaluated.repartition(tasks, "file").join(repeated, "file", "left_anti")
    scored = sc.with_truth(unique, normalize_truth(truth.repartition(tasks, "file"), spec), spec)
    accuracy = sc.field_accuracy(scored, spec)
    return AccuracyReport(
        accuracy=accuracy,
        overall=sc.overall_accuracy(accuracy),
        skipped=sc.skipped_by_layout(scored),
        mismatches=sc.mismatches(scored, spec),
        rejects=truth_rejects(truth, spec),
        absent=sc.truth_without_document(evaluated, truth),
        repeated=repeated,
    )


def fill_gaps(
    docs: DataFrame,
    caller: gf.Caller,
    config: gf.GapFill,
    answers_path: str,
    spec: Spec = CERTIFICATES,
    parallelism: int | None = None,
    allow_speculation: bool = False,
    concurrency: int = 1,
    wave_requests: int = gf.WAVE_REQUESTS,
    compact_after: int = COMPACT_AFTER,
) -> DataFrame:
    """Outcome per document of the configured layouts; answers are appended first.

    Filled values stay here: confidence, validation and the review queue describe
    what was extracted, unless they are run again on the outcome. Of the answer table
    only the key prefixes that the documents ask for are read, before and after the
    calls; it is compacted first if it has come to more than ``compact_after`` parts.
    """
    spark: SparkSession = docs.sparkSession
    documents = route(docs, spec, layouts=config.layouts)
    requests = staged(gf.plan_requests(documents, config, spec), "requests")
    if len(live_parts(spark, answers_path)[0]) > compact_after:
        compact_answers(spark, answers_path)
    prefixes = touched_prefixes(requests)
    pending = gf.pending_requests(requests, read_answers(spark, answers_path, prefixes))
    run = gf.answer_requests(
        pending, caller, config, answers_path, parallelism, allow_speculation, concurrency, wave_requests
    )
    return gf.apply_answers(requests, read_answers(spark, answers_path, prefixes), run, spec)


def gap_fill_report(
    outcomes: DataFrame, truth: DataFrame, config: gf.GapFill, spec: Spec = CERTIFICATES
) -> DataFrame:
    return gf.gapfill_report(outcomes, normalize_truth(truth, spec), config, spec)
