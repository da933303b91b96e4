"""The registered queries: every operator over the whole test tables.

Each query takes a session and a table folder. Certificates are rendered from
the orders (see ``fixtures``); arrays leave as joined strings so that results
compare easily.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import fixtures as fx
from docflow.certificate import CERTIFICATES
from docflow.operators import audit as au
from docflow.operators import classify as cl
from docflow.operators import extract as ex
from docflow.operators import gapfill as gf
from docflow.operators import review as rv
from docflow.operators import score as sc
from docflow.operators import validate as va
from docflow.plans import reports
from docflow.session import tune
from docflow.sources.answers import append_answers, compact_answers, read_answers
from docflow.sources.audit_log import append_audit, read_audit
from docflow.sources.documents import (
    FILES_PER_TASK,
    assemble_documents,
    evened,
    read_corpus,
    repeated_files,
    tasks_for,
    write_corpus,
)
from docflow.sources.scratch import scratch_path, staged
from docflow.sources.truth import (
    normalize_truth,
    read_truth,
    read_truth_layouts,
    truth_rejects,
)

Query = Callable[[SparkSession, str], DataFrame]

NAMES = CERTIFICATES.names
GAPS = gf.GapFill(
    model="stand-in",
    prompt="Return each requested field as the document states it, or null if it does not.",
)


def _joined(array: str) -> Column:
    return F.array_join(array, " | ")


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.evaluate(fx.certificates(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = normalize_truth(fx.answer_key(spark, sf_dir))
    return sc.with_truth(_evaluated(spark, sf_dir), truth)


def _routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir))
    return sc.routing(routed, fx.answer_key(spark, sf_dir).select("file", "layout"))


# Sources


def assembled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    (turns,) = fx.tables(spark, sf_dir, "conversations")
    pages = turns.select(
        F.col("conv_id").alias("file"), F.col("turn").alias("page_no"), "text"
    )
    return assemble_documents(pages)


def truth_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "answer-key")
    fx.answer_key(spark, sf_dir).write.csv(path, header=True)
    return normalize_truth(read_truth(spark, path))


def truth_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of three kinds of files: in the usual order, reversed with a remark that runs
    over two lines, and with a further column among those of the key."""
    key = fx.answer_key(spark, sf_dir)
    path = scratch_path(spark, "answer-key")
    remark = F.lit('says "maybe",\nthen no').alias("remark")
    headers = (key.columns, [remark, *reversed(key.columns)], [*key.columns[5:], F.lit(0).alias("page"), *key.columns[:5]])
    for i, columns in enumerate(headers):
        part = key.filter(F.pmod(F.xxhash64("file"), F.lit(len(headers))) == i).select(*columns)
        part.write.mode("append").csv(path, header=True, escape='"')
    return normalize_truth(read_truth(spark, path))


def corpus_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of its own in a folder per source, read back from there."""
    (documents,) = fx.tables(spark, sf_dir, "documents")
    path = scratch_path(spark, "corpus")
    folder = F.concat(F.lit("Räume + "), "source").alias("folder")
    # A writer ends each text with a line feed.
    texts = documents.select(folder, F.coalesce("text", F.lit("")).alias("text"))
    write_corpus(evened(texts, tasks_for(documents, FILES_PER_TASK)), path)
    sha256 = F.sha2(F.regexp_replace("text", r"\n\z", ""), 256).alias("text_sha256")
    # Staged, so that every file is opened once.
    docs = staged(read_corpus(spark, path).select("file", sha256), "corpus-read")
    repeated = repeated_files(docs).withColumnRenamed("documents", "namesakes")
    return docs.join(repeated, "file", "left").select(
        F.regexp_extract("file", "^folder=([^/]+)/[^/]+$", 1).alias("folder"),
        "text_sha256",
        F.coalesce("namesakes", F.lit(1)).alias("namesakes"),
    )


def truth_layouts_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "answer-key")
    fx.answer_key(spark, sf_dir).write.csv(path, header=True)
    return read_truth_layouts(spark, path)


def truth_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth_rejects(fx.answer_key(spark, sf_dir))


# Classification, routing, extraction


def classified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = cl.classify(fx.certificates(spark, sf_dir))
    return classified.select("file", "layout", "status", "detected", _joined("matched").alias("matched"))


def classify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.layout_counts(cl.classify(fx.certificates(spark, sf_dir)))


def marked_layout_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.is_layout(fx.certificates(spark, sf_dir), "A").select("file")


def route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir))
    return routed.select("file", "layout", "status", "no_extraction", "note")


def extract_layout_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir), layouts=("A",))
    return routed.select("file", *NAMES)


def extract_layout_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir), layouts=("C",))
    return routed.select("file", *NAMES)


def parse_all_as_layout_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ex.parse_as(fx.certificates(spark, sf_dir), "A")
    return parsed.select("file", *NAMES)


def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir))
    return routed.select("file", "detected", "defect_count")


def extracted_fields_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.fields_long(ex.route(fx.certificates(spark, sf_dir)))


def foreign_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    (documents,) = fx.tables(spark, sf_dir, "documents")
    docs = documents.select(F.col("doc_id").cast("string").alias("file"), "text")
    return rv.evaluate(docs).select("file", "detected", "needs_review", _joined("reasons").alias("reasons"))


# Validation


def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = va.validation_status(_evaluated(spark, sf_dir))
    return status.select("file", "detected", "status", _joined("errors").alias("errors"))


def validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validation_counts(_evaluated(spark, sf_dir))


def validate_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certificates with states of one to three letters and blank cities.

    Layout C's city takes at least one character, so a blank one reads as the blank itself.
    """
    state = """CASE k % 3 WHEN 0 THEN substring(state, 1, 1) WHEN 1 THEN concat(state, 'X') ELSE state END"""
    facts = fx.certificate_facts(spark, sf_dir).withColumns(
        {"state": F.expr(state), "city": F.expr("CASE WHEN k % 5 = 0 THEN '' ELSE city END")}
    )
    status = va.validation_status(rv.evaluate(fx.render(facts)))
    return status.select("file", "detected", "status", _joined("errors").alias("errors"))


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.validation_errors(_evaluated(spark, sf_dir)).select("file", "error")


# Confidence and review


def field_confidences_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.confidences_long(ex.route(fx.certificates(spark, sf_dir)))


def confidence_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.map_filter("confidences", lambda _, score: score >= 1.0)
    return _evaluated(spark, sf_dir).select(
        "file", F.array_join(F.map_keys(found), ",").alias("found")
    )


def _queue(evaluated: DataFrame) -> DataFrame:
    return evaluated.select(
        "file",
        "layout",
        "note",
        "needs_review",
        _joined("low_confidence").alias("low_confidence"),
        _joined("reasons").alias("reasons"),
    )


def evaluated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(_evaluated(spark, sf_dir))


def evaluated_without_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(rv.evaluate(fx.certificates(spark, sf_dir), threshold=0.0))


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(rv.to_review(_evaluated(spark, sf_dir)))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.clean(_evaluated(spark, sf_dir)).select("file", *NAMES)


def review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.queue_summary(_evaluated(spark, sf_dir))


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    rv.write_split(_evaluated(spark, sf_dir), path)
    written = spark.read.parquet(path)
    return written.groupBy("queue", "detected").agg(F.count(F.lit(1)).alias("documents"))


# Answer key


def routing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routing(spark, sf_dir).select("file", "detected", "expected", "misrouted_vs_truth")


def routing_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.routing_accuracy(_routing(spark, sf_dir))


def misrouted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.misrouted(_routing(spark, sf_dir)).select("file", "detected", "expected", "note")


def accuracy_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.field_accuracy(_scored(spark, sf_dir))


def accuracy_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.overall_accuracy(sc.field_accuracy(_scored(spark, sf_dir)))


def accuracy_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.mismatches(_scored(spark, sf_dir))


def skipped_by_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.skipped_by_layout(_scored(spark, sf_dir))


def truth_without_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    absent = sc.truth_without_document(
        fx.certificates(spark, sf_dir), fx.answer_key(spark, sf_dir)
    )
    return absent.select("file", "layout")


def accuracy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts of the combined report, one below the other."""
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    report = reports.accuracy_report(evaluated, staged(fx.answer_key(spark, sf_dir), "answer-key"))
    return _stacked(report)


def _stacked(report: reports.AccuracyReport) -> DataFrame:
    meant = {"value": "actual", "documents": "total"}
    columns = {
        "layout": "string", "field": "string", "file": "string", "expected": "string", "actual": "string",
        "correct": "bigint", "total": "bigint", "accuracy": "double",
    }
    parts = []
    for name, frame in vars(report).items():
        frame = frame.withColumnsRenamed({old: new for old, new in meant.items() if old in frame.columns})
        shown = [
            (F.col(c) if c in frame.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()
        ]
        parts.append(frame.select(F.lit(name).alias("part"), *shown))
    return reduce(DataFrame.unionByName, parts)


def repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that a second document bears: named rejects of scoring and of review, never two rows."""
    docs = fx.certificates(spark, sf_dir)
    again = docs.filter(F.substring_index("file", "-", -1).cast("bigint") % 10 == 0)
    evaluated = staged(rv.evaluate(docs.unionByName(again)), "evaluated")
    key = staged(fx.answer_key(spark, sf_dir), "answer-key")
    report = reports.accuracy_report(evaluated, key)
    submitted = staged(_submission(evaluated.dropDuplicates(["file"])), "submitted")
    batch = au.review_batch(submitted, evaluated, "reviewer one", F.lit("2024-03-01T09:00:00.000000+00:00"))
    counted = au.decision_counts(batch.entries)
    scored = report.overall.select(F.lit("scored").alias("part"), F.lit(None).cast("string").alias("file"), F.col("total").alias("n"))
    return (
        scored.unionByName(report.repeated.select(F.lit("not scored").alias("part"), "file", F.col("documents").alias("n")))
        .unionByName(batch.rejects.select(F.lit("not reviewed").alias("part"), "file", F.col("documents").alias("n")))
        .unionByName(counted.select(F.lit("reviewed").alias("part"), "file", (F.col("approved") + F.col("corrected")).alias("n")))
    )


# Audit


def _submission(evaluated: DataFrame) -> DataFrame:
    """What reviewers enter for every queued document: gaps filled, the rest kept."""
    k = F.substring_index("file", "-", -1).cast("bigint")
    shown = ex.fields_long(rv.to_review(evaluated))
    field, value = F.col("field"), F.col("value")
    entered = (
        F.when((field == "capacity_lbs") & value.isNull(), (k % 4 * 500 + 1000).cast("string"))
        .when((field == "inspection_date") & value.isNull(), F.lit(" 2024-01-15 "))
        .when((field == "result") & (value == "DEFERRED"), F.lit("FAIL"))
        .otherwise(F.coalesce(value, F.lit("  ")))
    )
    return shown.select("file", "field", au.blank_to_null(entered).alias("new_value"))


def audit_record_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    entries = au.record_review(_submission(evaluated), evaluated, "reviewer one")
    return entries.drop("timestamp")


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    entries = au.record_review(
        _submission(evaluated), evaluated, "reviewer one", F.lit("2024-03-01T09:00:00.000000+00:00")
    )
    return au.decision_counts(entries)


def _audit_log(spark: SparkSession, evaluated: DataFrame, submission: DataFrame) -> str:
    """Where two reviews of the same documents were appended, one after the other."""
    submitted = staged(submission, "submitted")
    path = scratch_path(spark, "audit")
    for day, reviewer in (("01", "reviewer one"), ("02", "reviewer two")):
        stamp = F.lit(f"2024-03-{day}T09:00:00.000000+00:00")
        append_audit(au.record_review(submitted, evaluated, reviewer, stamp), path)
    return path


def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    facts = fx.certificate_facts(spark, sf_dir)
    urgent = facts.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("file")
    path = _audit_log(spark, evaluated, _submission(evaluated).join(urgent, "file", "left_semi"))
    return au.review_state(rv.to_review(evaluated).select("file", "detected"), read_audit(spark, path))


def audit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    return read_audit(spark, _audit_log(spark, evaluated, _submission(evaluated)))


def audit_of_a_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day's entries, read from their own folder of the log."""
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    return read_audit(spark, _audit_log(spark, evaluated, _submission(evaluated)), day="2024-03-02")


def document_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries for the first document of the queue by name, with their place in its history."""
    evaluated = staged(_evaluated(spark, sf_dir), "evaluated")
    path = _audit_log(spark, evaluated, _submission(evaluated))
    file = rv.to_review(evaluated).agg(F.min("file")).first()[0]
    history = au.entries_for_file(read_audit(spark, path, file=file), file)
    # A few rows, in order; numbered as they come.
    return history.coalesce(1).withColumn("place", F.monotonically_increasing_id())


# Gap filling


def _stand_in(failing: bool = False) -> gf.Caller:
    """Answers as a fixed function of the certificate number in the text; if ``failing``, an error on every third."""

    def call(text: str, missing: list[str]) -> gf.Answer:
        import re

        k = int(re.search(r"reference CRT-(\d+)", text).group(1))
        if failing and k % 3 == 0:
            raise TimeoutError(f"no answer for {k}")
        known = {
            "capacity_lbs": k % 5 * 500 + 1000 if k % 2 == 0 else None,
            "building": f"Hall {k}",
            "inspection_date": "2024-02-29" if k % 2 == 0 else "last spring",
        }
        return {name: known.get(name) for name in missing}, 400 + k % 100, 20

    return call


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ex.route(fx.certificates(spark, sf_dir), layouts=GAPS.layouts)
    return gf.plan_requests(routed, GAPS)


def fallback_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("file", _joined("missing").alias("missing"), "key")


def fallback_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _requests(spark, sf_dir).filter(F.col("key").isNotNull())
    schema = gf.request_schema(F.col("missing")).alias("schema")
    return requests.select(schema).groupBy("schema").agg(F.count(F.lit(1)).alias("requests"))


def _fill(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    docs = fx.certificates(spark, sf_dir)
    return reports.fill_gaps(docs, _stand_in(), GAPS, path)


def fallback_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that stay open once those without a building are answered."""
    path = scratch_path(spark, "answers")
    requests = staged(_requests(spark, sf_dir), "requests")
    some = requests.filter(F.array_contains("missing", "building"))
    none = read_answers(spark, path)
    gf.answer_requests(gf.pending_requests(some, none), _stand_in(), GAPS, path)
    return gf.pending_requests(requests, read_answers(spark, path)).select("file", "key")


def fallback_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "answers")
    _fill(spark, sf_dir, path)
    answers = gf.coerce_answers(read_answers(spark, path))
    return answers.select(
        "key",
        "input_tokens",
        "output_tokens",
        F.round("cost_usd", 8).alias("cost_usd"),
        F.col("answered_capacity_lbs").alias("capacity_lbs"),
        F.col("answered_building").alias("building"),
        F.col("answered_inspection_date").alias("inspection_date"),
    )


def _outcome(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        "file",
        *NAMES,
        "called",
        "from_cache",
        F.round("cost_usd", 8).alias("cost_usd"),
        _joined("fields_requested").alias("fields_requested"),
        _joined("fields_filled").alias("fields_filled"),
    )


def fallback_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome(_fill(spark, sf_dir, scratch_path(spark, "answers")))


def fallback_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the same documents: every answer is there already."""
    path = scratch_path(spark, "answers")
    _fill(spark, sf_dir, path)
    return _outcome(_fill(spark, sf_dir, path))


def fallback_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run whose calls fail for a third of the keys; the second asks only those."""
    path = scratch_path(spark, "answers")
    docs = fx.certificates(spark, sf_dir)
    reports.fill_gaps(docs, _stand_in(failing=True), GAPS, path)
    return _outcome(reports.fill_gaps(docs, _stand_in(), GAPS, path))


def fallback_shared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document also under another name: one request, paid by the first name.

    Later entries for the same keys, a compaction and a rerun of the copies change no answer.
    """
    path = scratch_path(spark, "answers")
    docs = fx.certificates(spark, sf_dir)
    copied = F.substring_index("file", "-", -1).cast("bigint") % 2 == 0
    both = docs.unionByName(docs.filter(copied).select(F.concat("file", F.lit("-copy")).alias("file"), "text"))
    first = staged(reports.fill_gaps(both, _stand_in(), GAPS, path), "outcomes")
    later = read_answers(spark, path).withColumns(
        {"seq": F.col("seq") + 1, "fields": F.lit('{"capacity_lbs": 1, "building": "elsewhere"}')}
    )
    append_answers(later, path)
    compact_answers(spark, path)
    copies = both.filter(F.endswith("file", F.lit("-copy")))
    again = reports.fill_gaps(copies, _stand_in(), GAPS, path)
    return _outcome(first).withColumn("run", F.lit(1)).unionByName(_outcome(again).withColumn("run", F.lit(2)))


def fallback_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over answers whose cost and latency are known, half of them from an earlier run."""
    path = scratch_path(spark, "answers")
    requests = staged(_requests(spark, sf_dir), "requests")
    k = F.substring_index("file", "-", -1).cast("bigint")
    asked = requests.filter(F.col("key").isNotNull()).select(
        (k % 2).alias("seq"),
        "key",
        F.lit("{}").alias("fields"),
        F.lit(100).cast("bigint").alias("input_tokens"),
        F.lit(10).cast("bigint").alias("output_tokens"),
        (k % 4 / 1000).alias("cost_usd"),
        (k % 8 / 4).alias("latency_seconds"),
    )
    append_answers(asked, path)
    outcomes = gf.apply_answers(requests, read_answers(spark, path), run=1)
    report = reports.gap_fill_report(outcomes, fx.answer_key(spark, sf_dir), GAPS)
    return report.select(
        "needing", "cache_hits", "fresh_calls", F.round("total_cost_usd", 8).alias("total_cost_usd"), "mean_fresh_latency_seconds"
    )


def fallback_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _fill(spark, sf_dir, scratch_path(spark, "answers"))
    report = reports.gap_fill_report(outcomes, fx.answer_key(spark, sf_dir), GAPS)
    dollars = ("total_cost_usd", "cost_per_needing_usd", "cost_per_document_usd")
    return report.drop("mean_fresh_latency_seconds").withColumns(
        {name: F.round(name, 8) for name in dollars}
    )


QUERIES: tuple[Query, ...] = (
    assembled_documents,
    truth_from_csv,
    truth_by_header,
    corpus_from_files,
    truth_layouts_from_csv,
    truth_unreadable,
    classified_documents,
    classify_counts,
    marked_layout_a,
    route_documents,
    extract_layout_a,
    extract_layout_c,
    parse_all_as_layout_a,
    section_counts,
    extracted_fields_long,
    foreign_documents,
    validate_documents,
    validation_counts,
    validate_lengths,
    validation_errors,
    field_confidences_long,
    confidence_maps,
    evaluated_documents,
    evaluated_without_threshold,
    review_queue,
    clean_documents,
    review_summary,
    split_table,
    routing_report,
    routing_accuracy,
    misrouted_documents,
    accuracy_by_field,
    accuracy_overall,
    accuracy_mismatches,
    skipped_by_layout,
    truth_without_document,
    accuracy_report,
    repeated_names,
    audit_record_review,
    audit_counts,
    audit_status,
    audit_history,
    audit_of_a_day,
    document_history,
    fallback_requests,
    fallback_schemas,
    fallback_pending,
    fallback_answers,
    fallback_outcome,
    fallback_rerun,
    fallback_with_failures,
    fallback_shared_keys,
    fallback_latency,
    fallback_report,
)


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def by_name() -> dict[str, Query]:
    return {query.__name__: _tuned(query) for query in QUERIES}
