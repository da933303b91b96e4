from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.operators import classify as cl
from docflow.operators import extract as ex
from docflow.operators import score as sc
from docflow.operators import review as rv
from docflow.plans import reports
from samples import FIELDS_A, TEXT_A, TEXT_B, by_file, documents, records, text_c

NAMES = CERTIFICATES.names


def key_of(frame, layouts: dict[str, str]):
    pairs = frame.sparkSession.createDataFrame(list(layouts.items()), "file string, layout string")
    return frame.join(pairs, "file")


def scored(spark):
    nan = float("nan")
    actual = records(
        spark,
        {
            "right": FIELDS_A,
            "null is null": {**FIELDS_A, "capacity_lbs": None},
            "nan": {**FIELDS_A, "invoice_total": nan},
            "wrong": {**FIELDS_A, "city": None, "next_due": date(2030, 1, 1)},
            "skipped": {},
            "not in key": FIELDS_A,
        },
    ).withColumn("no_extraction", F.col("file") == "skipped")
    key = key_of(
        records(
            spark,
            {
                "right": FIELDS_A,
                "null is null": {**FIELDS_A, "capacity_lbs": None},
                "nan": {**FIELDS_A, "invoice_total": nan},
                "wrong": FIELDS_A,
                "skipped": FIELDS_A,
                "absent": FIELDS_A,
            },
        ),
        {"right": "A", "null is null": "C", "nan": "C", "wrong": "A", "skipped": "B", "absent": "A"},
    )
    return actual, key, sc.with_truth(actual, key)


def test_field_scores(spark):
    actual, key, joined = scored(spark)
    accuracy = sc.field_accuracy(joined)
    rows = {(r.layout, r.field): (r.correct, r.total, r.accuracy) for r in accuracy.collect()}
    assert rows[("A", "city")] == (1, 2, 0.5) and rows[("A", "state")] == (2, 2, 1.0)
    assert rows[("C", "capacity_lbs")] == (2, 2, 1.0)
    assert rows[("C", "invoice_total")] == (1, 2, 0.5)  # NaN is equal to nothing
    assert rows[("A", None)] == (24, 26, 24 / 26) and rows[("C", None)] == (25, 26, 25 / 26)
    assert rows[(None, None)] == (49, 52, 49 / 52)
    assert len(rows) == 2 * 13 + 2 + 1
    assert tuple(sc.overall_accuracy(accuracy).first()) == (49, 52, 49 / 52)
    wrong = {(r.file, r.field): (r.expected, r.actual) for r in sc.mismatches(joined).collect()}
    assert wrong == {
        ("wrong", "city"): ("Salem", None),
        ("wrong", "next_due"): ("2025-03-09", "2030-01-01"),
        ("nan", "invoice_total"): ("NaN", "NaN"),
    }
    assert [tuple(r) for r in sc.skipped_by_layout(joined).collect()] == [("B", 1)]
    assert [r.file for r in sc.truth_without_document(actual, key).collect()] == ["absent"]
    nothing = sc.overall_accuracy(sc.field_accuracy(joined.filter("false"))).first()
    assert tuple(nothing) == (0, 0, 0.0)


def test_routing_against_the_key(spark):
    docs = documents(
        spark, {"a": TEXT_A, "b": TEXT_B, "c": text_c(), "two": TEXT_A + TEXT_B, "free": TEXT_A}
    )
    key = spark.createDataFrame(
        [("a", "A"), ("b", "B"), ("c", "A"), ("two", "A")], "file string, layout string"
    )
    report = reports.routing_report(ex.route(docs), key)
    rows = by_file(report.documents)
    assert {f: r.misrouted_vs_truth for f, r in rows.items()} == {
        "a": False, "b": False, "c": True, "two": True, "free": False,
    }
    # Layout B is routed rightly and still yields no extraction.
    assert by_file(ex.route(docs))["b"].no_extraction
    assert tuple(report.accuracy.first()) == (2, 4, 0.5)
    assert [r.file for r in report.misrouted.collect()] == ["c", "two"]
    assert [tuple(r) for r in report.counts.collect()] == [
        ("A", 2), ("AMBIGUOUS", 1), ("B", 1), ("C", 1),
    ]
    without_key = sc.routing(cl.classify(docs), key.filter("false"))
    assert tuple(sc.routing_accuracy(without_key).first()) == (0, 0, 0.0)


def corpus(spark):
    """36 documents, 12 of each layout, four of layout C without a load."""
    texts = {}
    for n in range(36):
        layout, name = "ABC"[n % 3], f"doc-{n:02}"
        load = "pounds" if n % 9 == 2 else f"{n + 1}00 pounds"
        text = {"A": TEXT_A, "B": TEXT_B, "C": text_c(load, early=n % 2 == 0)}[layout]
        texts[name] = text.replace("TH-77-000", f"TH-{n}-000")
    return documents(spark, texts)


def test_reports_over_a_corpus(spark):
    evaluated = reports.evaluate_once(corpus(spark))
    queue = reports.review_queue(evaluated)
    assert tuple(queue.summary.first()) == (36, 20, 16)
    assert all(r.fields.capacity_lbs is not None for r in queue.clean.collect())
    reviewed = queue.review.collect()
    assert sum(r.fields is None for r in reviewed) == 12
    assert [r.reasons for r in reviewed if r.fields] == [
        ["low-confidence/missing fields: capacity_lbs"]
    ] * 4
    assert tuple(reports.validation_report(evaluated).counts.first()) == (24, 0, 12)
    counts = reports.routing_report(evaluated, evaluated.select("file", "layout"))
    assert [tuple(r) for r in counts.counts.collect()] == [("A", 12), ("B", 12), ("C", 12)]
    assert tuple(counts.accuracy.first()) == (36, 36, 1.0)


def test_same_result_however_partitioned(spark):
    docs = corpus(spark)

    def result(frame):
        return sorted(rv.evaluate(frame).toJSON().collect())

    want = result(docs.coalesce(1))
    assert result(docs.repartition(64)) == want
    assert result(docs.orderBy(F.desc("file"))) == want
