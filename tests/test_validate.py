from __future__ import annotations

from datetime import date

from docflow.operators import review as rv
from docflow.operators.validate import validate
from samples import FIELDS_A, by_file, documents, records, TEXT_A, TEXT_B, text_c

RESULT = "result: Input should be 'PASS', 'FAIL' or 'PASS WITH DEFECTS'"
ORDER = "next_due (2024-03-09) must be later than inspection_date (2024-03-09)"
CONTRADICTION = (
    "result is FAIL but defect_count is 0 -- contradictory, "
    "a failed inspection must list at least one defect"
)


def test_every_rule_both_ways(spark):
    same_day = dict(next_due=date(2024, 3, 9))
    cases = {
        "valid": ({}, []),
        "no capacity": (dict(capacity_lbs=None), []),
        "capacity 0": (dict(capacity_lbs=0), ["capacity_lbs: Input should be greater than 0"]),
        "pass": (dict(result="PASS", defect_count=0), []),
        "pass with defects": (dict(result="PASS WITH DEFECTS", defect_count=1), []),
        "same day": (same_day, [f"<model>: Value error, {ORDER}"]),
        "contradiction": (dict(defect_count=0), [f"<model>: Value error, {CONTRADICTION}"]),
        "both": (
            dict(same_day, defect_count=0),
            [f"<model>: Value error, {ORDER}; {CONTRADICTION}"],
        ),
        # Rules over several fields wait until each field is sound.
        "gated": (dict(same_day, result="HM"), [RESULT]),
        "invoice 0": (dict(invoice_total=0.0), ["invoice_total: Input should be greater than 0"]),
        "invoice -1": (dict(invoice_total=-1.0), ["invoice_total: Input should be greater than 0"]),
        "invoice nan": (
            dict(invoice_total=float("nan")),
            ["invoice_total: Input should be greater than 0"],
        ),
        "defects -1": (
            dict(defect_count=-1),
            ["defect_count: Input should be greater than or equal to 0"],
        ),
        "empty": (dict(city=""), ["city: String should have at least 1 character"]),
        "short state": (dict(state="M"), ["state: String should have at least 2 characters"]),
        "long state": (dict(state="MAS"), ["state: String should have at most 2 characters"]),
        "nulls": (
            {name: None for name in FIELDS_A},
            [
                *[
                    f"{n}: Input should be a valid string"
                    for n in ("cert_no", "unit_id", "building", "city", "state", "unit_type")
                ],
                "inspection_date: Input should be a valid date",
                "next_due: Input should be a valid date",
                "inspector: Input should be a valid string",
                RESULT,
                "invoice_total: Input should be a valid number",
                "defect_count: Input should be a valid integer",
            ],
        ),
    }
    rows = by_file(
        validate(records(spark, {name: {**FIELDS_A, **change} for name, (change, _) in cases.items()}))
    )
    assert {name: rows[name].errors for name in cases} == {n: e for n, (_, e) in cases.items()}
    assert {n for n in cases if rows[n].valid} == {n for n, (_, errors) in cases.items() if not errors}


def test_review_decision(spark):
    docs = documents(
        spark,
        {
            "a": TEXT_A,
            "b": TEXT_B,
            "c": text_c(),
            "c no load": text_c(load="pounds"),
            "a wrong": TEXT_A.replace("$2,310.40", "$0.00").replace("FAIL", "MAYBE"),
        },
    )
    rows = by_file(rv.evaluate(docs))
    assert not rows["a"].needs_review and rows["a"].reasons == []
    assert set(rows["a"].confidences.values()) == {1.0}
    assert not rows["c"].needs_review
    assert rows["c no load"].reasons == ["low-confidence/missing fields: capacity_lbs"]
    assert rows["c no load"].valid and rows["c no load"].confidences["capacity_lbs"] == 0.0
    assert rows["b"].reasons == [
        "routing: layout B detected correctly, but no parser exists yet",
        "low-confidence/missing fields: " + ", ".join(FIELDS_A),
    ]
    assert rows["b"].valid is None and set(rows["b"].confidences.values()) == {0.0}
    assert rows["a wrong"].reasons == [
        "validation: " + RESULT,
        "validation: invoice_total: Input should be greater than 0",
    ]
    # At threshold 0 a missing field is no reason; routing and validation still are.
    lenient = by_file(rv.evaluate(docs, threshold=0.0))
    assert not lenient["c no load"].needs_review and lenient["b"].needs_review
    assert lenient["a wrong"].needs_review
