from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES, MARKER_C
from docflow.functions import address_city, address_state, us_date
from docflow.operators import classify as cl
from docflow.operators import extract as ex
from docflow.operators import review as rv
from docflow.spec import Field, Layout, Rule, SectionCount, Spec
from samples import FIELDS_A, FIELDS_C, TEXT_A, TEXT_B, by_file, documents, fields_of, text_c

NOTHING = {name: None for name in CERTIFICATES.names}


def test_classification(spark):
    rows = by_file(
        cl.classify(
            documents(
                spark,
                {"a": TEXT_A, "b": TEXT_B, "c": text_c(), "none": "a letter", "two": TEXT_A + TEXT_B,
                 "null": None},
            )
        )
    )
    got = {f: (r.matched, r.layout, r.status, r.detected) for f, r in rows.items()}
    assert got == {
        "a": (["A"], "A", "ok", "A"),
        "b": (["B"], "B", "ok", "B"),
        "c": (["C"], "C", "ok", "C"),
        "none": ([], None, "unknown", "UNKNOWN"),
        "two": (["A", "B"], None, "ambiguous", "AMBIGUOUS"),
        "null": ([], None, "unknown", "UNKNOWN"),
    }


def test_routing_and_fields(spark):
    docs = documents(
        spark,
        {
            "a": TEXT_A,
            "a first line": TEXT_A[TEXT_A.index("Certificate No") :].replace(
                "Unit ID", "Annual Safety Inspection Certificate\nUnit ID"
            ),
            "a crlf": TEXT_A.replace("\n", "\r\n"),
            "a no defects": TEXT_A[: TEXT_A.index("Defects")],
            "b": TEXT_B,
            "c early": text_c(),
            "c late": text_c(early=False),
            "c no load": text_c(load="pounds"),
            "c comma load": text_c(load="3,500 pounds"),
            "two": TEXT_A + TEXT_B,
            "none": "a letter",
        },
    )
    rows = by_file(ex.route(docs))
    assert fields_of(rows["a"]) == FIELDS_A
    assert fields_of(rows["a first line"]) == FIELDS_A
    assert fields_of(rows["a crlf"]) == FIELDS_A
    assert fields_of(rows["a no defects"]) == {**FIELDS_A, "defect_count": 0}
    assert fields_of(rows["c early"]) == fields_of(rows["c late"]) == FIELDS_C
    assert fields_of(rows["c no load"]) == {**FIELDS_C, "capacity_lbs": None}
    # City, state and load are one pattern: they are lost together.
    lost = dict(city=None, state=None, capacity_lbs=None)
    assert fields_of(rows["c comma load"]) == {**FIELDS_C, **lost}
    for name in ("b", "two", "none"):
        assert fields_of(rows[name]) == NOTHING and rows[name].no_extraction
    assert rows["a"].note == "routed to layout A parser"
    assert rows["b"].note == "layout B detected correctly, but no parser exists yet"
    assert rows["two"].note == "ambiguous: matched markers = ('A', 'B')"
    assert rows["none"].note == "unknown: matched markers = none"

    only_c = by_file(ex.route(docs, layouts=("C",)))
    assert set(only_c) == {"c early", "c late", "c no load", "c comma load"}


def test_values_that_must_not_be_guessed(spark):
    def a(old: str, new: str) -> str:
        assert old in TEXT_A
        return TEXT_A.replace(old, new)

    docs = documents(
        spark,
        {
            "garbage": "this is nothing of the kind",
            "no capacity": a("Capacity (lbs):   4500\n", ""),
            "comma capacity": a("4500", "4,500"),
            "second capacity line": a("4500", "4,500\nCapacity (lbs):   4400"),
            "huge capacity": a("4500", "9" * 30),
            "impossible date": a("03/09/2024", "02/30/2024"),
            "swapped date": a("03/09/2024", "13/01/2024"),
            "year zero": a("03/09/2024", "03/09/0000"),
            # A blank label does not take the next line as its value.
            "blank building": a("Building:         Lantern House", "Building:   "),
            "blank result": a("Result:           FAIL", "Result:"),
            "short address": a("5 Quay Walk, Salem, MA 01970", "Salem, MA 01970"),
            "no state": a("Salem, MA 01970", "Salem, "),
            "no-break spaces": a("Lantern House", " Lantern House "),
            "next-line character": a("Lantern House", "Lantern\u0085House"),
            "indented label": a("Unit ID:", " Unit ID:"),
            "later bullets": a("Page ends", "- one more"),
        },
    )
    rows = by_file(ex.parse_as(docs, "A"))
    got = {
        name: {k: v for k, v in fields_of(row).items() if v != FIELDS_A[k]}
        for name, row in rows.items()
    }
    assert got == {
        "garbage": {**NOTHING, "defect_count": 0},
        "no capacity": {"capacity_lbs": None},
        "comma capacity": {"capacity_lbs": None},
        "second capacity line": {"capacity_lbs": 4400},
        "huge capacity": {"capacity_lbs": None},
        "impossible date": {"inspection_date": None},
        "swapped date": {"inspection_date": None},
        "year zero": {"inspection_date": None},
        "blank building": {"building": None},
        "blank result": {"result": None},
        "short address": {"city": None, "state": None},
        "no state": {"state": None},
        "no-break spaces": {"building": "Lantern House"},
        "next-line character": {"building": "Lantern\u0085House"},
        "indented label": {"unit_id": None},
        "later bullets": {"defect_count": 3},
    }


def test_address_and_date_functions(spark):
    lines = spark.createDataFrame(
        [("1 A St, Salem, MA 01970",), ("1 A St, Suite 2, Salem ,MA",), ("x,,",), ("x, ,\tMA 1",),
         ("Salem, MA",)],
        "line string",
    )
    got = lines.select(address_city(F.col("line")), address_state(F.col("line"))).collect()
    assert [tuple(r) for r in got] == [
        ("Salem", "MA"), ("Salem", "MA"), ("", ""), ("", "MA"), ("", ""),
    ]
    dates = spark.createDataFrame([("02/29/2024",), ("02/29/2023",), ("",), (None,)], "d string")
    assert [str(r[0]) for r in dates.select(us_date(F.col("d"))).collect()] == [
        "2024-02-29", "None", "None", "None",
    ]


def test_another_specification(spark):
    """Purchase orders: other fields, other layouts, no other code."""
    shared = r"^Order (\d+) of (\d{2}/\d{2}/\d{4})$"
    orders = Spec(
        fields=(Field("number", "bigint"), Field("day", "date"), Field("lines", "bigint", gt=0)),
        layouts=(
            Layout(
                "PO",
                "PURCHASE ORDER",
                rules=(Rule("number", shared, 1), Rule("day", shared, 2)),
                counts=(SectionCount("lines", "Items", r"^\* .+$"),),
            ),
            Layout("RFQ", "REQUEST FOR QUOTE", rules=(Rule("number", r"ref (\d+)"),)),
        ),
    )
    docs = documents(
        spark,
        {
            "po": "PURCHASE ORDER\nOrder 17 of 02/03/2024\nItems\n* bolt\n* nut",
            "rfq": "REQUEST FOR QUOTE ref 9",
        },
    )
    rows = by_file(rv.evaluate(docs, orders))
    assert (rows["po"].number, str(rows["po"].day), rows["po"].lines) == (17, "2024-02-03", 2)
    assert not rows["po"].needs_review
    assert rows["rfq"].reasons == [
        "low-confidence/missing fields: day, lines",
        "validation: day: Input should be a valid date",
        "validation: lines: Input should be a valid integer",
    ]


def test_specification_is_checked():
    with pytest.raises(ValueError, match="no such fields"):
        Spec((Field("a"),), (Layout("L", "m", rules=(Rule("b", "x(.)"),)),))
    with pytest.raises(ValueError, match="looks around"):
        Layout("L", "m", rules=(Rule("a", r"(x)(y)(?=z)", 1), Rule("b", r"(x)(y)(?=z)", 2)))
    with pytest.raises(ValueError, match="unique"):
        Spec((Field("a"), Field("a")), ())


def test_patterns_run_once_and_filters_stay_above(spark, tmp_path):
    """A filter on the decision must not pull copies of the patterns below."""
    path = str(tmp_path / "docs")
    documents(spark, {"a": TEXT_A, "c": text_c()}).write.parquet(path)
    evaluated = rv.evaluate(spark.read.parquet(path))

    def plan(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    for frame in (evaluated, rv.to_review(evaluated), rv.clean(evaluated).select("file", "city")):
        assert plan(frame).count("reference\\s+") == 1
        assert plan(frame).count("Municipality:") <= 4  # the match, and its three groups
        assert "Exchange" not in plan(frame)
    # Only what is asked for is read from the text.
    few = plan(ex.route(spark.read.parquet(path)).select("file", "cert_no"))
    assert "Municipality:" not in few and few.count("regexp_extract(") == 2
    assert plan(cl.layout_counts(cl.classify(spark.read.parquet(path)))).count("ReadSchema") == 1
    assert MARKER_C in few
