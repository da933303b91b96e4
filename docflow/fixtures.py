"""Certificates rendered from the test tables, for tests, queries and the benchmark.

The test tables hold no certificates, so one is rendered per order, as a pure
function of the order's key and its customer. Expected values can therefore be
computed from the tables without ever looking at a text. Faults are planted by
key; see ``FACTS``.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES, MARKER_A, MARKER_B, MARKER_C
from docflow.operators.frames import settled
from docflow.sources.documents import spread, tasks_for

FOOTER = "Rendered from the orders table.\n"


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


# What each certificate says, as written on it; null means that it is not written.
# ``template`` is A, B or C, or ``none`` (no marker) or ``both`` (two markers).
TEMPLATE = """CASE WHEN k % 8 <= 2 THEN 'A' WHEN k % 8 <= 5 THEN 'C' WHEN k % 8 = 6 THEN 'B'
  WHEN k % 16 = 15 THEN 'both' ELSE 'none' END"""
FACTS = {
    "file": "concat('CRT-', k)",
    "cert_no": "concat('CRT-', k)",
    "unit_id": "concat(substring('ABCDE', cast(k % 5 + 1 AS int), 1), k % 97 + 1, '-', k % 7 + 1)",
    "building": "CASE WHEN k % 101 <> 0 THEN c_name END",
    "city": "n_name",
    "state": "substring(r_name, 1, 2)",
    "unit_type": """CASE k % 4 WHEN 0 THEN 'Traction Passenger' WHEN 1 THEN 'Hydraulic Passenger'
      WHEN 2 THEN 'Freight' ELSE 'Escalator' END""",
    "capacity_lbs": """cast(CASE WHEN template = 'C' AND k % 3 = 0 THEN NULL
      WHEN k % 89 = 0 THEN 0 ELSE (k % 7 + 1) * 500 END AS string)""",
    "inspection_date": """CASE WHEN k % 103 = 0 THEN concat('02/30/', year(day))
      ELSE date_format(day, 'MM/dd/yyyy') END""",
    "next_due": """date_format(CASE WHEN k % 97 = 0 THEN day ELSE date_add(day, 365) END,
      'MM/dd/yyyy')""",
    "inspector": "concat('S. Name', c_custkey)",
    "result": """CASE WHEN k % 107 = 0 THEN 'DEFERRED' WHEN o_orderstatus = 'F' THEN 'FAIL'
      WHEN o_orderstatus = 'O' THEN 'PASS' ELSE 'PASS WITH DEFECTS' END""",
    "invoice_total": "format_number(o_totalprice, 2)",
    "defect_count": """cast(CASE o_orderstatus WHEN 'F' THEN k % 4 WHEN 'O' THEN 0
      ELSE k % 3 + 1 END AS int)""",
}


def certificate_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its key, status and priority, and what its certificate says.

    Certificates are many times as wide as the orders, so the joined rows are dealt by
    number: tasks of so many bytes of a join would hold ever more of them.
    """
    orders, customer, nation, region = tables(
        spark, sf_dir, "orders", "customer", "nation", "region"
    )
    joined = (
        orders.join(customer, F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
    )
    return (
        spread(joined, tasks_for(orders))
        .selectExpr("*", "o_orderkey AS k", "to_date(o_orderdate) AS day")
        .selectExpr("*", f"{TEMPLATE} AS template")
        .selectExpr(
            "k",
            "template",
            "o_orderstatus",
            "o_orderpriority",
            *[f"{expression} AS {name}" for name, expression in FACTS.items()],
        )
    )


# The documents. {name} is a fact or one of the pieces below; a piece that is null
# is left out, with its line.
TEXT_A = f"""HARBOUR LIFT INSPECTORS

{MARKER_A}

Certificate No:   {{cert_no}}
Unit ID:          {{unit_id}}
{{building_line}}Address:          {{street}}, {{city}}, {{state}} {{zip_code}}
Unit Type:        {{unit_type}}
Capacity (lbs):   {{capacity_lbs}}
Inspection Date:  {{inspection_date}}
Next Due:         {{next_due}}
Inspector:        {{inspector}}
Result:           {{result}}
Invoice Total:    ${{invoice_total}}

{{defects_a}}
{FOOTER}"""

TEXT_C = f"""HARBOUR LIFT INSPECTORS
{MARKER_C} {{inspection_date}} by {{inspector}}, acting as {{examiner}} of the port. The papers lie in the harbour office, under
reference {{cert_no}} and supersedes what lay there.
Premises: {{premises}}Equipment No.: {{unit_id}}
Berth: Pier Rd Classification: {{unit_type}}
Municipality: {{city}}, {{state}} Rated Load: {{load}}pounds
Desk: 14 Outcome: {{result}}
Fees in total ${{invoice_total}}, due at the harbour desk. Re-examination shall occur {{later}} {{next_due}}.
{{defects_c}}{FOOTER}"""

TEXT_B = f"{MARKER_B}\nUnit: {{unit_id}}\nResult: {{result}}"
TEXT_NONE = "Delivery note\n\nUnit ID: {unit_id}\n"

# The prose of layout C wraps one word earlier on even keys.
PIECES = {
    "building_line": r"concat('Building:         ', building, '\n')",
    "street": "concat(k % 900 + 1, ' Pier Rd')",
    "zip_code": "cast(10001 + k % 80000 AS string)",
    "premises": "concat(building, ' ')",
    "load": "concat(capacity_lbs, ' ')",
    "examiner": r"""CASE WHEN k % 2 = 0 THEN 'an\nauthorized inspector'
      ELSE 'an authorized\ninspector' END""",
    "later": r"CASE WHEN k % 2 = 0 THEN 'no\nlater than' ELSE 'no later\nthan' END",
    "defects_a": r"""CASE WHEN defect_count > 0 THEN concat('Defects Noted:\n\n',
      repeat('    - Governor out of tolerance\n', defect_count)) END""",
    "defects_c": r"""CASE WHEN defect_count > 0 THEN concat('Items requiring corrective action:\n',
      repeat('(cid:127) Governor out of tolerance\n', defect_count)) END""",
}


def _filled_in(template: str) -> str:
    """SQL expression of a template's text."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            quoted = literal.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
            parts.append(f"'{quoted}'")
        if name:
            parts.append(f"coalesce({PIECES.get(name, name)}, '')")
    return f"concat({', '.join(parts)})"


def render(facts: DataFrame) -> DataFrame:
    """``(file, text)`` of every certificate."""
    text_a, text_b = _filled_in(TEXT_A), _filled_in(TEXT_B)
    text = f"""CASE template WHEN 'A' THEN {text_a} WHEN 'C' THEN {_filled_in(TEXT_C)}
      WHEN 'B' THEN {text_b} WHEN 'both' THEN concat({text_a}, '\\n', {text_b})
      ELSE {_filled_in(TEXT_NONE)} END AS text"""
    # Settled, so that filters on the text are not moved into its rendering.
    return settled(facts.selectExpr("file", text))


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(certificate_facts(spark, sf_dir))


# The key's own faults: another layout, a wrong city, no invoice total, an
# unreadable capacity.
KEY = {
    "layout": """CASE WHEN k % 17 = 0 THEN 'B' WHEN template IN ('A', 'B', 'C') THEN template
      ELSE 'A' END""",
    "building": "coalesce(building, '')",
    "city": "CASE WHEN k % 11 = 0 THEN 'Elsewhere' ELSE city END",
    "capacity_lbs": "CASE WHEN k % 19 = 0 THEN 'n/a' ELSE coalesce(capacity_lbs, '') END",
    "inspection_date": "CASE WHEN k % 103 = 0 THEN '' ELSE inspection_date END",
    "invoice_total": "CASE WHEN k % 13 = 0 THEN '' ELSE replace(invoice_total, ',') END",
    "defect_count": "cast(defect_count AS string)",
}


def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of strings for the finished orders, with faults of its own.

    Orders still in progress are not in it, and every supplier has a row although
    no document is named after one.
    """
    columns = ["file", "layout", *CERTIFICATES.names]
    known = (
        certificate_facts(spark, sf_dir)
        .filter("o_orderstatus <> 'P'")
        .selectExpr(*[f"{KEY.get(name, name)} AS {name}" for name in columns])
    )
    (supplier,) = tables(spark, sf_dir, "supplier")
    absent = supplier.selectExpr(
        "concat('CRT-S', s_suppkey) AS file",
        "'A' AS layout",
        *[f"'' AS {name}" for name in CERTIFICATES.names],
    )
    return known.unionByName(absent)
