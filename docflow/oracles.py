"""DuckDB SQL for every registered query.

Expected values are computed from the tables alone: no oracle looks into a
rendered text, except that request keys are hashes of one.
"""

from __future__ import annotations

import hashlib

from docflow.catalog import GAPS
from docflow.certificate import CERTIFICATES

NAMES = CERTIFICATES.names

# What each certificate says, and what can be extracted from it (f_ columns).
_BASE = """
src AS (
  SELECT o_orderkey AS k, 'CRT-' || o_orderkey AS file, o_orderstatus AS st,
         o_orderpriority AS prio, o_totalprice AS price, CAST(o_orderdate AS DATE) AS d,
         c_custkey, c_name, n_name, substr(r_name, 1, 2) AS r2,
         CASE WHEN o_orderkey % 8 <= 2 THEN 'A' WHEN o_orderkey % 8 <= 5 THEN 'C'
              WHEN o_orderkey % 8 = 6 THEN 'B' WHEN o_orderkey % 16 = 15 THEN 'both'
              ELSE 'none' END AS template
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
written AS (
  SELECT *, template IN ('A', 'C') AS parsed,
    template = 'A' OR (template = 'C' AND length(r2) = 2) AS found,
    CASE WHEN template IN ('A', 'B', 'C') THEN template END AS layout,
    CASE template WHEN 'none' THEN 'unknown' WHEN 'both' THEN 'ambiguous' ELSE 'ok' END AS status,
    substr('ABCDE', CAST(k % 5 + 1 AS INT), 1) || (k % 97 + 1) || '-' || (k % 7 + 1) AS unit,
    CASE k % 4 WHEN 0 THEN 'Traction Passenger' WHEN 1 THEN 'Hydraulic Passenger'
               WHEN 2 THEN 'Freight' ELSE 'Escalator' END AS utype,
    CASE WHEN template = 'C' AND k % 3 = 0 THEN NULL WHEN k % 89 = 0 THEN 0
         ELSE (k % 7 + 1) * 500 END AS capacity,
    CASE WHEN k % 97 = 0 THEN d ELSE d + 365 END AS due,
    CASE WHEN k % 107 = 0 THEN 'DEFERRED' WHEN st = 'F' THEN 'FAIL' WHEN st = 'O' THEN 'PASS'
         ELSE 'PASS WITH DEFECTS' END AS outcome,
    CAST(CASE st WHEN 'F' THEN k % 4 WHEN 'O' THEN 0 ELSE k % 3 + 1 END AS BIGINT) AS defects
  FROM src
),
fields AS (
  SELECT k, file, st, prio, layout, status, template, parsed,
    COALESCE(layout, upper(status)) AS detected,
    CASE status WHEN 'unknown' THEN 'unknown: matched markers = none'
      WHEN 'ambiguous' THEN 'ambiguous: matched markers = (''A'', ''B'')'
      ELSE CASE WHEN parsed THEN 'routed to layout ' || layout || ' parser'
        ELSE 'layout ' || layout || ' detected correctly, but no parser exists yet' END
    END AS note,
    CASE WHEN parsed THEN file END AS cert_no,
    CASE WHEN parsed AND (template = 'A' OR k % 101 <> 0) THEN unit END AS unit_id,
    CASE WHEN parsed AND k % 101 <> 0 THEN c_name END AS building,
    CASE WHEN found AND n_name <> '' THEN n_name WHEN found AND template = 'C' THEN ' ' END AS city,
    CASE WHEN found THEN r2 END AS state,
    CASE WHEN parsed THEN utype END AS unit_type,
    CAST(CASE WHEN found THEN capacity END AS BIGINT) AS capacity_lbs,
    CASE WHEN parsed AND k % 103 <> 0 THEN d END AS inspection_date,
    CASE WHEN parsed THEN CAST(due AS DATE) END AS next_due,
    CASE WHEN parsed THEN 'S. Name' || c_custkey END AS inspector,
    CASE WHEN parsed THEN outcome END AS result,
    CASE WHEN parsed THEN price END AS invoice_total,
    CASE WHEN parsed THEN defects END AS defect_count
  FROM written
)"""


def _each(template: str, separator: str = ", ") -> str:
    return separator.join(template.format(name) for name in NAMES)


def _present(*values: str) -> str:
    return f"list_filter([{', '.join(values)}], lambda x: x IS NOT NULL)"


_MISSING = _present(*[f"CASE WHEN {name} IS NULL THEN '{name}' END" for name in NAMES])

_JUDGED = (
    _BASE
    + f""",
faults AS (
  SELECT *, {_MISSING} AS missing,
    {_present(
        "CASE WHEN unit_id IS NULL THEN 'unit_id: Input should be a valid string' END",
        "CASE WHEN building IS NULL THEN 'building: Input should be a valid string' END",
        "CASE WHEN city IS NULL THEN 'city: Input should be a valid string' END",
        "CASE WHEN state IS NULL THEN 'state: Input should be a valid string' "
        "WHEN length(state) < 2 THEN 'state: String should have at least 2 characters' "
        "WHEN length(state) > 2 THEN 'state: String should have at most 2 characters' END",
        "CASE WHEN capacity_lbs <= 0 THEN 'capacity_lbs: Input should be greater than 0' END",
        "CASE WHEN inspection_date IS NULL THEN 'inspection_date: Input should be a valid date' END",
        "CASE WHEN result = 'DEFERRED' THEN 'result: Input should be ''PASS'', ''FAIL'' or ''PASS WITH DEFECTS''' END",
    )} AS field_errors,
    concat_ws('; ',
      CASE WHEN next_due <= inspection_date THEN 'next_due (' || next_due
        || ') must be later than inspection_date (' || inspection_date || ')' END,
      CASE WHEN result = 'FAIL' AND defect_count = 0 THEN 'result is FAIL but defect_count is 0 '
        || '-- contradictory, a failed inspection must list at least one defect' END) AS crossed
  FROM fields
),
checked AS (
  SELECT *, CASE WHEN NOT parsed THEN NULL WHEN len(field_errors) > 0 THEN field_errors
    WHEN crossed <> '' THEN ['<model>: Value error, ' || crossed]
    ELSE CAST([] AS VARCHAR[]) END AS errors
  FROM faults
),
judged AS (
  SELECT *, len(errors) = 0 AS valid,
    list_concat({_present(
        "CASE WHEN NOT parsed THEN 'routing: ' || note END",
        "CASE WHEN len(missing) > 0 THEN 'low-confidence/missing fields: ' || array_to_string(missing, ', ') END",
    )}, list_transform(COALESCE(errors, CAST([] AS VARCHAR[])), lambda e: 'validation: ' || e)) AS reasons
  FROM checked
)"""
)

# The same with states of one to three letters and blank cities.
_LENGTHS = _JUDGED.replace(
    "c_name, n_name, substr(r_name, 1, 2) AS r2",
    """c_name, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE n_name END AS n_name,
         CASE o_orderkey % 3 WHEN 0 THEN substr(r_name, 1, 1) WHEN 1 THEN substr(r_name, 1, 2) || 'X'
           ELSE substr(r_name, 1, 2) END AS r2""",
)

_QUEUE = """SELECT file, layout, note, len(reasons) > 0 AS needs_review,
  array_to_string(missing, ' | ') AS low_confidence,
  array_to_string(reasons, ' | ') AS reasons FROM judged"""

# The answer key as typed values (t_ columns): finished orders, and one absent
# document per supplier.
_KEY = """,
key_rows AS (
  SELECT k, file,
    CASE WHEN k % 17 = 0 THEN 'B' WHEN template IN ('A', 'B', 'C') THEN template ELSE 'A' END AS key_layout,
    file AS t_cert_no, unit AS t_unit_id,
    CASE WHEN k % 101 <> 0 THEN c_name END AS t_building,
    CASE WHEN k % 11 = 0 THEN 'Elsewhere' ELSE n_name END AS t_city,
    r2 AS t_state, utype AS t_unit_type,
    CAST(CASE WHEN k % 19 <> 0 THEN capacity END AS BIGINT) AS t_capacity_lbs,
    CASE WHEN k % 103 <> 0 THEN d END AS t_inspection_date,
    CAST(due AS DATE) AS t_next_due, 'S. Name' || c_custkey AS t_inspector,
    outcome AS t_result, CASE WHEN k % 13 <> 0 THEN price END AS t_invoice_total,
    defects AS t_defect_count
  FROM written WHERE st <> 'P'
),
absent AS (SELECT 'CRT-S' || s_suppkey AS file FROM supplier)"""

_SCORED = (
    _BASE
    + _KEY
    + f""",
scored AS (
  SELECT f.*, key_layout, {_each('t_{0}')} FROM fields f JOIN key_rows USING (file)
)"""
)

_ROUTING = (
    _BASE
    + _KEY
    + """,
routing AS (
  SELECT f.file, f.layout, f.detected, f.note, r.key_layout AS expected,
    f.status <> 'ok' OR (r.key_layout IS NOT NULL AND f.layout IS DISTINCT FROM r.key_layout)
      AS misrouted_vs_truth
  FROM fields f LEFT JOIN key_rows r USING (file)
)"""
)

_HITS = " UNION ALL ".join(
    f"SELECT key_layout AS layout, '{name}' AS field, "
    f"CAST({name} IS NOT DISTINCT FROM t_{name} AS BIGINT) AS hit FROM scored WHERE parsed"
    for name in NAMES
)
_WRONG = " UNION ALL ".join(
    f"SELECT file, key_layout AS layout, '{name}' AS field, CAST(t_{name} AS VARCHAR) AS expected, "
    f"CAST({name} AS VARCHAR) AS actual FROM scored WHERE parsed AND {name} IS DISTINCT FROM t_{name}"
    for name in NAMES
)


def _long(source: str, columns: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}, '{name}' AS field, {value.format(name)} FROM {source}" for name in NAMES
    )


_ENTERED = {
    "capacity_lbs": "COALESCE(CAST(capacity_lbs AS VARCHAR), CAST(k % 4 * 500 + 1000 AS VARCHAR))",
    "inspection_date": "COALESCE(CAST(inspection_date AS VARCHAR), '2024-01-15')",
    "result": "CASE result WHEN 'DEFERRED' THEN 'FAIL' ELSE result END",
}
_ENTRIES = (
    _JUDGED
    + ", shown AS ("
    + " UNION ALL ".join(
        f"SELECT file, prio, '{name}' AS field, CAST({name} AS VARCHAR) AS old_value, "
        f"{_ENTERED.get(name, f'CAST({name} AS VARCHAR)')} AS new_value "
        "FROM judged WHERE len(reasons) > 0"
        for name in NAMES
    )
    + """), entries AS (
  SELECT file, prio, field, old_value, new_value,
    CASE WHEN old_value IS NOT DISTINCT FROM new_value THEN 'approve' ELSE 'correct' END AS action
  FROM shown
)"""
)

_TEXT_C = """
'HARBOUR LIFT INSPECTORS' || chr(10) || 'The conveyance identified below was examined on '
|| CASE WHEN k % 103 = 0 THEN '02/30/' || year(d) ELSE strftime(d, '%m/%d/%Y') END
|| ' by S. Name' || c_custkey || ', acting as '
|| CASE WHEN k % 2 = 0 THEN 'an' || chr(10) || 'authorized inspector'
        ELSE 'an authorized' || chr(10) || 'inspector' END
|| ' of the port. The papers lie in the harbour office, under' || chr(10) || 'reference '
|| file || ' and supersedes what lay there.' || chr(10) || 'Premises: '
|| CASE WHEN k % 101 = 0 THEN '' ELSE c_name || ' ' END || 'Equipment No.: ' || unit || chr(10)
|| 'Berth: Pier Rd Classification: ' || utype || chr(10)
|| 'Municipality: ' || n_name || ', ' || r2 || ' Rated Load: '
|| COALESCE(capacity || ' ', '') || 'pounds' || chr(10) || 'Desk: 14 Outcome: ' || outcome
|| chr(10) || 'Fees in total $' || format('{:,.2f}', price)
|| ', due at the harbour desk. Re-examination shall occur '
|| CASE WHEN k % 2 = 0 THEN 'no' || chr(10) || 'later than' ELSE 'no later' || chr(10) || 'than' END
|| ' ' || strftime(due, '%m/%d/%Y') || '.' || chr(10)
|| CASE WHEN defects > 0 THEN 'Items requiring corrective action:' || chr(10)
     || repeat('(cid:127) Governor out of tolerance' || chr(10), defects) ELSE '' END
|| 'Rendered from the orders table.' || chr(10)
"""

_VERSION = hashlib.sha256(GAPS.prompt.encode("utf-8")).hexdigest()

_ASKED = (
    _BASE
    + _KEY
    + f""",
lacking AS (
  SELECT f.*, {_MISSING} AS missing, {_TEXT_C} AS doc
  FROM fields f JOIN (SELECT k, d, c_custkey, c_name, n_name, r2, unit, utype, capacity, price,
    due, outcome, defects FROM written) USING (k)
  WHERE f.layout = 'C'
),
asked AS (
  SELECT *, len(missing) > 0 AS called,
    CASE WHEN len(missing) > 0 THEN sha256('{GAPS.model}#{_VERSION}#'
      || array_to_string(list_sort(missing), ',') || '#' || doc) END AS key,
    CASE WHEN len(missing) > 0 THEN (400 + k % 100) / 1e6 * 5 + 20 / 1e6 * 25 ELSE 0 END AS cost,
    CASE WHEN capacity_lbs IS NULL AND k % 2 = 0 THEN k % 5 * 500 + 1000 END AS a_capacity_lbs,
    CASE WHEN building IS NULL THEN 'Hall ' || k END AS a_building,
    CASE WHEN inspection_date IS NULL AND k % 2 = 0 THEN DATE '2024-02-29' END AS a_inspection_date
  FROM lacking
),
filled AS (
  SELECT *, {_present(
      "CASE WHEN a_building IS NOT NULL THEN 'building' END",
      "CASE WHEN a_capacity_lbs IS NOT NULL THEN 'capacity_lbs' END",
      "CASE WHEN a_inspection_date IS NOT NULL THEN 'inspection_date' END",
  )} AS given,
    COALESCE(capacity_lbs, CAST(a_capacity_lbs AS BIGINT)) AS m_capacity_lbs,
    COALESCE(building, a_building) AS m_building,
    COALESCE(inspection_date, a_inspection_date) AS m_inspection_date
  FROM asked
)"""
)

_GAPPED = ("capacity_lbs", "building", "inspection_date")
_AFTER = {name: f"m_{name}" if name in _GAPPED else name for name in NAMES}
_MERGED = ", ".join(f"{column} AS {name}" for name, column in _AFTER.items())


def _outcome_sql(from_cache: str, cost: str) -> str:
    return f"""SELECT file, {_MERGED}, called, {from_cache} AS from_cache,
      round({cost}, 8) AS cost_usd, array_to_string(missing, ' | ') AS fields_requested,
      array_to_string(given, ' | ') AS fields_filled FROM filled"""


def _score(columns: dict[str, str]) -> str:
    hits = " + ".join(
        f"CAST({column} IS NOT DISTINCT FROM t_{name} AS BIGINT)" for name, column in columns.items()
    )
    return f"CAST(SUM({hits}) AS BIGINT)"


_JSON_TYPES = {
    f.name: {
        "string": '{"type":["string","null"]}',
        "bigint": '{"type":["integer","null"]}',
        "double": '{"type":["number","null"]}',
        "date": '{"type":["string","null"],"format":"date"}',
    }[f.dtype]
    for f in CERTIFICATES.fields
}
_PROPERTIES = " ".join(f"WHEN '{n}' THEN '\"{n}\":{t}'" for n, t in _JSON_TYPES.items())

# Query -> (common table expressions, select)
_PARTS: dict[str, tuple[str, str]] = {
    "assembled_documents": (
        "",
        "SELECT conv_id AS file, string_agg(COALESCE(text, ''), chr(10) || chr(10) ORDER BY turn) "
        "AS text FROM conversations GROUP BY conv_id",
    ),
    "truth_from_csv": (
        _BASE + _KEY,
        f"SELECT file, key_layout AS layout, {_each('t_{0} AS {0}')} FROM key_rows UNION ALL "
        f"SELECT file, 'A', {_each('NULL')} FROM absent",
    ),
    "truth_layouts_from_csv": (
        _BASE + _KEY,
        "SELECT file, key_layout AS layout FROM key_rows UNION ALL SELECT file, 'A' FROM absent",
    ),
    "truth_unreadable": (
        _BASE + _KEY,
        "SELECT file, 'capacity_lbs' AS field, 'n/a' AS value FROM key_rows WHERE k % 19 = 0",
    ),
    "truth_by_header": (
        _BASE + _KEY,
        f"SELECT file, key_layout AS layout, {_each('t_{0} AS {0}')} FROM key_rows UNION ALL "
        f"SELECT file, 'A', {_each('NULL')} FROM absent",
    ),
    "corpus_from_files": (
        "",
        "SELECT 'Räume + ' || source AS folder, sha256(COALESCE(text, '')) AS text_sha256, "
        "CAST(1 AS BIGINT) AS namesakes FROM documents",
    ),
    "classified_documents": (
        _BASE,
        "SELECT file, layout, status, detected, CASE template WHEN 'none' THEN '' "
        "WHEN 'both' THEN 'A | B' ELSE template END AS matched FROM fields",
    ),
    "classify_counts": (
        _BASE,
        "SELECT detected, COUNT(*) AS documents FROM fields GROUP BY detected",
    ),
    "marked_layout_a": (_BASE, "SELECT file FROM fields WHERE template IN ('A', 'both')"),
    "route_documents": (
        _BASE,
        "SELECT file, layout, status, NOT parsed AS no_extraction, note FROM fields",
    ),
    "extract_layout_a": (_BASE, f"SELECT file, {_each('{0}')} FROM fields WHERE layout = 'A'"),
    "extract_layout_c": (_BASE, f"SELECT file, {_each('{0}')} FROM fields WHERE layout = 'C'"),
    "parse_all_as_layout_a": (
        _BASE,
        """SELECT file, CASE WHEN a THEN file END AS cert_no,
        CASE WHEN a OR template = 'none' THEN unit END AS unit_id,
        CASE WHEN a AND k % 101 <> 0 THEN c_name END AS building,
        CASE WHEN a THEN n_name END AS city, CASE WHEN a THEN r2 END AS state,
        CASE WHEN a THEN utype END AS unit_type, CAST(CASE WHEN a THEN capacity END AS BIGINT) AS capacity_lbs,
        CASE WHEN a AND k % 103 <> 0 THEN d END AS inspection_date,
        CASE WHEN a THEN CAST(due AS DATE) END AS next_due,
        CASE WHEN a THEN 'S. Name' || c_custkey END AS inspector,
        CASE WHEN a OR template = 'B' THEN outcome END AS result,
        CASE WHEN a THEN price END AS invoice_total, CASE WHEN a THEN defects ELSE 0 END AS defect_count
        FROM (SELECT *, template IN ('A', 'both') AS a FROM written)""",
    ),
    "section_counts": (_BASE, "SELECT file, detected, defect_count FROM fields"),
    "extracted_fields_long": (
        _BASE,
        _long("fields", "file", "CAST({0} AS VARCHAR) AS value"),
    ),
    "foreign_documents": (
        "",
        f"""SELECT CAST(doc_id AS VARCHAR) AS file, 'UNKNOWN' AS detected, TRUE AS needs_review,
        'routing: unknown: matched markers = none | low-confidence/missing fields: '
        || '{", ".join(NAMES)}' AS reasons FROM documents""",
    ),
    "validate_documents": (
        _JUDGED,
        "SELECT file, detected, CASE WHEN NOT parsed THEN 'skipped' WHEN valid THEN 'valid' "
        "ELSE 'INVALID' END AS status, array_to_string(errors, ' | ') AS errors FROM judged",
    ),
    "validate_lengths": (
        _LENGTHS,
        "SELECT file, detected, CASE WHEN NOT parsed THEN 'skipped' WHEN valid THEN 'valid' "
        "ELSE 'INVALID' END AS status, array_to_string(errors, ' | ') AS errors FROM judged",
    ),
    "validation_counts": (
        _JUDGED,
        "SELECT COUNT(*) FILTER (valid) AS valid, COUNT(*) FILTER (NOT valid) AS invalid, "
        "COUNT(*) FILTER (NOT parsed) AS skipped FROM judged",
    ),
    "validation_errors": (
        _JUDGED,
        "SELECT file, unnest(errors) AS error FROM judged WHERE NOT valid",
    ),
    "field_confidences_long": (
        _BASE,
        _long("fields", "file", "CASE WHEN {0} IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS score"),
    ),
    "confidence_maps": (
        _BASE,
        "SELECT file, array_to_string("
        + _present(*[f"CASE WHEN {name} IS NOT NULL THEN '{name}' END" for name in NAMES])
        + ", ',') AS found FROM fields",
    ),
    "evaluated_documents": (_JUDGED, _QUEUE),
    "evaluated_without_threshold": (
        _JUDGED,
        """SELECT file, layout, note, NOT parsed OR NOT valid AS needs_review, '' AS low_confidence,
        array_to_string(list_filter(reasons, lambda r: NOT starts_with(r, 'low-')), ' | ') AS reasons
        FROM judged""",
    ),
    "review_queue": (_JUDGED, _QUEUE + " WHERE len(reasons) > 0"),
    "clean_documents": (_JUDGED, f"SELECT file, {_each('{0}')} FROM judged WHERE len(reasons) = 0"),
    "review_summary": (
        _JUDGED,
        "SELECT COUNT(*) AS documents, COUNT(*) FILTER (len(reasons) = 0) AS clean, "
        "COUNT(*) FILTER (len(reasons) > 0) AS review FROM judged",
    ),
    "split_table": (
        _JUDGED,
        "SELECT CASE WHEN len(reasons) > 0 THEN 'review' ELSE 'clean' END AS queue, detected, "
        "COUNT(*) AS documents FROM judged "
        "GROUP BY ALL",
    ),
    "routing_report": (
        _ROUTING,
        "SELECT file, detected, expected, misrouted_vs_truth FROM routing",
    ),
    "routing_accuracy": (
        _ROUTING,
        "SELECT COUNT(*) FILTER (layout = expected) AS correct, COUNT(expected) AS scored, "
        "COUNT(*) FILTER (layout = expected) / COUNT(expected) AS accuracy FROM routing",
    ),
    "misrouted_documents": (
        _ROUTING,
        "SELECT file, detected, expected, note FROM routing WHERE misrouted_vs_truth",
    ),
    "accuracy_by_field": (
        _SCORED,
        "SELECT layout, field, CAST(SUM(hit) AS BIGINT) AS correct, COUNT(*) AS total, "
        f"SUM(hit) / COUNT(*) AS accuracy FROM ({_HITS}) GROUP BY ROLLUP (layout, field)",
    ),
    "accuracy_overall": (
        _SCORED,
        "SELECT CAST(SUM(hit) AS BIGINT) AS correct, COUNT(*) AS total, "
        f"SUM(hit) / COUNT(*) AS accuracy FROM ({_HITS})",
    ),
    "accuracy_mismatches": (_SCORED, _WRONG),
    "skipped_by_layout": (
        _SCORED,
        "SELECT key_layout AS layout, COUNT(*) AS documents FROM scored WHERE NOT parsed "
        "GROUP BY key_layout",
    ),
    "accuracy_report": (
        _SCORED,
        f"""SELECT 'accuracy' AS part, layout, field, NULL AS file, NULL AS expected, NULL AS actual,
          CAST(SUM(hit) AS BIGINT) AS correct, COUNT(*) AS total, SUM(hit) / COUNT(*) AS accuracy
        FROM ({_HITS}) GROUP BY ROLLUP (layout, field)
        UNION ALL SELECT 'overall', NULL, NULL, NULL, NULL, NULL, CAST(SUM(hit) AS BIGINT), COUNT(*),
          SUM(hit) / COUNT(*) FROM ({_HITS})
        UNION ALL SELECT 'skipped', key_layout, NULL, NULL, NULL, NULL, NULL, COUNT(*), NULL
        FROM scored WHERE NOT parsed GROUP BY key_layout
        UNION ALL SELECT 'mismatches', layout, field, file, expected, actual, NULL, NULL, NULL FROM ({_WRONG})
        UNION ALL SELECT 'rejects', NULL, 'capacity_lbs', file, NULL, 'n/a', NULL, NULL, NULL
        FROM key_rows WHERE k % 19 = 0
        UNION ALL SELECT 'absent', 'A', NULL, file, NULL, NULL, NULL, NULL, NULL FROM absent""",
    ),
    "repeated_names": (
        _JUDGED + _KEY,
        f"""SELECT 'scored' AS part, NULL AS file, {len(NAMES)} * COUNT(*) AS n
        FROM fields f JOIN key_rows USING (file) WHERE f.parsed AND f.k % 10 <> 0
        UNION ALL SELECT 'not scored', file, 2 FROM key_rows WHERE k % 10 = 0
        UNION ALL SELECT CASE WHEN k % 10 = 0 THEN 'not reviewed' ELSE 'reviewed' END, file,
          CASE WHEN k % 10 = 0 THEN 2 ELSE {len(NAMES)} END FROM judged WHERE len(reasons) > 0""",
    ),
    "truth_without_document": (_BASE + _KEY, "SELECT file, 'A' AS layout FROM absent"),
    "audit_record_review": (
        _ENTRIES,
        "SELECT 'reviewer one' AS reviewer, file, field, action, old_value, new_value FROM entries",
    ),
    "audit_counts": (
        _ENTRIES,
        "SELECT file, '2024-03-01T09:00:00.000000+00:00' AS timestamp, "
        "COUNT(*) FILTER (action = 'approve') AS approved, "
        "COUNT(*) FILTER (action = 'correct') AS corrected FROM entries GROUP BY file",
    ),
    "audit_status": (
        _JUDGED,
        "SELECT file, detected, CASE WHEN prio IN ('1-URGENT', '2-HIGH') "
        "THEN 'reviewed' ELSE 'pending' END AS state FROM judged WHERE len(reasons) > 0",
    ),
    "audit_history": (
        _ENTRIES,
        "SELECT '2024-03-' || day || 'T09:00:00.000000+00:00' AS timestamp, reviewer, file, field, "
        "action, old_value, new_value FROM entries CROSS JOIN (VALUES ('01', 'reviewer one'), "
        "('02', 'reviewer two')) v(day, reviewer)",
    ),
    "audit_of_a_day": (
        _ENTRIES,
        "SELECT '2024-03-02T09:00:00.000000+00:00' AS timestamp, 'reviewer two' AS reviewer, file, field, "
        "action, old_value, new_value FROM entries",
    ),
    "document_history": (
        _ENTRIES,
        f"""SELECT '2024-03-' || day || 'T09:00:00.000000+00:00' AS timestamp, reviewer, file, field, action,
          old_value, new_value, day_place * {len(NAMES)} + list_position({list(NAMES)}, field) - 1 AS place
        FROM entries CROSS JOIN (VALUES ('01', 0, 'reviewer one'), ('02', 1, 'reviewer two')) v(day, day_place, reviewer)
        WHERE file = (SELECT min(file) FROM entries)""",
    ),
    "fallback_shared_keys": (
        _ASKED + ", named AS (SELECT *, file AS name, FALSE AS copied FROM filled UNION ALL "
        "SELECT *, file || '-copy', TRUE FROM filled WHERE k % 2 = 0)",
        f"""SELECT name AS file, {_MERGED}, called, {{}} AS from_cache, round({{}}, 8) AS cost_usd,
          array_to_string(missing, ' | ') AS fields_requested, array_to_string(given, ' | ') AS fields_filled,
          {{}} AS run FROM named""".format("called AND copied", "CASE WHEN copied THEN 0 ELSE cost END", 1)
        + " UNION ALL "
        + f"""SELECT name AS file, {_MERGED}, called, called AS from_cache, 0.0::DOUBLE AS cost_usd,
          array_to_string(missing, ' | '), array_to_string(given, ' | '), 2 FROM named WHERE copied""",
    ),
    "fallback_latency": (
        _ASKED,
        """SELECT COUNT(*) FILTER (called) AS needing, COUNT(*) FILTER (called AND f.k % 2 = 0) AS cache_hits,
          COUNT(*) FILTER (called AND f.k % 2 = 1) AS fresh_calls,
          round(SUM(CASE WHEN called AND f.k % 2 = 1 THEN f.k % 4 / 1000 ELSE 0 END), 8) AS total_cost_usd,
          AVG(f.k % 8 / 4) FILTER (called AND f.k % 2 = 1) AS mean_fresh_latency_seconds
        FROM key_rows r LEFT JOIN filled f USING (file) WHERE r.key_layout = 'C'""",
    ),
    "fallback_with_failures": (
        _ASKED,
        _outcome_sql("called AND k % 3 <> 0", "CASE WHEN k % 3 = 0 THEN cost ELSE 0 END"),
    ),
    "fallback_requests": (
        _ASKED,
        "SELECT file, array_to_string(missing, ' | ') AS missing, key FROM asked",
    ),
    "fallback_schemas": (
        _ASKED,
        f"""SELECT '{{"type":"object","properties":{{' || array_to_string(list_transform(missing,
        lambda m: CASE m {_PROPERTIES} END), ',') || '}},"required":["'
        || array_to_string(missing, '","') || '"],"additionalProperties":false}}' AS schema,
        COUNT(*) AS requests FROM asked WHERE called GROUP BY 1""",
    ),
    "fallback_pending": (
        _ASKED,
        "SELECT file, key FROM asked WHERE called AND building IS NOT NULL",
    ),
    "fallback_answers": (
        _ASKED,
        "SELECT key, 400 + k % 100 AS input_tokens, CAST(20 AS BIGINT) AS output_tokens, "
        "round(cost, 8) AS cost_usd, CAST(a_capacity_lbs AS BIGINT) AS capacity_lbs, "
        "a_building AS building, a_inspection_date AS inspection_date FROM asked WHERE called",
    ),
    "fallback_outcome": (_ASKED, _outcome_sql("FALSE", "cost")),
    "fallback_rerun": (_ASKED, _outcome_sql("called", "0.0::DOUBLE")),
    "fallback_report": (
        _ASKED,
        f"""SELECT COUNT(*) AS documents, COUNT(*) FILTER (called IS NULL) AS without_extraction,
        COUNT(*) FILTER (called) AS needing, CAST(0 AS BIGINT) AS cache_hits,
        COUNT(*) FILTER (called) AS fresh_calls, 13 * COUNT(called) AS fields,
        {_score({name: name for name in NAMES})} AS correct_before,
        {_score(_AFTER)} AS correct_after,
        round(SUM(cost), 8) AS total_cost_usd,
        {_score({name: name for name in NAMES})} / (13 * COUNT(called)) AS accuracy_before,
        {_score(_AFTER)} / (13 * COUNT(called)) AS accuracy_after,
        round(SUM(cost) / COUNT(*) FILTER (called), 8) AS cost_per_needing_usd,
        round(SUM(cost) / COUNT(*), 8) AS cost_per_document_usd
        FROM key_rows r LEFT JOIN filled USING (file) WHERE r.key_layout = 'C'""",
    ),
}


def by_name() -> dict[str, str]:
    return {
        name: f"WITH {tables} {select}" if tables else select
        for name, (tables, select) in _PARTS.items()
    }
