"""The specification for elevator inspection certificates: three layouts, 13 fields."""

from __future__ import annotations

from docflow.spec import Field, Layout, RecordCheck, Rule, SectionCount, Spec

# The certificate's fields and their constraints.
CERTIFICATE_FIELDS = (
    Field("cert_no", min_length=1),
    Field("unit_id", min_length=1),
    Field("building", min_length=1),
    Field("city", min_length=1),
    Field("state", min_length=2, max_length=2),
    Field("unit_type", min_length=1),
    Field("capacity_lbs", "bigint", required=False, gt=0),
    Field("inspection_date", "date"),
    Field("next_due", "date"),
    Field("inspector", min_length=1),
    Field("result", choices=("PASS", "FAIL", "PASS WITH DEFECTS")),
    Field("invoice_total", "double", gt=0),
    Field("defect_count", "bigint", ge=0),
)

# Marker phrases, one per layout.
MARKER_A = "Annual Safety Inspection Certificate"
MARKER_B = "Conveyance Inspection Record - retain for jurisdiction audit"
MARKER_C = "The conveyance identified below was examined on"

# Section headings and the bullet line each section counts.
DEFECTS_A = ("Defects Noted:", r"^\s*-\s+.+$")
DEFECTS_C = ("Items requiring corrective action:", r"^\(cid:127\)\s+.+$")

# A free-text value must start on its label's own line. Were the gap allowed to
# cross the line end, a blank label would silently take the following line as
# its value; with this it yields null and the document goes to review.
FREE_TEXT = r"[^\S\n]*(\S.*?)[^\S\n]*$"


def _line(label: str, value: str) -> str:
    """A line holding ``label:`` and a value of a narrow form, nothing else."""
    return rf"^{label}:\s*{value}\s*$"


DATE = r"(\d{2}/\d{2}/\d{4})"
MONEY = r"\$([\d,]+\.\d{2})"

# The layouts' patterns, below and in layout C.
LAYOUT_A = Layout(
    "A",
    MARKER_A,
    rules=(
        Rule("cert_no", _line("Certificate No", r"(\S+)")),
        Rule("unit_id", _line("Unit ID", r"(\S+)")),
        Rule("building", "^Building:" + FREE_TEXT),
        Rule("city", "^Address:" + FREE_TEXT, part="city"),
        Rule("state", "^Address:" + FREE_TEXT, part="state"),
        Rule("unit_type", "^Unit Type:" + FREE_TEXT),
        Rule("capacity_lbs", _line(r"Capacity \(lbs\)", r"(\d+)")),
        Rule("inspection_date", _line("Inspection Date", DATE)),
        Rule("next_due", _line("Next Due", DATE)),
        Rule("inspector", "^Inspector:" + FREE_TEXT),
        Rule("result", "^Result:" + FREE_TEXT),
        Rule("invoice_total", _line("Invoice Total", MONEY)),
    ),
    counts=(SectionCount("defect_count", *DEFECTS_A),),
)

# Recognised, never parsed: the certificates of layout B always go to review.
LAYOUT_B = Layout("B", MARKER_B)

# Prose wraps at different words from one document to the next, so words are
# joined by any white space. Fields that share a pattern are found or lost
# together.
EXAMINED_C = (
    rf"examined\s+on\s+{DATE}\s+by\s+(.+?),"
    r"\s+acting\s+as\s+an\s+authorized\s+inspector"
)
PREMISES_C = r"Premises:\s*(.+?)\s+Equipment No\.:\s*(\S+)"
MUNICIPALITY_C = (
    r"Municipality:\s*(.+?),\s*([A-Za-z]{2})\s+"
    r"Rated Load:\s*(\d+)?\s*pounds"
)

LAYOUT_C = Layout(
    "C",
    MARKER_C,
    rules=(
        Rule("cert_no", r"reference\s+(\S+)\s+and\s+supersedes"),
        Rule("unit_id", PREMISES_C, group=2),
        Rule("building", PREMISES_C, group=1),
        Rule("city", MUNICIPALITY_C, group=1),
        Rule("state", MUNICIPALITY_C, group=2),
        Rule("unit_type", "Classification:" + FREE_TEXT),
        Rule("capacity_lbs", MUNICIPALITY_C, group=3),
        Rule("inspection_date", EXAMINED_C, group=1),
        Rule("next_due", rf"Re-examination shall occur no\s+later\s+than\s+{DATE}"),
        Rule("inspector", EXAMINED_C, group=2),
        Rule("result", "Outcome:" + FREE_TEXT),
        Rule("invoice_total", rf"total\s+{MONEY}"),
    ),
    counts=(SectionCount("defect_count", *DEFECTS_C),),
)

# The cross-field rules and their messages.
CERTIFICATE_CHECKS = (
    RecordCheck(
        violated="next_due <= inspection_date",
        message="concat('next_due (', next_due, ') must be later than "
        "inspection_date (', inspection_date, ')')",
    ),
    RecordCheck(
        violated="result = 'FAIL' AND defect_count = 0",
        message="'result is FAIL but defect_count is 0 -- contradictory, "
        "a failed inspection must list at least one defect'",
    ),
)

CERTIFICATES = Spec(CERTIFICATE_FIELDS, (LAYOUT_A, LAYOUT_B, LAYOUT_C), CERTIFICATE_CHECKS)
