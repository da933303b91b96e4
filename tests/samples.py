"""Hand-written documents and records."""

from __future__ import annotations

from datetime import date

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from docflow.certificate import CERTIFICATES, MARKER_B

TEXT_A = """
TIDEWATER HOIST CO

Annual Safety Inspection Certificate

Certificate No:   TH-77-0001
Unit ID:          Q12-3
Building:         Lantern House
Address:          5 Quay Walk, Salem, MA 01970
Unit Type:        Freight
Capacity (lbs):   4500
Inspection Date:  03/09/2024
Next Due:         03/09/2025
Inspector:        I. Novak
Result:           FAIL
Invoice Total:    $2,310.40

Defects Noted:

    - Pit ladder loose
    - Oil leak at valve

Page ends
"""

TEXT_B = f"{MARKER_B}\nUnit: Q12-3\n"


def text_c(load: str = "2750 pounds", early: bool = True, premises: str = "Lantern House") -> str:
    examiner = "an\nauthorized inspector" if early else "an authorized\ninspector"
    later = "no\nlater than" if early else "no later\nthan"
    return (
        "TIDEWATER HOIST CO\n"
        "The conveyance identified below was examined on 05/21/2024 by I. Novak, acting as "
        f"{examiner} of this yard. Filed below\n"
        "reference TH-77-0002 and supersedes the sheet of last year.\n"
        f"Premises: {premises} Equipment No.: Q44-1\n"
        "Floor: 2 Classification: Escalator\n"
        f"Municipality: Salem, MA Rated Load: {load}\n"
        "Shift: 1 Outcome: PASS WITH DEFECTS\n"
        "In total $1,204.05 by bank draft. "
        f"Re-examination shall occur {later} 05/21/2025.\n"
        "Items requiring corrective action:\n"
        "(cid:127) Comb plate worn\n(cid:127) Skirt gap\n"
        "Page ends\n"
    )


FIELDS_A = dict(
    cert_no="TH-77-0001",
    unit_id="Q12-3",
    building="Lantern House",
    city="Salem",
    state="MA",
    unit_type="Freight",
    capacity_lbs=4500,
    inspection_date=date(2024, 3, 9),
    next_due=date(2025, 3, 9),
    inspector="I. Novak",
    result="FAIL",
    invoice_total=2310.40,
    defect_count=2,
)
FIELDS_C = dict(
    FIELDS_A,
    cert_no="TH-77-0002",
    unit_id="Q44-1",
    unit_type="Escalator",
    capacity_lbs=2750,
    inspection_date=date(2024, 5, 21),
    next_due=date(2025, 5, 21),
    result="PASS WITH DEFECTS",
    invoice_total=1204.05,
)

_TYPES = {"string": StringType(), "bigint": LongType(), "double": DoubleType(), "date": DateType()}
RECORD = StructType(
    [StructField("file", StringType())]
    + [StructField(f.name, _TYPES[f.dtype]) for f in CERTIFICATES.fields]
)


def records(spark, rows: dict[str, dict]):
    """A frame of records, one per name, each with all fields."""
    data = [(name, *[row.get(n) for n in CERTIFICATES.names]) for name, row in rows.items()]
    return spark.createDataFrame(data, RECORD)


def documents(spark, texts: dict[str, str]):
    return spark.createDataFrame(list(texts.items()), "file string, text string")


def by_file(frame) -> dict:
    return {row["file"]: row for row in frame.collect()}


def fields_of(row) -> dict:
    return {name: row[name] for name in CERTIFICATES.names}
