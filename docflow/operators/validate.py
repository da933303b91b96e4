"""Record validation: one message per faulty field, then the cross-field rules.

Faults are reported, never raised. Cross-field rules are judged only on records
whose every field is sound, and all that are broken come back in one message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.functions import present
from docflow.operators.frames import require_columns
from docflow.spec import Field, Spec

# The wording of every validation message.
TYPE_MESSAGES = {
    "string": "Input should be a valid string",
    "bigint": "Input should be a valid integer",
    "double": "Input should be a valid number",
    "date": "Input should be a valid date",
}
TOO_SHORT = "String should have at least {} character{}"
TOO_LONG = "String should have at most {} character{}"
GREATER = "Input should be greater than {}"
GREATER_EQUAL = "Input should be greater than or equal to {}"
CHOICE = "Input should be {}"
RECORD_PREFIX = "<model>: Value error, "


def _choices(values: tuple[str, ...]) -> str:
    quoted = [f"'{value}'" for value in values]
    head, last = quoted[:-1], quoted[-1]
    return CHOICE.format(f"{', '.join(head)} or {last}" if head else last)


def _length_message(template: str, n: int) -> str:
    return template.format(n, "" if n == 1 else "s")


def field_fault(field: Field) -> Column:
    """The field's first broken constraint as ``name: message``, or null."""
    value = F.col(field.name)
    faults: list[tuple[Column, str]] = []
    if field.required:
        message = _choices(field.choices) if field.choices else TYPE_MESSAGES[field.dtype]
        faults.append((value.isNull(), message))
    if field.choices:
        faults.append((~value.isin(*field.choices), _choices(field.choices)))
    if field.min_length is not None:
        short = F.char_length(value) < field.min_length
        faults.append((short, _length_message(TOO_SHORT, field.min_length)))
    if field.max_length is not None:
        long = F.char_length(value) > field.max_length
        faults.append((long, _length_message(TOO_LONG, field.max_length)))
    # NaN sorts above every number in Spark, yet is in no range.
    nan = F.isnan(value) if field.dtype == "double" else F.lit(False)
    if field.gt is not None:
        faults.append(((value <= field.gt) | nan, GREATER.format(f"{field.gt:g}")))
    if field.ge is not None:
        faults.append(((value < field.ge) | nan, GREATER_EQUAL.format(f"{field.ge:g}")))

    fault = F.lit(None).cast("string")
    for broken, message in reversed(faults):
        fault = F.when(broken, F.lit(f"{field.name}: {message}")).otherwise(fault)
    return fault


def validate(records: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """Add ``errors`` and ``valid`` to records that have the spec's fields.

    Both are null where ``no_extraction`` is true: nothing was there to judge.
    """
    require_columns(records, spec.names, "the record frame")
    nothing = F.col("no_extraction") if "no_extraction" in records.columns else F.lit(False)
    broken = [F.when(F.expr(c.violated), F.expr(c.message)) for c in spec.checks]
    record_message = F.concat_ws("; ", *broken)
    record_errors = present(
        F.when(F.col("_record_message") != "", F.concat(F.lit(RECORD_PREFIX), "_record_message"))
    )
    faulty = F.size("_field_errors") > 0
    return (
        records.withColumns(
            {
                "_field_errors": present(*[field_fault(field) for field in spec.fields]),
                "_record_message": record_message,
            }
        )
        .withColumn(
            "errors",
            F.when(nothing, F.lit(None))
            .when(faulty, F.col("_field_errors"))
            .otherwise(record_errors),
        )
        .withColumn("valid", F.size("errors") == 0)
        .drop("_field_errors", "_record_message")
    )


def validation_status(evaluated: DataFrame) -> DataFrame:
    """Per document: ``valid``, ``INVALID`` or ``skipped`` (nothing to validate)."""
    status = (
        F.when(F.col("no_extraction"), F.lit("skipped"))
        .when(F.col("valid"), F.lit("valid"))
        .otherwise(F.lit("INVALID"))
    )
    return evaluated.select("file", "detected", status.alias("status"), "errors")


def validation_counts(evaluated: DataFrame) -> DataFrame:
    """One row: how many documents are valid, invalid and skipped."""
    return evaluated.agg(
        F.count_if(F.col("valid")).alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.count_if(F.col("no_extraction")).alias("skipped"),
    )


def validation_errors(evaluated: DataFrame) -> DataFrame:
    """One row per error of every flagged document."""
    return evaluated.filter(~F.col("valid")).select(
        "file", F.posexplode("errors").alias("position", "error")
    )
