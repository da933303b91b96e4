"""Scoring documents against an answer key.

*Skipped* (nothing was extracted), *wrong* and *invalid* are kept apart: a
skipped document counts in no accuracy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.operators.classify import OK
from docflow.operators.frames import as_text, unpivot_fields
from docflow.spec import Field, Spec

_EXPECTED = "expected_{}"


def with_truth(
    evaluated: DataFrame,
    truth: DataFrame,
    spec: Spec = CERTIFICATES,
    how: str = "inner",
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Documents joined to their key rows: ``layout`` is the key's, the key's
    values are ``expected_<field>``, the document's keep their names.

    ``how="right"`` keeps key rows without a document; ``also`` names further
    columns of the documents to keep.
    """
    documents = evaluated.select("file", "no_extraction", *spec.names, *also)
    expected = truth.select(
        "file", "layout", *[F.col(n).alias(_EXPECTED.format(n)) for n in spec.names]
    )
    return documents.join(expected, "file", how)


def same_value(field: Field, actual: Column | None = None) -> Column:
    """Equal, null equal to null; NaN equals nothing, not even NaN."""
    actual = F.col(field.name) if actual is None else actual
    expected = F.col(_EXPECTED.format(field.name))
    same = actual.eqNullSafe(expected)
    return same & ~F.coalesce(F.isnan(actual), F.lit(False)) if field.dtype == "double" else same


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 of nothing."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def field_accuracy(scored: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """Correct and total per layout and field, per layout, and overall.

    ``field`` is null in a layout's total, ``layout`` too in the overall row.
    Sums are made per layout in one pass; only these few rows are unpivoted.
    """
    correct = [
        F.sum(same_value(field).cast("bigint")).alias(f"correct_{field.name}")
        for field in spec.fields
    ]
    per_layout = (
        scored.filter(~F.col("no_extraction"))
        .groupBy("layout")
        .agg(F.count(F.lit(1)).alias("documents"), *correct)
    )
    per_field = unpivot_fields(
        per_layout, ["layout", "documents"], spec.names, correct="correct_{}"
    ).withColumn("correct", F.col("correct").cast("bigint"))
    totals = per_field.rollup("layout", "field").agg(
        F.sum("correct").alias("correct"), F.sum("documents").alias("total")
    )
    return totals.withColumn("accuracy", ratio(F.col("correct"), F.col("total")))


def overall_accuracy(accuracy: DataFrame) -> DataFrame:
    """One row over all layouts, 0.0 where nothing was scored."""
    fields = accuracy.filter(F.col("field").isNotNull())
    totals = fields.agg(
        F.coalesce(F.sum("correct"), F.lit(0)).alias("correct"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
    )
    return totals.withColumn("accuracy", ratio(F.col("correct"), F.col("total")))


def mismatches(scored: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """One row per wrong field, with both values as strings."""
    wrong = [
        F.when(
            ~same_value(field),
            F.struct(
                F.lit(field.name).alias("field"),
                as_text(F.col(_EXPECTED.format(field.name)), field.dtype).alias("expected"),
                as_text(F.col(field.name), field.dtype).alias("actual"),
            ),
        )
        for field in spec.fields
    ]
    return scored.filter(~F.col("no_extraction")).select(
        "file", "layout", F.inline(F.array_compact(F.array(*wrong)))
    )


def skipped_by_layout(scored: DataFrame) -> DataFrame:
    """Key rows whose document gave no extraction, per layout of the key."""
    return (
        scored.filter("no_extraction").groupBy("layout").agg(F.count(F.lit(1)).alias("documents"))
    )


def truth_without_document(documents: DataFrame, truth: DataFrame) -> DataFrame:
    """Key rows that name no document of the corpus."""
    return truth.join(documents.select("file"), "file", "left_anti")


def repeated_names(documents: DataFrame, truth: DataFrame) -> DataFrame:
    """``(file, documents)`` of the key's names that several documents bear.

    Only names are read and shuffled, and of the corpus only those the key knows.
    """
    known = documents.select("file").join(truth.select("file").distinct(), "file", "left_semi")
    return known.groupBy("file").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")


def conflicting_layouts(truth_layouts: DataFrame) -> DataFrame:
    """``(file, layouts)`` of files that the key's rows put into several layouts."""
    layouts = F.sort_array(F.collect_set("layout"))
    return truth_layouts.groupBy("file").agg(layouts.alias("layouts")).filter(F.size("layouts") > 1)


def routing(classified: DataFrame, truth_layouts: DataFrame) -> DataFrame:
    """Each document with its expected layout, if the key knows one.

    ``misrouted_vs_truth`` (unclear, or another layout than expected) is not
    ``no_extraction``: a layout without a parser is routed rightly and yields
    nothing. A file with several rows in the key counts once; if they differ, no layout
    is expected of it (:func:`conflicting_layouts`).
    """
    one = F.min("layout").eqNullSafe(F.max("layout"))
    expected = truth_layouts.groupBy("file").agg(F.when(one, F.min("layout")).alias("expected"))
    differs = F.col("expected").isNotNull() & ~F.col("layout").eqNullSafe(F.col("expected"))
    kept = [c for c in ("file", "layout", "status", "detected", "note") if c in classified.columns]
    return (
        classified.select(*kept)
        .join(expected, "file", "left")
        .withColumn("misrouted_vs_truth", (F.col("status") != OK) | differs)
    )


def routing_accuracy(routed: DataFrame) -> DataFrame:
    """One row: rightly routed documents among those the key knows."""
    known = F.col("expected").isNotNull()
    return routed.agg(
        F.count_if(known & (F.col("layout") == F.col("expected"))).alias("correct"),
        F.count_if(known).alias("scored"),
    ).withColumn("accuracy", ratio(F.col("correct"), F.col("scored")))


def misrouted(routed: DataFrame) -> DataFrame:
    return routed.filter("misrouted_vs_truth")
