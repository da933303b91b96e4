"""Layout classification from marker phrases.

A document has a layout only if exactly one layout's marker occurs in it. None
or several is reported as such and never resolved by a guess.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.functions import present
from docflow.operators.frames import require_columns
from docflow.spec import Spec

OK, UNKNOWN, AMBIGUOUS = "ok", "unknown", "ambiguous"


def has_marker(text: Column, spec: Spec, layout: str) -> Column:
    """Whether ``text`` holds the marker of ``layout``; a null text holds none."""
    return F.coalesce(F.contains(text, F.lit(spec.layout(layout).marker)), F.lit(False))


def is_layout(docs: DataFrame, layout: str, spec: Spec = CERTIFICATES) -> DataFrame:
    """The documents that carry one layout's marker, whatever else they carry."""
    return docs.filter(has_marker(F.col("text"), spec, layout))


def only_layouts(
    docs: DataFrame, layouts: tuple[str, ...], spec: Spec = CERTIFICATES
) -> DataFrame:
    """The documents classified as one of ``layouts``, told by the markers alone."""

    def sole(name: str) -> Column:
        others = [~has_marker(F.col("text"), spec, o.name) for o in spec.layouts if o.name != name]
        return reduce(lambda a, b: a & b, others, has_marker(F.col("text"), spec, name))

    return docs.filter(reduce(lambda a, b: a | b, [sole(name) for name in layouts]))


def classify(docs: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """Add ``matched``, ``layout``, ``status`` and ``detected`` to ``(file, text)``."""
    require_columns(docs, ("file", "text"), "the document frame")
    flags = {layout.name: F.col(f"_has_{layout.name}") for layout in spec.layouts}
    hits = reduce(lambda a, b: a + b, [flag.cast("int") for flag in flags.values()])

    flagged = docs.withColumns(
        {f"_has_{name}": has_marker(F.col("text"), spec, name) for name in flags}
    )
    counted = flagged.withColumns(
        {
            "matched": present(*[F.when(flag, F.lit(name)) for name, flag in flags.items()]),
            "status": F.when(hits == 1, F.lit(OK))
            .when(hits == 0, F.lit(UNKNOWN))
            .otherwise(F.lit(AMBIGUOUS)),
            "layout": F.when(
                hits == 1, F.coalesce(*[F.when(flag, F.lit(n)) for n, flag in flags.items()])
            ),
        }
    )
    return counted.withColumn("detected", F.coalesce("layout", F.upper("status"))).drop(
        *[f"_has_{name}" for name in flags]
    )


def layout_counts(classified: DataFrame) -> DataFrame:
    """Documents per detected layout or failure, by name."""
    return (
        classified.groupBy("detected")
        .agg(F.count(F.lit(1)).alias("documents"))
        .orderBy("detected")
    )
