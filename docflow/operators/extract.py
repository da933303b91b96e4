"""Field extraction: a layout's rules applied to the text, as columns.

Fields are plain columns rather than one struct, so that a query over a few
fields runs the patterns of those fields only. The work is staged in three
projections (match, pick, convert) so that no pattern is evaluated twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.functions import text as tx
from docflow.operators.classify import AMBIGUOUS, UNKNOWN, classify, only_layouts
from docflow.operators.frames import require_columns, settled, unpivot_fields
from docflow.spec import Layout, Rule, Spec

_CONVERT: dict[str, Callable[[Column], Column]] = {
    "string": tx.filled,
    "bigint": tx.whole_number,
    "double": tx.money,
    "date": tx.us_date,
}
_PARTS: dict[str, Callable[[Column], Column]] = {
    "city": tx.address_city,
    "state": tx.address_state,
}


def _shared(layout: Layout) -> dict[str, tuple[str, int]]:
    """Shared pattern -> the column that holds its match, and which group that is.

    Where all rules of a pattern read the same group, the match is cut down to it.
    """
    shared = {}
    for i, pattern in enumerate(layout.shared_patterns):
        groups = {rule.group for rule in layout.rules if rule.pattern == pattern}
        shared[pattern] = (f"_match_{layout.name}_{i}", groups.pop() if len(groups) == 1 else 0)
    return shared


def _source(pattern: str) -> Column:
    return F.col("_lines" if tx.starts_line(pattern) else "text")


def _picked(rule: Rule, layout: Layout) -> Column:
    shared = _shared(layout)
    if rule.pattern in shared:
        column, held = shared[rule.pattern]
        source = F.col(column)
    else:
        source, held = _source(rule.pattern), 0
    value = source if held == rule.group else tx.first_match(source, rule.pattern, rule.group)
    return _PARTS[rule.part](value) if rule.part else value


def _apply_rules(
    docs: DataFrame, spec: Spec, layouts: tuple[Layout, ...], chosen: Callable[[Layout], Column]
) -> DataFrame:
    """Add the spec's fields, each read by the rules of the layout ``chosen`` holds for."""
    lined = {
        "_lines": tx.lines(F.col("text"))
        for layout in layouts
        for rule in layout.rules
        if tx.starts_line(rule.pattern)
    }
    matches = {
        column: F.when(chosen(layout), tx.first_match(_source(shared), shared, group))
        for layout in layouts
        for shared, (column, group) in _shared(layout).items()
    }

    def branches(values: list[tuple[Layout, Column]]) -> Column:
        result = F.lit(None)
        for layout, value in values:
            result = F.when(chosen(layout), value).otherwise(result)
        return result

    picked, final = {}, {}
    for field in spec.fields:
        ruled = [
            (layout, _picked(rule, layout))
            for layout in layouts
            for rule in layout.rules
            if rule.field == field.name
        ]
        counted = [
            (layout, tx.section_count(F.col("text"), count.heading, count.bullet))
            for layout in layouts
            for count in layout.counts
            if count.field == field.name
        ]
        if counted:
            # A field may be ruled in one layout and counted in another.
            ruled = [(layout, _CONVERT[field.dtype](value)) for layout, value in ruled]
            final[field.name] = branches(ruled + counted).cast(field.dtype)
        elif ruled:
            picked[f"_raw_{field.name}"] = branches(ruled)
            final[field.name] = _CONVERT[field.dtype](F.col(f"_raw_{field.name}"))
        else:
            final[field.name] = F.lit(None).cast(field.dtype)

    staged = docs
    for stage in (lined, matches, picked, final):
        if stage:
            staged = staged.withColumns(stage)
    return staged.drop(*lined, *matches, *picked)


def parse_as(docs: DataFrame, layout: str, spec: Spec = CERTIFICATES) -> DataFrame:
    """Read every document by one layout's rules, whether it has that layout or not."""
    require_columns(docs, ("file", "text"), "the document frame")
    return settled(_apply_rules(docs, spec, (spec.layout(layout),), lambda _: F.lit(True)))


def routing_note(spec: Spec) -> Column:
    """What became of the document, in words."""
    parsers = [layout.name for layout in spec.parsed]
    # With two markers or more this is how a tuple of strings is written.
    several = F.concat(F.lit("('"), F.array_join("matched", "', '"), F.lit("')"))
    return (
        F.when(F.col("status") == UNKNOWN, F.lit("unknown: matched markers = none"))
        .when(
            F.col("status") == AMBIGUOUS,
            F.concat(F.lit("ambiguous: matched markers = "), several),
        )
        .when(
            F.col("layout").isin(parsers),
            F.concat(F.lit("routed to layout "), F.col("layout"), F.lit(" parser")),
        )
        .otherwise(
            F.concat(
                F.lit("layout "),
                F.col("layout"),
                F.lit(" detected correctly, but no parser exists yet"),
            )
        )
    )


def routed(
    docs: DataFrame, spec: Spec = CERTIFICATES, layouts: tuple[str, ...] | None = None
) -> DataFrame:
    """:func:`route` without the observation, to build on within one pipeline."""
    parsers = [layout.name for layout in spec.parsed]
    if layouts is not None:
        docs = only_layouts(docs, layouts, spec)
    noted = classify(docs, spec).withColumns(
        {
            "no_extraction": ~F.coalesce(F.col("layout").isin(parsers), F.lit(False)),
            "note": routing_note(spec),
        }
    )
    return _apply_rules(noted, spec, spec.parsed, lambda layout: F.col("layout") == layout.name)


def route(
    docs: DataFrame, spec: Spec = CERTIFICATES, layouts: tuple[str, ...] | None = None
) -> DataFrame:
    """Classify ``(file, text)`` and read each document by its own layout's rules.

    Adds the classification, ``no_extraction`` (unknown, ambiguous or without a
    parser: every field is null), ``note`` and the spec's fields. ``layouts``
    keeps only the documents of these layouts, before any pattern runs. One
    narrow stage; the text stays, for callers that still need it.
    """
    return settled(routed(docs, spec, layouts))


def fields_long(df: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """One row per document and field, the value as a string."""
    return unpivot_fields(df, ["file"], spec.names, value="{}")


def pack_fields(df: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """Replace the field columns by one struct ``fields``, null without an extraction."""
    others = [name for name in df.columns if name not in spec.names]
    record = F.struct(*spec.names)
    return df.select(*others, F.when(~F.col("no_extraction"), record).alias("fields"))
