"""Small helpers on whole frames."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: tuple[str, ...], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed once, whatever is filtered afterwards.

    A filter on a derived column is normally moved below the projections that
    derive it, by copying their expressions into the filter. For a column that
    stands on a dozen pattern matches this evaluates all of them again, several
    times over. Filters are not moved below an observation, so counting rows
    here keeps the matches in one place; columns nobody reads are still pruned.
    """
    return df.observe(f"docflow_{uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def as_text(value: Column, dtype: str) -> Column:
    """A value as a person types it: doubles in plain notation, not as ``1.25E7``.

    Beyond 20 digits, and below the 18th decimal, Spark's notation stays.
    """
    text = value.cast("string")
    if dtype != "double":
        return text
    plain = F.regexp_replace(value.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+\z", "$1")
    return F.when(text.contains("E"), F.coalesce(plain, text)).otherwise(text)


def unpivot_fields(
    df: DataFrame, ids: list[str], names: tuple[str, ...], **values: str
) -> DataFrame:
    """One row per field: ``ids``, ``field`` and one column per entry of ``values``.

    ``values`` maps an output column to a template such as ``"new_{}"``, filled
    with the field's name. Values are rendered as strings. All ids are plain
    columns of ``df``; a narrow operation.
    """
    types = dict(df.dtypes)
    entries = [
        F.struct(
            F.lit(name).alias("field"),
            *[as_text(F.col(t.format(name)), types[t.format(name)]).alias(out) for out, t in values.items()],
        )
        for name in names
    ]
    return df.select(*ids, F.inline(F.array(*entries)))
