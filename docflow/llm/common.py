"""Helpers the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.sources.scratch import staged

# Words of the word-based operators end at these six characters and no others.
BLANKS = " \t\n\r\x0b\x0c"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Rows of one Arrow batch where the rows hold whole texts: a batch must fit a
# Python worker's memory whatever the texts' lengths.
TEXT_ROWS_PER_BATCH = 256

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS_PER_BATCH) -> None:
    """Lower the session's rows per Arrow batch to ``rows``, if they are more."""
    now = int(spark.conf.get(_BATCH_ROWS, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The text column, null read as the empty text."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def with_row(docs: DataFrame, row: str, name: str) -> DataFrame:
    """``docs`` written once with a number per row that stays the same ever after.

    Rows that are equal in every column still get different numbers, and a task
    that is repeated reads the numbers instead of counting again.
    """
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), name)


def shielded(
    docs: DataFrame, keep: tuple[str, ...], own: tuple[str, ...], results: tuple[str, ...]
) -> tuple[DataFrame, tuple[str, ...], Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns ``keep`` under names that no operator uses, these names,
    and the way back.

    The columns ``own``, which the operator reads by name, stay as they are; all others
    go. On the way back a kept column that is named like one of ``results`` gets
    underscores after its name until none is left of that name.
    """
    hidden = {c: f"kept column {i}" for i, c in enumerate(keep) if c not in own}
    columns = [docs[f"`{c}`"] for c in dict.fromkeys(own) if c in docs.columns]
    frame = docs.select(*columns, *[docs[f"`{c}`"].alias(h) for c, h in hidden.items()])

    def back(found: DataFrame) -> DataFrame:
        taken, names = {c.lower() for c in (*own, *results)}, {}
        for column, name in hidden.items():
            free = column
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
            names[name] = free
        return found.withColumnsRenamed(names)

    return frame, tuple(hidden.get(c, c) for c in keep), back


def indexed(df: DataFrame, order: list[Column], index: str, name: str) -> DataFrame:
    """``df`` with the gapless place of each row, from 0, in ``order``.

    One range shuffle; each task numbers its own rows, and what the tasks before
    it hold is added. ``order`` must end in something unique for a defined result.
    The side that is broadcast has one row per task of the sort.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    held = staged(ordered.withColumn("_at", F.monotonically_increasing_id()), name)
    held = held.withColumn("_task", F.shiftright("_at", 33))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        held.groupBy("_task")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        held.join(F.broadcast(offsets), "_task")
        .withColumn(index, F.col("_before") + local)
        .drop("_task", "_at", "_before")
    )
