"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; row r of a source with n
rows gets the fractional rank (r + 1/2) / n. Sorted by it, every stretch of the
corpus has the corpus's own mixture of sources, and cutting the sorted rows into
equal runs gives shards that match it. The law that holds is ``rows``: the shards'
counts are at most one apart.

A source may hold most rows: it is ranked by one sort over (source, random key),
whose tasks cut a large source like any other range; no task gets a source whole.
Texts are not moved, only a few numbers of each row.

Defined cases: a null text has size 1 and checksum 0; null is a source like any
other; equal rows are rows of their own and get slots of their own; fewer rows than
shards leave some shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import indexed, text_of
from docflow.sources.scratch import staged

SHARDS = 8
SEED = 20240229


def interleave(
    docs: DataFrame,
    strata_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: id, stratum, ``size`` in bytes plus one, ``text_crc32``, ``shard`` and ``slot``."""
    if shards < 1:
        raise ValueError("there must be one shard at least")
    text = text_of(docs, text_col)
    # Equal rows have equal keys; the row number decides between them and nothing else.
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(strata_col).alias("stratum"),
            (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.lit(seed), F.col(id_col), text).alias("key"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-rows",
    )
    ranked = indexed(rows, [F.col("stratum"), F.col("key"), F.col("id"), F.col("row")], "place", "by-stratum")
    strata = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    # The place of a source's first row is what all sources before it hold.
    first = ranked.groupBy("stratum").agg(F.min("place").alias("first"))
    sizes = strata.join(first, strata["stratum"].eqNullSafe(first["stratum"])).select(
        strata["stratum"].alias("_stratum"), "n", "first"
    )
    fraction = (2 * (F.col("place") - F.col("first")) + 1) / (2 * F.col("n"))
    placed = ranked.join(sizes, F.col("stratum").eqNullSafe(F.col("_stratum"))).withColumn("fraction", fraction)
    mixed = staged(placed.select("id", "stratum", "size", "text_crc32", "key", "row", "fraction"), "shard-fractions")
    order = [F.col("fraction"), F.col("stratum"), F.col("key"), F.col("id"), F.col("row")]
    final = indexed(mixed, order, "at", "by-fraction")
    total = rows.count()
    # The first total % shards shards have one row more.
    small, more = divmod(total, shards)
    edge = more * (small + 1)
    shard = f"if(at < {edge}, at div {small + 1}, {more} + (at - {edge}) div {max(small, 1)})"
    slot = f"if(at < {edge}, at % {small + 1}, (at - {edge}) % {max(small, 1)})"
    return final.select(
        F.col("id").alias(id_col),
        F.col("stratum").alias(strata_col),
        "size",
        "text_crc32",
        F.expr(shard).cast("int").alias("shard"),
        F.expr(slot).cast("long").alias("slot"),
    )
