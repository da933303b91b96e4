"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.sources.scratch import staged


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the least node.

    Alternating star operations: each round links every node to the least node
    next to it, first its larger neighbours, then the smaller ones, until each
    component is one star. The edges never leave the executors; a round is
    written to the shared folder, so a lost executor repeats one round at most,
    and the driver sees two numbers of a round. No edges give no rows.
    """
    larger, less = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = staged(edges.filter("a <> b").select(larger, less).distinct(), "component-edges")
    seen = _fingerprint(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m"))
        least = least.select("a", F.least("a", "_m").alias("_m"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(least, "a").select("b", "_m").filter("b <> _m")
        after = small.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            least.select("a", F.col("_m").alias("b"))
        )
        now = staged(after.distinct(), "component-edges")
        was, seen = seen, _fingerprint(now)
        if was == seen:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())
