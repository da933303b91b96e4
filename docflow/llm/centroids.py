"""Centroid clustering of integer vectors with an incremental distance matrix.

Each vector keeps its exact dot product with every centroid, next to its own squared
length, in a table that is written once a round. When the centroids move, a dot
product changes by the vector's components times the centroid's changes, so only the
components that changed are read; a centroid that rests costs nothing. The distance
is ``|x|^2 - 2 x.c + |c|^2``, all in whole numbers, and the nearest centroid is found
anew from the row of distances. The first centroids are a change from zero vectors.

The driver holds the centroids and their sums: ``k`` times ``dims`` numbers, whatever
the input. Of the tables only the last is kept; a lost executor repeats its part of
one round.

Defined cases: a vector that is null, of another length, or has a component that is
null, NaN or infinite is left out; a null id hashes as the empty text; rows with equal
ids are rows of their own, the first centroid of several with one id being that of the
least components; fewer vectors than ``k`` make as many centroids; an empty table
gives no rows; further columns are ignored, except those named in ``keep``. A scaled
component beyond ``LIMIT`` is an error, as distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.sources.scratch import recorded, remove, staged

DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
SEED = "1"

# Components up to here keep a squared distance over 64 of them below 2 ** 63.
LIMIT = 1 << 27

_STATE = (
    ("_x", T.ArrayType(T.LongType())),
    ("_norm", T.LongType()),
    ("_dots", T.ArrayType(T.LongType())),
    ("_cluster", T.IntegerType()),
    ("_distance", T.LongType()),
)


def whole(vector: Column, dims: int = DIMS, scale: int = SCALE) -> Column:
    """The vector as ``floor(scale * x)`` of each component; null where it is left out."""
    numbers = vector.cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    usable = vector.isNotNull() & (F.size(vector) == dims) & finite
    scaled = lambda x: F.when(
        F.abs(x * scale) <= LIMIT, F.floor(x * scale)
    ).otherwise(F.raise_error(F.concat(F.lit("component out of range: "), x.cast("string"))).cast("long"))
    return F.when(usable, F.transform(numbers, scaled))


def starts(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The ``k`` vectors ``(_id, _x)`` of the least hashes, in their order."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    chosen = vectors.select(F.sha2(named, 256).alias("hash"), "_x").orderBy("hash", "_x").limit(k)
    return [list(row["_x"]) for row in chosen.collect()]


def _list(flat: np.ndarray, width: int) -> pa.ListArray:
    offsets = np.arange(0, flat.size + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.reshape(-1)))


def moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """``state`` after the centroids went from ``old`` to ``new``: dot products, nearest, distance."""
    fields = [f for f in state.schema.fields if f.name not in ("_dots", "_cluster", "_distance")]
    kept = [f.name for f in fields]
    schema = T.StructType(fields + [T.StructField(n, kind) for n, kind in _STATE[2:]])
    change = new - old
    steps = [(j, at, change[j, at]) for j in range(len(new)) if len(at := np.flatnonzero(change[j]))]
    lengths = (new * new).sum(axis=1)
    dims = new.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
            dots = batch.column("_dots").flatten().to_numpy(zero_copy_only=False).reshape(n, len(new)).copy()
            for j, at, by in steps:
                dots[:, j] += x[:, at] @ by
            norm = batch.column("_norm").to_numpy(zero_copy_only=False)
            distances = norm[:, None] - 2 * dots + lengths
            nearest = distances.argmin(axis=1)
            found = [
                _list(dots, len(new)),
                pa.array(nearest.astype(np.int32)),
                pa.array(distances[np.arange(n), nearest]),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + found, names=schema.names)

    return state.mapInArrow(run, schema)


def means(state: DataFrame, now: np.ndarray) -> np.ndarray:
    """The floored mean of each centroid's vectors; that of an empty one stays."""
    sums = [F.sum(F.col("_x")[i]).alias(str(i)) for i in range(now.shape[1])]
    after = now.copy()
    for row in state.groupBy("_cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row["_cluster"]] = [row[str(i)] // row["n"] for i in range(now.shape[1])]
    return after


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: tuple[str, ...] = (),
    dims: int = DIMS,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """Each kept vector's id and ``keep``, its ``cluster`` and squared ``distance``,
    ``cluster_inertia`` and ``inertia`` (the distances' sums), and ``centroid_sha256``,
    the hash of the centroid's components as decimal numbers joined by commas.
    """
    spark = vectors.sparkSession
    own = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    picked = vectors.select(own.alias("_row"), whole(F.col(vector_col), dims, scale).alias("_x"))
    with recorded() as made:
        kept = staged(picked.filter(F.col("_x").isNotNull()), "vectors")
        now = np.array(starts(kept.select(F.col("_row.id").alias("_id"), "_x"), k, seed), np.int64).reshape(-1, dims)
        zero = F.array_repeat(F.lit(0).cast("long"), len(now))
        norm = F.aggregate("_x", F.lit(0).cast("long"), lambda total, x: total + x * x)
        state = kept.select("_row", "_x", norm.alias("_norm"), zero.alias("_dots"))
        old, finished = np.zeros_like(now), not len(now)
        for turn in range(0 if finished else rounds + 1):
            state = staged(moved(state, old, now), f"distances-{turn}")
            remove(spark, made[:-1])
            del made[:-1]
            if turn < rounds:
                old, now = now, means(state, now)
    if finished:
        state = kept.select("_row", F.lit(0).alias("_cluster"), F.lit(0).cast("long").alias("_distance"))
    inertia = dict(state.groupBy("_cluster").agg(F.sum("_distance")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    facts = spark.createDataFrame(
        [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)],
        "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # At most k rows.
    return state.join(F.broadcast(facts), "_cluster").select(
        F.col("_row.id").alias(id_col),
        *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_cluster").alias("cluster"),
        F.col("_distance").alias("distance"),
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )
