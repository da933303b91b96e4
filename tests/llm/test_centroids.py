"""Centroid clustering against plain Python with full recomputation."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracles import connect, differences
from docflow.llm import centroids, queries, sql

SCHEMA = "vec_id long, embedding array<float>, cluster string, _x int, _row int"


def brute(rows, dims, k, rounds, scale=64, seed="1"):
    kept = []
    for i, vector in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((i, [math.floor(scale * float(np.float32(x))) for x in vector]))
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    now = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(now)):
            own = [v for (_, v), f in zip(kept, found) if f == j]
            if own:
                now[j] = [sum(c) // len(own) for c in zip(*own)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = {j: sum(d for _, d, c in last if c == j) for j in range(len(now))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in last), key=repr
    )


def run(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, "c", 7, 8) for i, v in rows], SCHEMA)
    got = centroids.cluster(frame.repartition(3), **settings).collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_full_recomputation(spark, seed):
    rng = random.Random(seed)
    grid = [-2.5, -1 / 64, -1 / 128, 0.0, 1 / 128, 0.3, 1.0]  # ties and floors below zero
    rows = [(rng.randrange(40), [rng.choice(grid) for _ in range(3)]) for _ in range(120)]
    rows += [rows[0]] * 30 + [(None, [0.0, 1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, math.nan, 2.0]), (6, [math.inf, 0.0, 0.0])]
    settings = {"dims": 3, "k": 5, "rounds": 3}
    assert run(spark, rows, **settings) == brute(rows, **settings)


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5])]
    assert run(spark, rows, dims=2, k=5, rounds=2) == brute(rows, 2, 5, 2)
    assert run(spark, [(1, [1.0])], dims=2) == []
    empty = spark.createDataFrame([], SCHEMA)
    got = centroids.cluster(empty)
    assert got.count() == 0 and got.columns == queries.op12_centroid_clustering(spark, "/root/testdata/sf0.001").columns


def test_further_columns_stay_as_they_are(spark):
    frame = spark.createDataFrame([(i, [i / 8, 1.0], "mine", i, -i) for i in range(9)], SCHEMA)
    got = centroids.cluster(frame.withColumnRenamed("cluster", "_cluster"), dims=2, k=2, keep=("_x", "_row", "_cluster")).collect()
    assert sorted((r["vec_id"], r["_x"], r["_row"], r["_cluster"]) for r in got) == [(i, i, -i, "mine") for i in range(9)]


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [3e30], "c", 7, 8)], SCHEMA)
    with pytest.raises(Exception, match="out of range"):
        centroids.cluster(frame, dims=1).collect()


def test_only_changed_components_count(spark):
    """Dot products come from the stored ones: with false ones stored, the error stays in."""
    x = [[1, 2, 3], [4, 5, 6]]
    state = spark.createDataFrame(
        [(v, sum(a * a for a in v), [100, 0], 0, 0) for v in x],
        "_x array<long>, _norm long, _dots array<long>, _cluster int, _distance long",
    ).select("_x", "_norm", "_dots")
    old = np.array([[0, 0, 0], [1, 1, 1]], np.int64)
    new = np.array([[0, 7, 0], [1, 1, 1]], np.int64)
    dots = sorted(r["_dots"] for r in centroids.moved(state, old, new).collect())
    assert dots == [[100 + 14, 0], [100 + 35, 0]]


def test_query_matches_its_sql(spark, sf_dir):
    got = queries.op12_centroid_clustering(spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, connect(sf_dir).execute(sql.oracle_sql()["op12_centroid_clustering"]).df()) is None


def test_kept_rows_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    usable = table.filter(F.size("embedding") == 64).count()
    assert queries.op12_centroid_clustering(spark, sf_dir).count() == usable
