"""The robust estimate: against an exact search, and a group by itself."""

from __future__ import annotations

from itertools import combinations

import numpy as np

from docflow.llm import quality


def vectors(spark, groups):
    rows = [(g, *map(float, v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, ", ".join(["group string", *[f"{v} double" for v in quality.VECTOR]]))


def fitted(frame, **settings):
    return {r["group"]: (np.array(r["mean"]), r["logdet"]) for r in quality.mcd(frame, **settings).collect()}


def cloud(seed, n, far):
    """``n`` rows around a centre of the seed's own, the last ``far`` of them far off."""
    rng = np.random.default_rng(seed)
    width = len(quality.VECTOR)
    rows = rng.normal(seed, 0.3, (n, width)) @ np.diag(np.linspace(0.5, 1.5, width))
    rows[n - far :] += 25
    return rows


def test_outliers_do_not_move_the_estimate(spark):
    groups = {"a": cloud(1, 500, 100), "b": cloud(5, 400, 0), "c": cloud(9, 300, 60)}
    got = fitted(vectors(spark, groups))
    for name, n in (("a", 400), ("b", 400), ("c", 240)):
        clean = groups[name][:n].mean(axis=0)
        assert np.abs(got[name][0] - clean).max() < 0.15, name
        assert name == "b" or np.abs(groups[name].mean(axis=0) - clean).max() > 2


def test_a_group_does_not_depend_on_the_others(spark):
    groups = {str(i): cloud(i, 220 + 30 * i, 20 * i) for i in range(1, 6)}
    together = fitted(vectors(spark, groups))
    dealt = fitted(vectors(spark, groups), few=True)
    for name, rows in groups.items():
        alone = fitted(vectors(spark, {name: rows}))[name]
        for other in (together[name], dealt[name]):
            assert np.allclose(alone[0], other[0]) and abs(alone[1] - other[1]) < 1e-9


def test_near_the_exact_least_determinant(spark):
    """A group small enough to try every half: the estimate's centre is that half's, or near it."""
    rows = cloud(3, 14, 3)
    size = int(np.ceil(quality.SUPPORT * len(rows)))

    def logdet(chosen):
        scatter = np.cov(rows[list(chosen)].T, bias=True)
        return np.linalg.slogdet(scatter + np.diag(np.square(quality.FLOORS)))[1]

    best = min(combinations(range(len(rows)), size), key=logdet)
    assert set(best) <= set(range(11))
    got = fitted(vectors(spark, {"g": rows}))["g"][0]
    assert np.abs(got - rows[:11].mean(axis=0)).max() < 0.6
    assert np.abs(rows.mean(axis=0) - rows[:11].mean(axis=0)).max() > 5


def test_no_vector_is_dealt_by_its_group(spark, sf_dir, monkeypatch):
    """The hot group's rows stay where they are in every step, if the groups are few."""
    plans = []
    staged = quality.staged

    def watched(df, name, *rest):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name, *rest)

    monkeypatch.setattr(quality, "staged", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        quality.mcd(vectors(spark, {"a": cloud(1, 300, 30)}), few=True)
        steps = [p for n, p in plans if n in ("mcd-step", "mcd-starts", "mcd")]
        assert len(steps) >= 3
        for plan in steps:
            # Whole vectors stand in no exchange: those hold sums, bins and cuts only.
            assert "SortMergeJoin [group" not in plan or "v0" not in plan.split("SortMergeJoin [group")[1].split("\n")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
