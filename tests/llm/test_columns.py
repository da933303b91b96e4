"""Columns of a user's own, whatever their names, and odd rows, through operators and pipeline."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracles import connect, differences
from docflow.llm import decontaminate, line_dedup, quality, queries, simhash, sql

NAMES = (
    "_row", "n_lines", "removed_lines", "_runs", "n_words", "N_HIT", "items", "fp", "component_id", "group", "v0",
    "_text", "kept", "distance", "contaminated", "a.b", "row", "run", "cut", "_fps", "fingerprint",
)


def with_own(docs):
    """Every own column holds its number and the row's ``mark``."""
    docs = docs.withColumn("mark", F.monotonically_increasing_id())
    return docs.withColumns({name: F.concat(F.lit(f"{i} "), F.col("mark").cast("string")) for i, name in enumerate(NAMES)})


def own_values(rows):
    return all(r[name] == f"{i} {r['mark']}" for r in rows for i, name in enumerate(NAMES))


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    long = " ".join(f"word{i}" for i in range(60))
    odd = [(9001, None), (9002, ""), (9003, " \n"), (None, long), (9004, long), (9004, long), (9005, long + " more")]
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    return with_own(docs.unionByName(rows)).cache()


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def hit_windows(benchmark):
    found = set()
    for text in benchmark:
        words = words_of(text)
        n = min(10, len(words))
        found |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    return found


def test_pipeline_carries_every_column(spark, documents, sf_dir):
    docs = documents
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        assert result.columns == documents.columns, name
        rows = result.collect()
        assert rows and own_values(rows), name
        seen[name] = {r["mark"]: r for r in rows}
        assert len(seen[name]) == len(rows), name
        docs = spark.createDataFrame(rows, documents.schema)
    marks = {name: set(rows) for name, rows in seen.items()}
    stages = list(marks)
    assert all(marks[b] <= marks[a] for a, b in zip(stages, stages[1:]))
    # Each stage against what it states, on its own input.
    before = {r["mark"]: r for r in documents.collect()}
    short = {m for m, r in before.items() if len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) < 20}
    assert short and not short & marks["quality_rules"]
    assert marks["line_dedup"] == marks["quality_rules"]
    equal = {}
    for mark, row in seen["line_dedup"].items():
        equal.setdefault(row["text"], []).append(mark)
    assert any(len(m) > 1 for m in equal.values())
    assert all(len(set(m) & marks["simhash_near_dedup"]) <= 1 for m in equal.values())
    windows = hit_windows(r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    sizes = {len(w) for w in windows}
    for mark, row in seen["simhash_near_dedup"].items():
        words = words_of(row["text"])
        hit = any(tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1))
        assert hit != (mark in marks["benchmark_decontamination"]), mark
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in seen["benchmark_decontamination"].values()}


def test_pipeline_of_an_empty_table(spark, documents, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), sf_dir).count() == 0, name


def test_operators_keep_columns_of_any_name(spark, documents, sf_dir):
    keep = (*NAMES, "mark")

    def own(found, results):
        """Kept columns, named after results with underscores."""
        lower = {r.lower() for r in results}
        named = {n: n + "_" if n.lower() in lower else n for n in keep}
        rows = [{n: r[c] for n, c in named.items()} for r in found.collect()]
        assert len(rows) == documents.count() and own_values(rows)

    own(quality.judge(documents, keep=keep), (*quality.COUNTS, "base_failed", "distance", "kept"))
    own(simhash.near_duplicates(documents, keep=keep), ("fingerprint", "component_id", "component_fp"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own(decontaminate.decontaminate(documents, benchmark, keep=keep), ("n_words", "n_hit", "items", "contaminated"))
    own(line_dedup.dedup_lines(documents), ("n_lines", "removed_lines"))


def test_an_item_without_an_id_counts(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, "x y")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, passage), ("b", passage), (None, "z z"), ("c", None)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert got == {1: (12, ["", "b"]), 2: (0, [])}


@pytest.mark.parametrize("name", ["op5_chat_formatting", "op10_benchmark_decontamination"])
def test_queries_match_their_sql(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, connect(sf_dir).execute(sql.oracle_sql()[name]).df()) is None


def test_sql_of_crc32():
    import zlib

    for text in ("", "a", "é𝒳", "7:wandern"):
        quoted = text.replace("'", "''")
        got = connect("/root/testdata/sf0.001").execute(f"SELECT {sql.crc32('s')} FROM (SELECT '{quoted}' AS s)").fetchone()[0]
        assert got == zlib.crc32(text.encode()), text
