"""A training corpus from documents: five stages, each one operator of docflow.llm.

Every stage takes all rows its predecessor kept, is written as Parquet and read
again; all but the last return the columns of ``documents``. A stage's own scratch
tables go when the next stage is called: its result must be written by then.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontaminate, line_dedup, packing, quality, simhash
from docflow.llm.common import with_row
from docflow.sources.scratch import recorded, remove, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The operators' results have no SQL: a robust estimate, XXH64 fingerprints and a
# tokenizer. Each operator is held against plain Python in tests/llm; the pipeline's
# own test checks its columns and counts.
ORACLE_SQL = None


# The columns of documents that the operators know; all others are only carried along.
OWN = ("doc_id", "text", "lang", "source", "n_chars")

# What the last stage called over a folder, in a thread, has staged.
_scratch: dict[tuple[int, str], list[str]] = {}


def stage(function: Stage) -> Stage:
    """``function``, after the scratch tables of the stage before it have gone.

    Further columns of ``docs`` go through it under names that no operator uses, and
    come back as they were.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        chain = (threading.get_ident(), sf_dir)
        remove(spark, _scratch.pop(chain, []))
        hidden = {c: f"carried column {i}" for i, c in enumerate(docs.columns) if c not in OWN}
        with recorded() as made:
            result = function(spark, docs.withColumnsRenamed(hidden), sf_dir)
        _scratch[chain] = made
        return result.withColumnsRenamed({name: c for c, name in hidden.items() if name in result.columns})

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules reject."""
    columns = docs.columns
    kept = quality.judge(docs, keep=tuple(columns)).filter("kept")
    return kept.select(*columns)


@stage
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the later copies of repeated line runs; documents stay, if need be without text."""
    columns = docs.columns
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*columns)


@stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the least id."""
    rows = with_row(docs, "_row", "near-dedup-documents")
    found = simhash.near_duplicates(rows, keep=("_row",))
    chosen = simhash.representatives(found, "doc_id", "_row")
    return rows.join(chosen, "_row", "left_semi").select(*docs.columns)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, benchmark, keep=tuple(c for c in docs.columns if c != "doc_id"))
    return found.filter("not contaminated").select(*docs.columns)


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        path = scratch_path(spark, name)
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
