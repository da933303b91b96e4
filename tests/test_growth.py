"""What must not grow with the tables: files a document starts processes for, bytes of a log, rows of a task."""

from __future__ import annotations

import datetime
import os

from pyspark.sql import functions as F

from docflow import catalog
from docflow import fixtures as fx
from docflow.plans import reports
from docflow.sources import documents as sd
from docflow.sources.audit_log import AUDIT_SCHEMA, append_audit, read_audit
from samples import FIELDS_A, records


def test_each_text_gets_a_file_of_its_own(spark, tmp_path):
    """Odd folder names and texts, against Spark's writer; no checksum file, and each file opened once."""
    folders = ["plain", "Räume + a/b", "q=%#[x]{^", "'\"*:?\\", "", None]
    texts = ["", "x", "two\nlines\n", "é\r\n"]
    frame = spark.createDataFrame([(f, t) for f in folders for t in texts * 2], "folder string, text string")
    ours, theirs = str(tmp_path / "a [b] é" / "ours"), str(tmp_path / "theirs")
    sd.write_corpus(frame.repartition(3), ours)
    frame.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(theirs)

    def found(path):
        there = [(os.path.relpath(at, path), os.path.join(at, n)) for at, _, names in os.walk(path) for n in names]
        return sorted((at, open(file, "rb").read()) for at, file in there if not os.path.basename(file)[0] in "._")

    assert found(ours) == found(theirs) and len(found(ours)) == 48
    assert not [n for _, _, names in os.walk(ours) for n in names if n[0] == "."]


def test_corpus_from_files_keeps_all_rows(spark, tmp_path):
    rows = [(1, "web", "a"), (1, "web", "a"), (None, None, None), (2, "a/b", "x\n")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.corpus_from_files(spark, str(tmp_path))
    sha = {t: frame.limit(1).select(F.sha2(F.lit(t), 256)).first()[0] for t in ("a", "", "x\n")}
    want = [("Räume + web", sha["a"], 1)] * 2 + [("__HIVE_DEFAULT_PARTITION__", sha[""], 1), ("Räume + a%2Fb", sha["x\n"], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # The names and the texts come from one reading of the files.
    assert "Scan text" not in got._jdf.queryExecution().executedPlan().toString()


def test_the_driver_does_not_list_the_corpus(spark, tmp_path, monkeypatch):
    """Files are rows of a table that the tasks write; they are dealt by number and by size."""
    sizes = {f"{folder}/{i}.txt": 50 if i else 2000 for folder in ("a", "b/c", "b/d", "e") for i in range(60)}
    for name, size in sizes.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * size)
    for files, size, tasks in ((10_000, 1 << 27, 4), (20, 1 << 27, 12), (10_000, 1000, 20)):
        monkeypatch.setattr(sd, "FILES_PER_TASK", files)
        monkeypatch.setattr(sd, "BYTES_PER_TASK", size)
        docs = sd.read_corpus(spark, str(tmp_path))
        assert {r.file: len(r.text) for r in docs.collect()} == sizes
        assert docs.rdd.getNumPartitions() == tasks
        # Of the files that the driver knows none is a document's.
        known = docs.inputFiles()
        assert len(known) < 40 and all(name.endswith(".parquet") for name in known)


def test_texts_are_moved_only_where_they_lie_unevenly(spark, tmp_path):
    def plan(docs):
        return docs._jdf.queryExecution().executedPlan().toString()

    rows = spark.range(400).select("id", F.col("id").cast("string").alias("text"))
    for i, (parts, moved) in enumerate([(rows.repartition(16), False), (rows.coalesce(1), True), (rows.limit(0), False)]):
        parts.write.parquet(str(tmp_path / str(i)))
        docs = sd.evened(spark.read.parquet(str(tmp_path / str(i))).select("text"), 4)
        assert ("Exchange RoundRobinPartitioning(4)" in plan(docs)) == moved
        assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, parts.select("text").collect()))


def test_the_log_is_compressed(spark, tmp_path):
    rows = [("2024-03-01T09:00:00.000000+00:00", "reviewer one", "d", "city", "approve", None, f"v{i}") for i in range(4000)]
    append_audit(spark.createDataFrame(rows, AUDIT_SCHEMA), str(tmp_path / "log"))
    size = sum(f.stat().st_size for f in (tmp_path / "log").rglob("part-*"))
    assert 0 < size < 4000 * 20
    got = read_audit(spark, str(tmp_path / "log")).collect()
    assert sorted(map(tuple, got)) == sorted(rows)


def test_certificates_are_dealt_by_number(spark, tmp_path, monkeypatch):
    day = datetime.datetime(2024, 1, 2)
    tables = {
        "orders": ([(k, 1, "O", 1.5, day, "1-URGENT") for k in range(60)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(1, "c", 1)], "c_custkey long, c_name string, c_nationkey long"),
        "nation": ([(1, "n", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(1, "AFRICA")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(sd, "ROWS_PER_TASK", 5)
    # Also behind a join that deals its rows itself.
    monkeypatch.setattr(fx, "tables", lambda spark, at, *names: [spark.read.parquet(f"{at}/{n}.parquet").hint("merge") for n in names])
    counts = fx.certificates(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in counts) == 60 and len(counts) >= 12
    assert max(r["count"] for r in counts) <= 10


def test_scores_are_dealt_by_number(spark, monkeypatch):
    monkeypatch.setattr(sd, "ROWS_PER_TASK", 2)
    evaluated = records(spark, {f"d{i}": FIELDS_A for i in range(40)}).withColumn("no_extraction", F.lit(False))
    truth = evaluated.select("file", F.lit("A").alias("layout"), *[F.lit("other").alias(n) for n in reports.CERTIFICATES.names])
    report = reports.accuracy_report(evaluated, truth)
    tasks = report.mismatches.select("file", F.spark_partition_id().alias("task")).distinct()
    assert tasks.select("file").distinct().count() == 40
    assert tasks.select("task").distinct().count() > 8
