"""Layout of the tables at rest: what is read for a key, a wave or a file, and what a crash leaves."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from docflow.operators import audit as au
from docflow.operators import gapfill as gf
from docflow.operators import score as sc
from docflow.plans import reports
from docflow.sources import answers as store
from docflow.sources import folders
from docflow.sources.answers import (
    ANSWER_SCHEMA,
    STORED_SCHEMA,
    append_answers,
    compact_answers,
    live_parts,
    read_answers,
    read_failures,
    touched_prefixes,
)
from docflow.sources.audit_log import AUDIT_SCHEMA, append_audit, read_audit
from docflow.sources.scratch import staged
from samples import FIELDS_A, FIELDS_C, documents, records, text_c


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def some_answers(spark, numbers, seq):
    rows = [(seq, key(i), f'{{"city": "{seq}"}}', 1, 1, 0.5, 0.1) for i in numbers]
    return spark.createDataFrame(rows, ANSWER_SCHEMA)


def kept(spark, path):
    return sorted((r.seq, r.key) for r in read_answers(spark, path).collect())


def test_only_touched_prefixes_are_read(spark, tmp_path):
    path = str(tmp_path / "answers")
    append_answers(some_answers(spark, range(400), 1), path)
    append_answers(some_answers(spark, range(200), 2), path)
    requests = spark.createDataFrame([(key(3), "a"), (key(7), "b"), (None, "c")], "key string, file string")
    prefixes = touched_prefixes(requests)
    assert prefixes == sorted({key(3)[:2], key(7)[:2]})
    some = read_answers(spark, path, prefixes)
    assert "PartitionFilters: [" in plan(some) and "prefix#" in plan(some).split("PartitionFilters: [")[1].split("]")[0]
    want = [(s, key(i)) for s, n in ((1, 400), (2, 200)) for i in range(n) if key(i)[:2] in prefixes]
    assert sorted((r.seq, r.key) for r in some.collect()) == sorted(want)
    opened = read_answers(spark, path, prefixes).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("prefix=")[1][:2] for r in opened} == set(prefixes)
    # Prefixes that look like numbers stay texts.
    assert kept(spark, path) == sorted((s, key(i)) for s, n in ((1, 400), (2, 200)) for i in range(n))


def test_compaction_may_stop_anywhere(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "answers")
    for seq in (1, 2, 3):
        append_answers(some_answers(spark, range(50), seq), path)
    failed = some_answers(spark, [99], 4).withColumn("error", F.lit("gone"))
    append_answers(failed, path)
    before = kept(spark, path)
    assert len(before) == 150

    def stop(*_):
        raise SystemExit("killed")

    # After the snapshot, before the pointer: the parts are still the table.
    with monkeypatch.context() as m:
        m.setattr(store, "point_to", stop)
        with pytest.raises(SystemExit):
            compact_answers(spark, path)
    assert kept(spark, path) == before and len(live_parts(spark, path)[0]) == 4
    # After the pointer, before the parts go: the snapshot is the table.
    with monkeypatch.context() as m:
        m.setattr(store, "sweep", stop)
        with pytest.raises(SystemExit):
            compact_answers(spark, path)
    assert kept(spark, path) == before and len(live_parts(spark, path)[0]) == 1
    append_answers(some_answers(spark, [100], 5), path)
    compact_answers(spark, path)
    assert kept(spark, path) == sorted([*before, (5, key(100))])
    assert len(folders.names(spark, path)[0]) == 1 and len(folders.names(spark, f"{path}/_pointers")[1]) == 1
    assert [r.error for r in read_failures(spark, path).collect()] == ["gone"]


def test_a_part_being_written_is_not_compacted(spark, tmp_path):
    path = str(tmp_path / "answers")
    append_answers(some_answers(spark, range(5), 1), path)
    append_answers(some_answers(spark, range(5, 9), 2), path)
    late = live_parts(spark, path)[0][1]
    folders.remove(spark, f"{path}/{late}/_SUCCESS")
    compact_answers(spark, path)
    assert late in live_parts(spark, path)[0] and len(kept(spark, path)) == 9


def test_a_flat_table_is_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "answers")
    flat = some_answers(spark, range(6), 1).withColumn("error", F.lit(None).cast("string"))
    flat.select(*STORED_SCHEMA.names).write.parquet(path)
    assert len(kept(spark, path)) == 6 and read_answers(spark, path, [key(0)[:2]]).count() >= 1
    append_answers(some_answers(spark, range(6, 8), 2), path)
    before = kept(spark, path)
    compact_answers(spark, path)
    assert kept(spark, path) == before and len(before) == 8
    assert folders.names(spark, path)[1] == []


def test_compaction_of_nothing(spark, tmp_path):
    compact_answers(spark, str(tmp_path / "none"))
    assert read_answers(spark, str(tmp_path / "none")).count() == 0


def test_a_wave_reads_its_own_folder(spark):
    rows = [(key(i), "text " * 50, ["city"]) for i in range(90)]
    pending = spark.createDataFrame(rows, "key string, text string, missing array<string>").dropDuplicates(["key"])
    requests, waves = gf.wave_table(pending, 20)
    assert waves == 5
    each = [gf.one_wave(requests, w) for w in range(waves)]
    for wave in each:
        filters = plan(wave).split("PartitionFilters: [")[1].split("]")[0]
        assert "wave#" in filters
    seen = [r.key for wave in each for r in wave.select("key").collect()]
    assert sorted(seen) == sorted(key(i) for i in range(90))
    files = [{r[0] for r in wave.select(F.input_file_name()).distinct().collect()} for wave in each]
    assert all(not a & b for i, a in enumerate(files) for b in files[:i])


def test_reports_pass_waves_and_concurrency_on(spark, tmp_path):
    docs = documents(spark, {f"d{i}": text_c(load="pounds", premises=f"Hall {i}") for i in range(9)})
    path = str(tmp_path / "answers")
    ask = gf.GapFill(model="m", prompt="p")
    call = lambda text, missing: ({"capacity_lbs": 5}, 1, 1)
    got = reports.fill_gaps(docs, call, ask, path, concurrency=3, wave_requests=2, compact_after=2)
    assert [r.capacity_lbs for r in got.collect()] == [5] * 9
    assert len(live_parts(spark, path)[0]) == 5
    again = reports.fill_gaps(docs, call, ask, path, compact_after=2)
    assert again.filter("from_cache").count() == 9
    # Compacted to one part; the rerun asked nothing and added none.
    assert len(live_parts(spark, path)[0]) == 1


def test_a_files_history_is_read_from_its_bucket(spark, tmp_path):
    log = str(tmp_path / "audit")
    old = records(spark, {f"d{i}": FIELDS_A for i in range(40)})

    def submit(files, who, when):
        rows = [(f, n, "x") for f in files for n in ("state", "cert_no", "city")]
        frame = spark.createDataFrame(rows, "file string, field string, new_value string")
        append_audit(au.record_review(frame, old, who, F.lit(when)), log)

    submit([f"d{i}" for i in range(40)], "ana", "2024-03-01T09:00:00.000000+00:00")
    submit(["d1", "d2"], "bo", "2024-03-02T08:00:00.000000+00:00")
    one = read_audit(spark, log, file="d1")
    filters = plan(one).split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket#" in filters
    history = [(r.reviewer, r.field) for r in au.entries_for_file(one, "d1").collect()]
    assert history == [(who, f) for who in ("ana", "bo") for f in ("cert_no", "city", "state")]
    day = read_audit(spark, log, day="2024-03-02")
    assert "day#" in plan(day).split("PartitionFilters: [")[1].split("]")[0]
    assert day.count() == 6 and read_audit(spark, log).count() == 126
    assert read_audit(spark, log, file="none").count() == 0


def test_a_log_from_before_is_read_too(spark, tmp_path):
    log = str(tmp_path / "audit")
    old = [("2024-02-01T00:00:00.000000+00:00", "ana", "d1", "city", "approve", None, None)]
    spark.createDataFrame(old, AUDIT_SCHEMA).write.json(log)
    entry = [("2024-03-01T00:00:00.000000+00:00", "bo", "d1", "city", "correct", None, "x")]
    append_audit(spark.createDataFrame(entry, AUDIT_SCHEMA), log)
    assert [r.reviewer for r in au.entries_for_file(read_audit(spark, log, file="d1"), "d1").collect()] == ["ana", "bo"]
    assert read_audit(spark, log, day="2024-02-01").count() == 1


def test_a_repeated_name_is_rejected_not_multiplied(spark):
    one = records(spark, {"d1": FIELDS_A, "d2": FIELDS_C})
    twice = one.unionByName(records(spark, {"d2": FIELDS_A})).unionByName(records(spark, {"d3": FIELDS_A}))
    twice = twice.unionByName(records(spark, {"d3": FIELDS_A}))
    rows = [("d1", "city", "Salem"), ("d2", "city", "x"), ("d2", "state", "y"), ("d9", "city", None)]
    submitted = spark.createDataFrame(rows, "file string, field string, new_value string")
    batch = au.review_batch(submitted, twice, "ana")
    assert sorted((r.file, r.field) for r in batch.entries.collect()) == [("d1", "city"), ("d9", "city")]
    assert [tuple(r) for r in batch.rejects.collect()] == [("d2", 2, 2)]
    with pytest.raises(Exception, match="d2 names 2 documents"):
        au.record_review(submitted, twice, "ana").collect()
    assert au.record_review(submitted, one, "ana").count() == 4
    key_rows = spark.createDataFrame([("d1",), ("d2",), ("d2",)], "file string")
    assert [tuple(r) for r in sc.repeated_names(twice, key_rows).collect()] == [("d2", 2)]


def test_a_file_with_two_key_rows_counts_once(spark):
    classified = spark.createDataFrame(
        [(f, "A", "ok", "A") for f in ("d1", "d2", "d3")], "file string, layout string, status string, detected string"
    )
    key_rows = spark.createDataFrame(
        [("d1", "A"), ("d1", "A"), ("d2", "A"), ("d2", "B")], "file string, layout string"
    )
    report = reports.routing_report(classified, key_rows)
    got = {r.file: (r.expected, r.misrouted_vs_truth) for r in report.documents.collect()}
    assert got == {"d1": ("A", False), "d2": (None, False), "d3": (None, False)}
    assert [(r.file, r.layouts) for r in report.conflicts.collect()] == [("d2", ["A", "B"])]
    assert tuple(report.accuracy.first()) == (1, 1, 1.0)


def test_staged_tables_may_be_partitioned(spark):
    table = staged(spark.range(10).withColumn("half", F.col("id") % 2), "halves", ("half",))
    assert sorted(r.id for r in table.filter("half = 1").collect()) == [1, 3, 5, 7, 9]
