from __future__ import annotations

import gzip
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docflow.certificate import CERTIFICATES
from docflow.operators import audit as au
from docflow.sources.audit_log import append_audit, read_audit
from docflow.operators.frames import as_text
from docflow.sources.documents import assemble_documents, read_corpus, repeated_files, spread
from docflow.sources.scratch import scratch_path
from docflow.sources.truth import (
    key_parts,
    normalize_truth,
    read_truth,
    read_truth_layouts,
    truth_rejects,
)
from samples import FIELDS_A, by_file, records


def test_pages_are_joined_in_order(spark):
    """Hot, long, short and blank documents, against brute force."""
    rng = random.Random(7)
    pages = [("hot", n, f"p{n}") for n in range(300)]
    pages += [(f"d{i}", n, rng.choice(["x", "", None, "y\nz"])) for i in range(100) for n in range(i % 9)]
    rng.shuffle(pages)
    want: dict[str, list] = {}
    for file, _, text in sorted(pages, key=lambda p: (p[0], p[1])):
        want.setdefault(file, []).append(text or "")
    frame = spark.createDataFrame(pages, "file string, page_no int, text string")
    for run in (4096, 7):
        got = {r.file: r.text for r in assemble_documents(frame, pages_per_run=run).collect()}
        assert got == {file: "\n\n".join(texts) for file, texts in want.items()}


def test_corpus_from_text_files(spark, tmp_path):
    (tmp_path / "one.txt").write_text("first\nsecond\n")
    (tmp_path / "two.txt").write_text("é")
    got = {r.file: r.text for r in read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"one.txt": "first\nsecond\n", "two.txt": "é"}
    assert spread(read_corpus(spark, str(tmp_path)), 3).count() == 2


def test_page_plan_scans_once_and_deals_by_run(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("d", 1, "x")], "file string, page_no int, text string").write.parquet(path)
    plan = assemble_documents(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning(file") == 2 and ", run#" in plan.split("Exchange hash")[2]


def test_file_names_are_decoded_and_repeats_listed(spark, tmp_path):
    for folder in ("p", "q"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a b+é%.txt").write_text(folder)
        (tmp_path / folder / "deep é" / "x y").mkdir(parents=True)
        (tmp_path / folder / "deep é" / "x y" / "c.txt").write_text("\n")
    names = ["a b+é%.txt", "deep é/x y/c.txt"]
    want = sorted(f"{folder}/{name}" for folder in "pq" for name in names)
    for path in (tmp_path, f"file:{tmp_path}/", tmp_path / "*", tmp_path / "[pq]"):
        docs = read_corpus(spark, str(path))
        assert sorted(r.file for r in docs.collect()) == want, path
        assert repeated_files(docs).count() == 0
    assert {r.file for r in read_corpus(spark, str(tmp_path / "p")).collect()} == set(names)
    assert read_corpus(spark, str(tmp_path / "p" / names[0])).first().file == names[0]
    twice = docs.unionByName(docs.filter(F.startswith("file", F.lit("p"))))
    assert sorted(tuple(r) for r in repeated_files(twice).collect()) == [(f"p/{n}", 2) for n in names]


def test_files_are_read_as_by_sparks_reader(spark, tmp_path):
    """Odd names and contents; packed files; files that Hadoop's checksums guard."""
    names = ["a.txt", ".hidden", "_left", "_k=v", "_metadata", "_metadata=x", "_common_metadata", "c._COPYING_", "é [b]{c}*?#%.gzi"]
    for folder in ("", "folder=x%2Fy", "_out", "_k=w", "_metadata2", ".out", "d._COPYING_", "deep/er", "empty"):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        for i, name in enumerate(names if folder != "empty" else []):
            content = [b"\xef\xbb\xbfbom\r\n\n", b"\xff\xfe not UTF-8", b"a\0b", b"\xed\xa0\x80\n", b" "][i % 5]
            (tmp_path / "in" / folder / name).write_bytes(content + folder.encode())
        (tmp_path / "in" / folder / "blank.txt").touch()
    (tmp_path / "in" / "link.txt").symlink_to("a.txt")
    (tmp_path / "in" / "linked").symlink_to("deep")
    (tmp_path / "in" / "broken").symlink_to("nowhere")

    def rows(docs):
        return sorted(map(tuple, docs.select("file", F.hex("text"), F.length("text")).collect()))

    def both():
        ours = read_corpus(spark, str(tmp_path / "in"))
        place = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
        file = F.substring_index(place, f"{tmp_path}/in/", -1).alias("file")
        theirs = spark.read.text(str(tmp_path / "in"), wholetext=True, recursiveFileLookup=True)
        return ours, rows(ours), rows(theirs.select(file, F.col("value").alias("text")))

    ours, got, want = both()
    assert got == want and len(got) > 20 and ours.dtypes == [("file", "string"), ("text", "string")]
    for name in ("deep/p.txt.gz", "deep/er/P.GZIP"):
        (tmp_path / "in" / name).write_bytes(gzip.compress(b"packed"))
        ours, got, want = both()
        assert got == want and (name, b"packed".hex().upper(), 6) in got
        (tmp_path / "in" / name).write_bytes(b"")

    at = tmp_path / "sums"
    spark.createDataFrame([("x" * 3000,)], "text string").coalesce(1).write.text(str(at))
    (file,) = at.glob("part-*")
    assert read_corpus(spark, str(at)).first().text == "x" * 3000 + "\n" and (at / f".{file.name}.crc").exists()
    file.write_bytes(file.read_bytes()[:-2] + b"y\n")
    with pytest.raises(Exception, match="checksum error"):
        read_corpus(spark, str(at)).collect()
    assert read_corpus(spark, str(tmp_path / "in" / "empty")).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_corpus(spark, str(tmp_path / "none"))


def test_times_in_a_zone_with_a_gap(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.timestamp_micros(F.lit(1710037800000042))
        assert spark.range(1).select(au.iso_utc(at)).first()[0] == "2024-03-10T02:30:00.000042+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_numbers_as_text(spark):
    values = [(12_500_000.0, "12500000.0"), (0.0001, "0.0001"), (12.5, "12.5"), (1e30, "1.0E30"), (None, None)]
    frame = spark.createDataFrame([(v,) for v, _ in values], "v double")
    assert [r[0] for r in frame.select(as_text(F.col("v"), "double")).collect()] == [w for _, w in values]


def test_last_row_of_the_last_file_counts(spark, tmp_path):
    blank = "," * (len(CERTIFICATES.names) - 1)
    first = "".join(f"other{i},B,{blank}\n" for i in range(500))
    (tmp_path / "part-0.csv").write_text(f"{HEADER}\nd,A,{blank}\n{first}")
    (tmp_path / "part-1.csv").write_text(f"{HEADER}\nd,B,{blank}\nd,C,{blank}\n")
    got = {r.file: r.layout for r in read_truth_layouts(spark, str(tmp_path)).collect()}
    assert got["d"] == "C" and len(got) == 501


HEADER = "file,layout," + ",".join(CERTIFICATES.names)


def test_answer_key(spark, tmp_path):
    path = tmp_path / "key.csv"
    path.write_text(
        HEADER + "\n"
        "x,A,1,U,H,Salem,MA,Freight,4500,03/09/2024,03/09/2025,I,FAIL,2310.40,2\n"
        "y,C,2,U,H,Salem,MA,Freight,,02/30/2024,3/9/2025,I,PASS,12.x,none\n"
        "x,B,,,,,,,,,,,,,\n"
        'z,B,,,,,,,,01/13 or so/2024,,,,"1,000.00",\n'
    )
    truth = read_truth(spark, str(path))
    rows = normalize_truth(truth).collect()
    first = rows[0].asDict()
    assert first["capacity_lbs"] == 4500 and str(first["next_due"]) == "2025-03-09"
    assert first["invoice_total"] == 2310.40 and first["defect_count"] == 2
    assert rows[1].capacity_lbs is None and str(rows[1].next_due) == "2025-03-09"
    assert rows[2].cert_no is None
    rejects = {(r.file, r.field, r.value) for r in truth_rejects(truth).collect()}
    assert rejects == {
        ("y", "inspection_date", "02/30/2024"),
        ("y", "invoice_total", "12.x"),
        ("y", "defect_count", "none"),
        ("z", "inspection_date", "01/13 or so/2024"),
        ("z", "invoice_total", "1,000.00"),
    }
    layouts = {r.file: r.layout for r in read_truth_layouts(spark, str(path)).collect()}
    assert layouts == {"x": "B", "y": "C", "z": "B"}  # the last row of a file counts
    assert read_truth_layouts(spark, str(tmp_path / "no.csv")).collect() == []


def test_answer_key_columns_are_found_by_name(spark, tmp_path):
    """Each file by its own header: another order, further columns, quoted names, a BOM."""
    names = HEADER.split(",")
    key = tmp_path / "key"
    key.mkdir()
    rows = {}
    orders = [names, names[::-1], ["remark", *names[5:], "a, b", *names[:5]], ["\ufefffile", *names[1:]], [*names, "city"]]
    for i, order in enumerate(orders):
        lines = []
        for j in range(3):
            values = {n: f"{n} {i} {j}" for n in names} | {"remark": 'say "no"', "a, b": "x,y"}
            row = [values.get(n.removeprefix("\ufeff")) for n in order]
            if i == 4:
                row[-1] = values["city"] = "the last of a name"
            rows[values["file"]] = tuple(values[n] for n in names)
            lines.append(",".join('"' + v.replace('"', '""') + '"' for v in row))
        head = ",".join(f'"{n}"' if "," in n else n for n in order)
        (key / f"part {i}%.csv").write_text("\n".join(["", head, *lines]) + "\n")
    (key / "empty.csv").write_text("")
    got = {r.file: tuple(r) for r in read_truth(spark, str(key)).collect()}
    assert got == rows
    assert {r.file: r.layout for r in read_truth_layouts(spark, str(key)).collect()} == {f: r[1] for f, r in rows.items()}


def test_answer_key_without_a_column_is_refused(spark, tmp_path):
    path = tmp_path / "key.csv"
    path.write_text(HEADER.replace("city,", "") + "\n" + "," * 13 + "\n")
    with pytest.raises(ValueError, match=r"key\.csv lacks the columns \['city'\]"):
        read_truth(spark, str(path))
    assert read_truth_layouts(spark, str(path)).count() == 1  # needs two columns only


def test_large_plain_keys_are_split_and_broken_ones_are_not(spark, tmp_path):
    """A quoted line break, also among doubled quotes, makes a file one task's; others are split."""
    blank = "," * (len(CERTIFICATES.names) - 1)
    plain = [f'd{i},A,"x ""{i}"", y"{blank}' for i in range(4000)]
    broken = [f'e{i},B,"x ""\n{i}""\n\n y"{blank}' for i in range(4000)]
    (tmp_path / "plain.csv").write_text("\n".join([HEADER, *plain]) + "\n")
    (tmp_path / "broken.csv").write_text("\n".join([HEADER, *broken]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        parts = {p.files[0].rsplit("/")[-1]: p.broken for p in key_parts(spark, str(tmp_path), ("file", "layout"))}
        assert parts == {"plain.csv": False, "broken.csv": True}
        assert read_truth(spark, str(tmp_path / "plain.csv")).rdd.getNumPartitions() > 8
        assert read_truth(spark, str(tmp_path / "broken.csv")).rdd.getNumPartitions() == 1
        got = {r.file: r.cert_no for r in read_truth(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 8000
    assert got["d7"] == 'x "7", y' and got["e7"] == 'x "\n7"\n\n y'


def test_audit_log(spark, tmp_path):
    log = str(tmp_path / "var" / "audit")
    assert read_audit(spark, log).collect() == []
    old = records(spark, {"d1": {**FIELDS_A, "capacity_lbs": None}, "d2": FIELDS_A})

    def submit(rows, who, when):
        frame = spark.createDataFrame(rows, "file string, field string, new_value string")
        append_audit(au.record_review(frame, old, who, F.lit(when)), log)

    submit(
        [("d1", "capacity_lbs", "3500"), ("d1", "cert_no", "TH-77-0001"), ("d1", "city", None),
         ("d1", "shoe size", "44"), ("d9", "city", "Salem"), ("d9", "state", None)],
        "ana", "t1",
    )
    submit([("d1", "capacity_lbs", None), ("d2", "invoice_total", "2310.4")], "bo", "t2")
    got = {(r.timestamp, r.reviewer, r.file, r.field): (r.action, r.old_value, r.new_value)
           for r in read_audit(spark, log).collect()}
    assert got == {
        ("t1", "ana", "d1", "capacity_lbs"): ("correct", None, "3500"),
        ("t1", "ana", "d1", "cert_no"): ("approve", "TH-77-0001", "TH-77-0001"),
        ("t1", "ana", "d1", "city"): ("correct", "Salem", None),
        ("t1", "ana", "d1", "shoe size"): ("correct", None, "44"),
        ("t1", "ana", "d9", "city"): ("correct", None, "Salem"),
        ("t1", "ana", "d9", "state"): ("approve", None, None),
        ("t2", "bo", "d1", "capacity_lbs"): ("approve", None, None),
        ("t2", "bo", "d2", "invoice_total"): ("approve", "2310.4", "2310.4"),
    }
    entries = read_audit(spark, log)
    assert [r.timestamp for r in au.entries_for_file(entries, "d1").collect()] == ["t1"] * 4 + ["t2"]
    counts = {(r.file, r.timestamp): (r.approved, r.corrected)
              for r in au.decision_counts(entries).collect()}
    assert counts[("d1", "t1")] == (1, 3) and counts[("d1", "t2")] == (1, 0)
    state = by_file(au.review_state(spark.createDataFrame([("d1",), ("d3",)], "file string"), entries))
    assert {f: r.state for f, r in state.items()} == {"d1": "reviewed", "d3": "pending"}


def test_review_needs_a_reviewer_and_has_one_time(spark):
    frame = spark.createDataFrame([("d1", "city", " "), ("d1", "state", "x")],
                                  "file string, field string, new_value string")
    with pytest.raises(ValueError, match="reviewer"):
        au.record_review(frame, records(spark, {"d1": FIELDS_A}), "  ")
    blank = frame.withColumn("new_value", au.blank_to_null(F.col("new_value")))
    rows = au.record_review(blank, records(spark, {"d1": FIELDS_A}), "ana").collect()
    assert len({r.timestamp for r in rows}) == 1 and rows[0].timestamp.endswith("+00:00")
    assert {r.field: r.new_value for r in rows} == {"city": None, "state": "x"}


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
