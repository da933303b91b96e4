from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docflow.operators import extract as ex
from docflow.operators import gapfill as gf
from docflow.plans import reports
from docflow.sources.answers import ANSWER_SCHEMA, append_answers, first_answers, read_answers, read_failures
from samples import FIELDS_A, FIELDS_C, TEXT_A, by_file, documents, fields_of, records, text_c

ASK = gf.GapFill(model="m", prompt="p")


def counting(tmp_path, answer, tokens=(1_000_000, 1_000_000)):
    """A caller that leaves one file per call, whichever process it runs in."""
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def call(text, missing):
        import pathlib
        import uuid

        pathlib.Path(folder, uuid.uuid4().hex).write_text(",".join(missing))
        return dict(answer), *tokens

    return call, lambda: sorted(p.read_text() for p in calls.iterdir())


def test_gaps_are_filled_once_and_paid_once(spark, tmp_path):
    docs = documents(
        spark,
        {
            "a": TEXT_A.replace("Capacity", "Weight"),  # not a layout that is asked about
            "c full": text_c(),
            "c gap 1": text_c(load="pounds"),
            "c gap 2": text_c(load="pounds"),
            "c other": text_c(load="pounds", early=False),
            "c two gaps": text_c(load="pounds").replace("05/21/2025", "02/30/2025"),
        },
    )
    call, calls = counting(tmp_path, {"capacity_lbs": 4000, "next_due": "2025-06-01", "city": "X"})
    path = str(tmp_path / "answers")
    rows = by_file(reports.fill_gaps(docs, call, ASK, path, parallelism=2))
    # The copies share a request; another text or another set of gaps does not.
    assert calls() == ["capacity_lbs", "capacity_lbs", "capacity_lbs,next_due"]
    assert set(rows) == {"c full", "c gap 1", "c gap 2", "c other", "c two gaps"}
    full = rows["c full"]
    assert fields_of(full) == FIELDS_C and not full.called and full.fields_requested == []
    paid, copy = rows["c gap 1"], rows["c gap 2"]
    assert fields_of(paid) == fields_of(copy) == {**FIELDS_C, "capacity_lbs": 4000}  # city kept
    assert (paid.called, paid.from_cache, paid.cost_usd) == (True, False, 30.0)
    assert (copy.called, copy.from_cache, copy.cost_usd, copy.latency_seconds) == (True, True, 0, 0)
    assert paid.fields_filled == ["capacity_lbs"] and paid.latency_seconds > 0
    assert rows["c two gaps"].fields_filled == ["capacity_lbs", "next_due"]
    assert str(rows["c two gaps"].next_due) == "2025-06-01"

    again = by_file(reports.fill_gaps(docs, call, ASK, path))
    assert len(calls()) == 3
    assert all(r.from_cache and r.cost_usd == 0 for f, r in again.items() if f != "c full")
    assert {f: fields_of(r) for f, r in again.items()} == {f: fields_of(r) for f, r in rows.items()}
    # Another prompt is another question.
    reports.fill_gaps(docs, call, gf.GapFill(model="m", prompt="p2"), path)
    assert len(calls()) == 6


def test_a_failed_call_costs_only_itself(spark, tmp_path):
    good, calls = counting(tmp_path, {"capacity_lbs": 4000})

    def sometimes(text, missing):
        if "Bad" in text:
            raise ValueError("too many requests")
        return good(text, missing)

    names = ("One", "Two", "Bad", "Four")
    docs = documents(spark, {n: text_c(load="pounds", premises=n) for n in names})
    path = str(tmp_path / "answers")
    rows = by_file(reports.fill_gaps(docs, sometimes, ASK, path))
    assert {n for n, r in rows.items() if r.capacity_lbs == 4000} == {"One", "Two", "Four"}
    assert not rows["Bad"].called and len(calls()) == 3
    assert [r.error for r in read_failures(spark, path).collect()] == ["ValueError: too many requests"]
    again = by_file(reports.fill_gaps(docs, good, ASK, path))
    assert len(calls()) == 4 and again["Bad"].capacity_lbs == 4000 and not again["Bad"].from_cache


def test_waves_before_an_aborted_one_are_kept(spark, tmp_path):
    good, calls = counting(tmp_path, {"capacity_lbs": 4000})

    def stopping(text, missing):
        if len(calls()) >= 6:
            raise SystemExit("the worker ends")
        return good(text, missing)

    docs = documents(spark, {f"d{i}": text_c(load="pounds", premises=f"Hall {i}") for i in range(12)})
    path = str(tmp_path / "answers")
    requests = gf.plan_requests(ex.route(docs, layouts=ASK.layouts), ASK)
    pending = gf.pending_requests(requests, read_answers(spark, path))
    with pytest.raises(Exception):
        gf.answer_requests(pending, stopping, ASK, path, parallelism=1, wave_requests=2, concurrency=2)
    kept = read_answers(spark, path).count()
    assert 0 < kept <= 6
    gf.answer_requests(gf.pending_requests(requests, read_answers(spark, path)), good, ASK, path)
    assert read_answers(spark, path).count() == 12


def test_null_is_an_answer(spark, tmp_path):
    call, calls = counting(tmp_path, {"capacity_lbs": None}, tokens=(500, 15))
    docs = documents(spark, {"c": text_c(load="pounds")})
    row = reports.fill_gaps(docs, call, ASK, str(tmp_path / "answers")).first()
    assert row.called and row.capacity_lbs is None and row.fields_filled == []
    assert row.cost_usd == pytest.approx(500 / 1e6 * 5 + 15 / 1e6 * 25)


def test_coercion(spark):
    cases = [
        ("capacity_lbs", 3500.7, 3500), ("capacity_lbs", "3500", 3500),
        ("capacity_lbs", "3500.7", None), ("capacity_lbs", "not a number", None),
        ("capacity_lbs", [1], None), ("capacity_lbs", 10**30, None),
        ("invoice_total", "12.5", 12.5), ("invoice_total", 12, 12.0),
        ("next_due", "2027-04-02", "2027-04-02"), ("next_due", "20270402", "2027-04-02"),
        ("next_due", 20270402, "2027-04-02"), ("next_due", "2027", None),
        ("next_due", "2027-4-2", None), ("next_due", "2027-02-30", None),
        ("next_due", "0000-01-01", None), ("next_due", "2027-04-02\n", None),
        ("city", "Salem", "Salem"), ("city", "", ""), ("city", 5, "5"), ("city", None, None),
    ]
    rows = [(i, json.dumps({name: value})) for i, (name, value, _) in enumerate(cases)]
    rows += [(98, "no json"), (99, "[1]")]
    got = {r.i: r for r in gf.coerce_answers(spark.createDataFrame(rows, "i int, fields string")).collect()}
    for i, (name, _, want) in enumerate(cases):
        value = got[i][f"answered_{name}"]
        assert (str(value) if name == "next_due" and value else value) == want, cases[i]
    assert got[98].answered_city is None and got[99].answered_city is None


def test_first_answer_counts_and_hot_keys_are_shared_out(spark, tmp_path):
    """A third of all requests have one key: same result as brute force."""
    rows = {f"d{i:04}": {**FIELDS_A, "capacity_lbs": None} for i in range(600)}
    keys = [(f, "hot" if i % 3 == 0 else f"k{i % 70}") for i, f in enumerate(rows)]
    requests = (
        records(spark, rows)
        .join(spark.createDataFrame(keys, "file string, key string"), "file")
        .withColumns({"layout": F.lit("C"), "missing": F.array(F.lit("capacity_lbs"))})
    )
    answered = [
        (seq, key, json.dumps({"capacity_lbs": seq * 10}), 1, 1, 2.0, 0.5)
        for key in {k for _, k in keys if k != "k1"}
        for seq in ((3, 2) if key == "k2" else (2, 3))
    ]
    path = str(tmp_path / "answers")
    append_answers(spark.createDataFrame(answered, ANSWER_SCHEMA), path)
    answers = read_answers(spark, path)
    assert {r.seq for r in first_answers(answers).collect()} == {2}
    got = by_file(gf.apply_answers(requests, answers, run=2))
    assert len(got) == 600
    payer = {}
    for file, key in sorted(keys):
        payer.setdefault(key, file)
    for file, key in keys:
        row = got[file]
        known = key != "k1"
        assert row.capacity_lbs == (20 if known else None) and row.called == known
        assert row.cost_usd == (2.0 if known and payer[key] == file else 0.0)
        assert row.from_cache == (known and payer[key] != file)


def test_requests(spark, tmp_path):
    routed = ex.route(documents(spark, {"c": text_c(load="pounds"), "full": text_c()}))
    requests = gf.plan_requests(routed, ASK)
    rows = by_file(requests)
    assert rows["full"].key is None and rows["full"].text is None and rows["full"].missing == []
    schema = requests.filter("key IS NOT NULL").select(
        gf.request_schema(F.array(F.lit("capacity_lbs"), F.lit("next_due"), F.lit("city")))
    )
    assert json.loads(schema.first()[0]) == {
        "type": "object",
        "properties": {
            "capacity_lbs": {"type": ["integer", "null"]},
            "next_due": {"type": ["string", "null"], "format": "date"},
            "city": {"type": ["string", "null"]},
        },
        "required": ["capacity_lbs", "next_due", "city"],
        "additionalProperties": False,
    }
    key = {
        name: requests.filter("file = 'c'").select(gf.request_key(c, F.array(*map(F.lit, m)), F.lit(t))).first()[0]
        for name, c, m, t in [
            ("base", ASK, ["a", "b"], "t"), ("order", ASK, ["b", "a"], "t"), ("text", ASK, ["a", "b"], "u"),
            ("fields", ASK, ["a"], "t"), ("prompt", gf.GapFill("m", "q"), ["a", "b"], "t"),
            ("model", gf.GapFill("n", "p"), ["a", "b"], "t"),
        ]
    }
    assert key["base"] == key["order"] and len(set(key.values())) == 5
    with pytest.raises(ValueError, match="#"):
        gf.GapFill(model="a#b", prompt="p")


def test_report(spark, tmp_path):
    docs = documents(spark, {"c1": text_c(), "c2": text_c(load="pounds"), "a": TEXT_A})
    call, _ = counting(tmp_path, {"capacity_lbs": 2750}, tokens=(200_000, 0))
    path = str(tmp_path / "answers")
    key = records(spark, {"c1": FIELDS_C, "c2": FIELDS_C, "gone": FIELDS_C, "a": FIELDS_A})
    key = key.withColumn("layout", F.when(F.col("file") == "a", "A").otherwise("C"))
    first = gf.gapfill_report(reports.fill_gaps(docs, call, ASK, path), key, ASK).first()
    assert (first.documents, first.without_extraction, first.needing) == (3, 1, 1)
    assert (first.fresh_calls, first.cache_hits, first.fields) == (1, 0, 26)
    assert (first.accuracy_before, first.accuracy_after) == (25 / 26, 1.0)
    assert first.total_cost_usd == first.cost_per_needing_usd == 1.0
    assert first.cost_per_document_usd == pytest.approx(1 / 3) and first.mean_fresh_latency_seconds > 0
    again = gf.gapfill_report(reports.fill_gaps(docs, call, ASK, path), key, ASK).first()
    assert (again.fresh_calls, again.cache_hits, again.total_cost_usd) == (0, 1, 0.0)
    assert again.mean_fresh_latency_seconds is None
