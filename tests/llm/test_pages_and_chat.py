"""HTML extraction, chat formatting, language-model scores and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from docflow.llm import chat, html_text, lm_score, queries
from docflow.llm.template import Const, Output, TemplateError, compile_template, fold, parse


def test_article_without_what_surrounds_it():
    page = (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>Home<li>News</ul></nav>"
        "<!-- <p>no</p> --><div class='cookie-notice'><p>We use cookies, and so on, and on.</p></div>"
        "<article><h1>A &amp; B</h1><p><b>First  paragraph,\n with text.<br><p>Second &eacute; one, longer than it."
        "<ul><li>x<li>y</ul><div class=\"ad\">Buy, buy, buy.</div><p>Short."
        "<section id=comments><p>A reader says, at length, this and that.</p></section></article>"
        "<aside>Aside.</aside><form>Name <input></form><script>var t='</p>';</script><footer>&copy; 2024</footer></body>"
    )
    want = ["A & B", "First paragraph, with text.", "Second é one, longer than it.", "x", "y", "Short."]
    assert html_text.article(page) == want


@pytest.mark.parametrize("page", [None, "", "   ", "<nav>a</nav>", "<!--", "<script>x", "<p", "a < b" * 3])
def test_pages_of_no_use_do_not_fail(page):
    assert html_text.main_text(page) == ("a < ba < ba < b" if page and "b" in page else "")


def test_html_query_keeps_every_row(spark, sf_dir):
    rows = queries.op2_html_extraction(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) and "<" not in r["text"][:1] for r in rows)


def test_template_language():
    assert fold(parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}"), {}) == (Output(Const("abcd")),)
    render = compile_template(
        "{% for m in ms -%} {{ loop.index }}{{ m['t'] | up }}{% generation %}g{% endgeneration %}{% endfor %}", {"up": str.upper}
    )
    assert render({"ms": [{"t": "a"}, {"t": "b"}]}) == ("1Ag2Bg", [(2, 3), (5, 6)])


@pytest.mark.parametrize("source", ["{{ a.__class__ }}", "{{ x }}", "{{ a | nothing }}", "{% if a %}", "{{ a() }}", "{% end %}", "{{ 1 %}"])
def test_template_sandbox(source):
    with pytest.raises(TemplateError):
        compile_template(source, {})({"a": "text"})


@pytest.mark.parametrize("text", ["", "\\n", "\n", "<s>", "[INST]\\", "<\\s>", "<|im_end|>\n<|im_start|>user\nx", "\\\\<</SYS>>"])
def test_escapes_are_undone(text):
    escaped = chat.escape_line(text)
    assert chat.unescape(escaped) == text and chat.unescape(chat.escape(text)) == text
    assert not any(c in escaped for c in chat.CONTROL)


def test_chat_query_reads_back(spark, sf_dir):
    import pyarrow.parquet as pq

    turns = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    text = queries.CONTROL_TEXT
    turns += [{"conv_id": -7, "turn": i, "role": r, "text": text} for i, r in enumerate(("user", "assistant"))]
    want = {}
    for t in sorted(turns, key=lambda t: (t["conv_id"], t["turn"])):
        want.setdefault(t["conv_id"], []).append((t["role"], t["text"] or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = queries.op5_chat_formatting(spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        own = want[r["conv_id"]]
        loss = "".join(t for role, t in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in own))
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == sha(loss)


def test_chat_defined_cases(spark):
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (5, None, "assistant", "x"), (5, 2, "user", "y"), (5, 2, "user", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: chat.read_back(r["formatted"]) for r in chat.format_conversations(frame).collect()}
    assert got == {None: [("", ""), ("user", "a")], 5: [("assistant", "x"), ("user", "y"), ("user", "y")]}
    assert chat.format_conversations(frame.limit(0)).collect() == []


def test_lm_scores_do_not_depend_on_chunks_and_parts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "doc_id % 3 = 0 as good")
    a = {r["doc_id"]: r for r in lm_score.score(docs, "good").collect()}
    b = {r["doc_id"]: r for r in lm_score.score(docs.repartition(3), "good", chunk_words=2000, part_bytes=10_000).collect()}
    assert a.keys() == b.keys() and len(a) == docs.count()
    assert all(abs(a[k]["score"] - b[k]["score"]) < 1e-9 for k in a)


def test_lm_scores_tell_the_target(spark):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * (i % 5 + 2), i % 2 == 1 and i < 30) for i in range(40)]
    rows += [(100, None, True), (101, "", None)]
    got = {r["doc_id"]: r for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string, good boolean"), "good").collect()}
    assert all((got[i]["score"] < 0) == (i % 2 == 1) for i in range(40))
    assert got[100]["score"] is None and got[101]["n_words"] == 0
    assert lm_score.score(spark.createDataFrame([], "doc_id long, text string, good boolean"), "good").collect() == []


def plain_lm_scores(rows, weight=lm_score.BIGRAM_WEIGHT):
    """(words, target loss, background loss) of each row, every count taken anew from all other rows."""
    texts = [re.findall("[0-9a-z\x80-\U0010ffff]+|[!-/:-@\\[-`{-~]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t, _ in rows]
    sides = [bool(good) for *_, good in rows]
    vocabulary = max(len({w for t in texts for w in t}), 1)
    totals = [sum(len(t) for t, s in zip(texts, sides) if s == side) for side in (True, False)]
    scales = [1.0, totals[0] / totals[1] if all(totals) else 1.0]
    found = []
    for i, text in enumerate(texts):
        means = []
        for side, scale in zip((True, False), scales):
            others = [t for j, t in enumerate(texts) if j != i and sides[j] == side]
            words = Counter(w for t in others for w in t)
            pairs = Counter(p for t in others for p in zip(t, t[1:]))
            n, loss = sum(map(len, others)), 0.0
            for at, word in enumerate(text):
                chance = (words[word] * scale + 1) / (n * scale + vocabulary)
                first = text[at - 1] if at else None
                if first is not None and words[first]:
                    chance = weight * pairs[first, word] / words[first] + (1 - weight) * chance
                loss -= math.log(chance)
            means.append(loss / len(text) if text else None)
        found.append((len(text), *means))
    return found


@pytest.mark.parametrize("chunk_words", [1, 25, lm_score.CHUNK_WORDS])
@pytest.mark.parametrize("good", [(True, False, None), (True,), (False, None)])
def test_lm_scores_match_plain_python(spark, chunk_words, good):
    """Nulls, empty texts, a long one, repeated rows and ids, further columns; one side without documents."""
    rng = random.Random(7)
    vocabulary = ["Ab", "ab", "c!", "d-e", "ÉÜ", "éü", "x", "9", "𝒳y"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(24)]
    texts += [None, "", " \n", "once", "once", "a b a", " ".join(rng.choices(vocabulary, k=3000)), texts[0], texts[0]]
    rows = [(i % 20, t, good[i % len(good)]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, good boolean, flag string")
    got = lm_score.score(docs, "good", chunk_words=chunk_words, part_bytes=64).collect()
    want = [(r[0], *p) for r, p in zip(rows, plain_lm_scores(rows))]

    def numbers(row):
        return tuple(-1.0 if x is None else float(x) for x in row)

    names = ("doc_id", "n_words", "target_loss", "background_loss")
    rows_got = sorted(numbers(r[name] for name in names) for r in got)
    assert np.allclose(rows_got, sorted(map(numbers, want)), rtol=0, atol=1e-9)
    assert all(r["score"] is None if not r["n_words"] else abs(r["score"] - r["target_loss"] + r["background_loss"]) < 1e-12 for r in got)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir).toPandas()
        if name != "best_fit_packing":
            assert list(result.columns) == docs.columns and (last is None or len(result) <= last)
            last = len(result)
            docs = spark.createDataFrame(result, docs.schema)
    assert result["doc_id"].nunique() == last
