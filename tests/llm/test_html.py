"""Main text: pages with known articles, names that mislead, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from docflow.llm import html_text as ht

SENTENCES = "One two, three four. Five six; seven eight! Nine ten, eleven twelve. Is it so? It is, in part."


def built(seed):
    """A page and its article's text."""
    rng = random.Random(seed)

    def words(n, marks=True):
        out = [rng.choice("lorem ipsum dolor sit amet tempor magna aliqua".split()) + (rng.choice(["", "", ",", "."]) if marks else "") for _ in range(n)]
        return " ".join(out) + ("." if marks else "")

    blocks = [("h1", words(4, False))]
    for _ in range(rng.randint(2, 9)):
        kind = rng.choice(["p", "p", "p", "h2", "ul", "blockquote", "pre"])
        if kind == "ul":
            blocks += [("ul", [words(rng.randint(2, 9), False) for _ in range(rng.randint(1, 4))])]
        else:
            blocks.append((kind, words(rng.randint(3, 80), kind != "h2")))
    blocks.append(("p", words(60)))
    body, text = "", []
    for tag, content in blocks:
        if tag == "ul":
            body += "<ul>" + "".join(f"<li>{c}" for c in content) + "</ul>\n"
            text += content
        else:
            body += f"<{tag}>{content.replace(' lorem', '  <b>lorem</b>')}</{tag}>\n"
            text.append(content)
    links = lambda n: "".join(f"<li><a href=/{i}>{words(2, False)}</a></li>" for i in range(n))
    junk = [
        f"<nav><ul>{links(6)}</ul></nav>", f"<div class='cookie-banner'><p>{words(14)}</p></div>",
        f"<div class='site-sidebar'><h3>Read on</h3><ul>{links(5)}</ul></div>", "<script>if (a < b) { p('<p>no</p>') }</script>",
        f"<form><p>{words(8)}</p><input></form>", f"<style>p {{ color: red }}</style><aside><p>{words(12)}</p></aside>",
    ]
    rng.shuffle(junk)
    wrapper = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post no-comments'>", "</div>"), ("<div id=c1>", "</div>")])
    after = f"<section class=comments><p>{words(20)}</p></section><footer><p>{words(9)}</p></footer>"
    page = f"<!doctype html><html><head><title>x</title></head><body>{''.join(junk[:3])}{wrapper[0]}{body}{wrapper[1]}{''.join(junk[3:])}{after}</body></html>"
    return page, "\n\n".join(text)


@pytest.mark.parametrize("seed", range(60))
def test_known_articles(seed):
    page, text = built(seed)
    assert ht.main_text(page) == text


def test_names_that_mislead():
    text = f"<h1>Title here</h1><p>{SENTENCES}</p><p>{SENTENCES}</p>"
    want = f"Title here\n\n{SENTENCES}\n\n{SENTENCES}"
    menu = "<nav><a href=/>a</a></nav>"
    for names in ("content has-sidebar", "post no-comments", "recipe-cookies", "text-overlay-wrapper", "share-prices"):
        assert ht.main_text(f"<body>{menu}<div class='{names}'>{text}</div></body>") == want, names
        assert ht.main_text(f"<body><article><div class='{names}'>{text}</div></article></body>") == want, names
    own = f"<article><h1>A</h1><p id=share-prices>{SENTENCES}</p><h2 id='copyright-law'>On law</h2><p class=notice>x, y.</p><p>{SENTENCES}</p></article>"
    assert ht.main_text(own) == f"A\n\n{SENTENCES}\n\nOn law\n\n{SENTENCES}"
    assert ht.main_text("<p>Let <math><mi>x</mi> &lt; <mn>2</mn></math> hold, then.</p>") == "Let x < 2 hold, then."


def test_the_ratios_decide(monkeypatch):
    """A piece beside the article that no name gives away: few letters, no punctuation, one container."""
    days = [f"day {i}" for i in range(12)]
    page = (
        f"<body><div class=x1><div class=x2><h1>Title</h1><p>{SENTENCES}</p><ul><li>one item<li>two</ul><p>{SENTENCES}</p></div>"
        f"<div class=x3>{''.join(f'<div><span>{d}</span></div>' for d in days)}</div></div></body>"
    )
    want = f"Title\n\n{SENTENCES}\n\none item\n\ntwo\n\n{SENTENCES}"
    assert ht.main_text(page) == want
    monkeypatch.setattr(ht, "scores", lambda blocks, lowered: np.ones(len(blocks)))
    assert ht.main_text(page) == "\n\n".join([want, *days])


def test_paths_share_their_ratio():
    """A one-word paragraph has the value of the long ones' path, were it not for its neighbours."""
    blocks = ht.blocks_of(f"<div><p>{SENTENCES}</p><p>Yes.</p><p>{SENTENCES}</p></div>")
    value = ht.scores(blocks, np.zeros(3, bool))
    assert np.allclose(value, value[0])
    assert not ht.hinted(blocks).any()


def test_odd_rows(spark):
    page, text = built(1)
    rows = [
        (1, "u", None), (2, "u", ""), (3, "u", " \n"), (4, "u", page), (4, "u", page), (None, None, page), (5, "u", "no tags & all"),
        (6, "u", "<" * 5000), (7, "u", "<div>" * 3000 + "deep, text." + "</div>" * 3000), (8, "u", f"<p>{'a, b. ' * 60_000}</p>"),
        (9, "u", "<nav>a</nav>"),
    ]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, _html string")
    got = ht.extract(docs, keep=("page_id", "url", "_html")).collect()
    assert len(got) == len(rows) and all(r["_html"] == "mine" and r["n_chars"] == len(r["text"]) for r in got)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[9] == "" and by_id[4] == by_id[None] == text
    assert by_id[5] == "no tags & all" and by_id[7] == "deep, text." and len(by_id[8]) == 6 * 60_000 - 1
    assert ht.extract(docs.limit(0)).count() == 0
