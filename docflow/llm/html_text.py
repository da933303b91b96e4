"""Main text of web pages by tag-path ratios.

A page is read once into blocks: the texts of block elements, each with the path of
block elements from the root to it. Per path the text length and the punctuation
marks of its blocks are summed and divided by the number of its blocks. Both ratios,
laid out in page order, are smoothed with a Gaussian kernel and fused by
multiplication; blocks whose value reaches the deviation of all values are content.
A path's ratio is shared by all its blocks, so a short paragraph is kept with the
long ones beside it. The region that holds the content is the deepest sectioning
element around nearly all of its text. In it, what is content is kept, and with it
the headings, lists and other small blocks of a container that holds content; a
container without any, and one that is mostly links, is not.

Elements that are no content by their meaning take no part: navigation, forms, page
headers and footers, asides, scripts, hidden ones. A class, id or role that says menu,
advert, notice, comments and so on (``HINTS``) only lowers the value of its blocks and
keeps them from going along with others; and it counts for nothing on an element that
holds most of the page's text, or on a single paragraph or heading unless the whole
name is such a word.

Inline elements and line breaks do not end a block; unclosed paragraphs, list items
and table cells end where the next starts. Defined cases: a null or empty page has an
empty text, and so has a page of boilerplate only; a page without tags is one block;
rows with equal ids are rows of their own; an empty table gives no rows; further
columns are ignored, except those named in ``keep``.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import shielded, small_batches

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset(
    "head nav aside footer form button select option datalist template svg canvas object audio video "
    "dialog menu fieldset map applet".split()
)
# Elements of text rather than of layout.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th caption figcaption summary".split())
# Elements that hold a piece of a page, not one of its texts.
CONTAINERS = frozenset("html body article main section div center details figure td th".split())
SECTIONS = frozenset("html body article main section div center table tbody tr td".split())
HINTS = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup signin "
    "login share sharing social related recommended recommendations sidebar widget widgets menu nav navbar "
    "navigation topbar breadcrumb breadcrumbs pagination pager footer masthead comment comments disqus respond "
    "replies reply toolbar copyright disclaimer skip outbrain taboola search contentinfo complementary menubar".split()
)
# What an opening tag closes, and up to which element it looks for it.
CLOSES = {
    "body": ("head", ("html",)),
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
}
MARKS = re.compile("[.,;:!?、。，！？；…]")
SMOOTHING = (0.25, 0.5, 0.25)
REGION_SHARE = 0.9
# A hinted element with the first share of the page's text is its content, and so is one
# with the second share if no paragraph or title stands outside all hinted ones.
HINT_SHARES = (0.8, 0.5)
HINT_FACTOR = 0.1

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)")
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    elements: tuple[int, ...]
    text: str
    linked: int  # characters inside links
    hinted: tuple[int, ...]  # the elements around it whose names say boilerplate


def _boilerplate(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is none of the page's content, and whether its names hint at that."""
    if tag in BOILERPLATE or tag == "header" and not inside_article:
        return True, False
    if tag in ("html", "body", "article", "main") or not attributes:
        return False, False
    if re.search(r"(?:^|\s)hidden(?=[\s=/]|$)", attributes, re.I):
        return True, False
    hinted = False
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "style":
            if _HIDDEN.search(value):
                return True, False
        elif name == "aria-hidden":
            if value.lower() == "true":
                return True, False
        elif tag in TEXTUAL:
            hinted |= bool({w.lower() for w in value.split()} & HINTS)
        else:
            words = {w.lower() for w in _PARTS.findall(value)}
            hinted |= bool(words & HINTS) or "header" in words and not inside_article
    return False, hinted


def blocks_of(page: str) -> list[Block]:
    """The page's blocks that are no boilerplate by meaning, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, bool]] = []  # (tag, boilerplate, number, hinted)
    made, articles, dropping, links = 0, 0, 0, 0
    texts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if texts:
            text = " ".join(entities.unescape("".join(texts)).split())
            if text:
                live = [e for e in stack if e[0] in BLOCK]
                hinted = tuple(e[2] for e in stack if e[3])
                out.append(Block(tuple(e[0] for e in live), tuple(e[2] for e in live), text, linked, hinted))
            texts.clear()
        linked = 0

    def pop_to(size: int) -> None:
        nonlocal articles, dropping
        while len(stack) > size:
            tag, dropped, _, _ = stack.pop()
            articles -= tag in ("article", "main")
            dropping -= dropped

    def last(tags: tuple[str, ...], stops: tuple[str, ...] = ()) -> int | None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stops:
                return None
        return None

    def add(text: str) -> None:
        nonlocal linked
        if text and not dropping:
            texts.append(text)
            linked += len(text) if links else 0

    at = 0
    while True:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        after = page[lt + 1 : lt + 2]
        if after in ("!", "?"):
            comment = page.startswith("<!--", lt)
            end = page.find("-->" if comment else ">", lt + (4 if comment else 2))
            at = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        m = _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK or any(e[0] == tag for e in stack):
                if tag in BLOCK:
                    flush()
                found = last((tag,), () if tag in BLOCK else tuple(BLOCK))
                if found is not None:
                    pop_to(found)
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = len(page) if not end else page.find(">", end.start()) + 1 or len(page)
            continue
        if tag == "a":
            links += 1
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            flush()
            links = 0
            opened = last(("p",), ("article", "body", "button", "td", "th", "table"))
            if opened is not None:
                pop_to(opened)
            if tag in CLOSES:
                closes, stops = CLOSES[tag]
                opened = last(tuple(closes.split()), stops)
                if opened is not None:
                    pop_to(opened)
        if tag in VOID:
            continue
        dropped, hinted = _boilerplate(tag, attributes, articles > 0)
        if tag in BLOCK or dropped or hinted:
            if attributes.endswith("/") and tag not in BLOCK:
                continue
            made += 1
            stack.append((tag, dropped, made, hinted))
            articles += tag in ("article", "main")
            dropping += dropped
    flush()
    return out


def hinted(blocks: list[Block]) -> np.ndarray:
    """Whether each block lies in an element whose names say boilerplate and that is not most of the page."""
    total = sum(len(b.text) for b in blocks)
    other = any(not b.hinted and b.path[-1:] and b.path[-1] in ("p", "h1") for b in blocks)
    share = HINT_SHARES[0] if other else HINT_SHARES[1]
    held: dict[int, int] = {}
    for b in blocks:
        for e in b.hinted:
            held[e] = held.get(e, 0) + len(b.text)
    return np.array([any(held[e] < share * total for e in b.hinted) for b in blocks], bool)


def scores(blocks: list[Block], lowered: np.ndarray) -> np.ndarray:
    """Each block's fused value: its path's smoothed text ratio times its smoothed punctuation ratio.

    Hinted blocks have paths of their own, whose ratios are lowered before the smoothing.
    """
    keys = [(b.path, bool(low)) for b, low in zip(blocks, lowered)]
    sums: dict[tuple, list[float]] = {}
    for b, key in zip(blocks, keys):
        held = sums.setdefault(key, [0.0, 0.0, 0.0])
        held[0] += len(b.text) - b.linked
        held[1] += len(MARKS.findall(b.text))
        held[2] += 1
    ratios = np.array([[sums[k][0] / sums[k][2], sums[k][1] / sums[k][2]] for k in keys])
    ratios[lowered] *= HINT_FACTOR
    padded = np.pad(np.maximum(ratios, 0), ((1, 1), (0, 0)), mode="edge")
    n = len(blocks)
    smooth = sum(w * padded[i : i + n] for i, w in enumerate(SMOOTHING))
    return smooth[:, 0] * (1 + smooth[:, 1])


def _container(block: Block) -> tuple[int, bool]:
    """The innermost element around a block that is a container, and whether an article or main is around it."""
    inner = next((e for tag, e in zip(block.path[::-1], block.elements[::-1]) if tag in CONTAINERS), 0)
    return inner, "article" in block.path or "main" in block.path


def article(page: str) -> list[str]:
    """The texts of the article's blocks, in page order."""
    blocks = blocks_of(page)
    if not blocks:
        return []
    lowered = hinted(blocks)
    value = scores(blocks, lowered)
    content = (value >= min(value.std(), value.max())) & ~lowered
    mass = np.array([len(b.text) for b in blocks]) * content
    region = np.ones(len(blocks), bool)
    depth = 0
    while True:
        # Text of each element one level down, and whether a heading stands outside it.
        held: dict[int, float] = {}
        tags: dict[int, str] = {}
        for b, m, here in zip(blocks, mass, region):
            if here and len(b.elements) > depth:
                held[b.elements[depth]] = held.get(b.elements[depth], 0) + m
                tags[b.elements[depth]] = b.path[depth]
        if not held:
            break
        best = max(held, key=lambda e: (held[e], -e))
        share = 0.5 if tags[best] in ("article", "main") else REGION_SHARE
        if tags[best] not in SECTIONS or held[best] < share * mass[region].sum():
            break
        inside = np.array([here and len(b.elements) > depth and b.elements[depth] == best for b, here in zip(blocks, region)])
        outside = [b for b, here, into in zip(blocks, region, inside) if here and not into]
        if share == REGION_SHARE and any(b.path[-1:] and b.path[-1] in ("h1", "h2") for b in outside):
            break
        region = inside
        depth += 1
    # Small blocks go along with the content of their container; a piece of an article
    # that holds no content by itself does too.
    holders = {_container(b)[0] for b, here, chosen in zip(blocks, region, content) if here and chosen}
    kept = []
    for b, here, chosen, low in zip(blocks, region, content, lowered):
        inner, marked = _container(b)
        if here and not low and (chosen or (inner in holders or marked) and 2 * b.linked <= len(b.text)):
            kept.append(b.text)
    return kept


def main_text(page: str | None) -> str:
    return "\n\n".join(article(page or ""))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, the main ``text`` and its length ``n_chars``, one row per page.

    Kept columns may have any names; see ``common.shielded`` for those of results.
    """
    small_batches(pages.sparkSession)
    pages, keep, back = shielded(pages, keep, (html_col,), ("text", "n_chars"))
    picked = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    schema = T.StructType(
        picked.schema.fields[:-1] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return back(picked.mapInArrow(run, schema))
