"""Spelling variants against plain Python that compares all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from check_oracles import connect, differences
from docflow.llm import queries, spelling, sql

SCHEMA = "doc_id long, text string, word string, n long, signature long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 7, 8) for i, t in rows], SCHEMA)


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, ratio=10):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    next_to = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and near(a, b):
            next_to[a].append(b)
            next_to[b].append(a)
    form = {}
    for w, others in next_to.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        (w, form[w], root(w), n, len(next_to[w]), words[form[w]] if form[w] else None) for w, n in words.items()
    )


def result(spark, rows):
    got = spelling.variants(frame(spark, rows)).collect()
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    """Words of few letters, so that many are rearrangements or neighbours of others."""
    rng = random.Random(seed)
    letters = "aÀ÷" if seed else "ab"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(300)]
    rows = []
    for i in range(80):
        chosen = [words[min(int(rng.expovariate(0.02)), len(words) - 1)] for _ in range(60)]
        rows.append((i, rng.choice((" ", "\n", "1", "-×" if seed else "- ")).join(chosen)))
    got = result(spark, rows)
    assert got == brute(rows)
    assert any(r[1] for r in got) and max(r[4] for r in got) > 2


def test_every_near_pair_shares_a_signature():
    rng = random.Random(9)
    for _ in range(3000):
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 14)))
        at = rng.randrange(len(word))
        other = rng.choice((word[:at] + rng.choice("abcéz") + word[at + 1 :], word[:at] + rng.choice("az") + word[at:]))
        if near(word, other):
            a, b = spelling.signatures(word), spelling.signatures(other)
            assert set(a[0]) & set(b[0]) and a[1] != b[1], (word, other)


def test_signatures_are_what_finds_the_pairs(spark, monkeypatch):
    """Without signatures in common nothing is found, whatever the check after them."""
    words = spark.createDataFrame([("abcdefg", 5), ("abcdefgh", 50), ("zzzzzzz", 3)], "word string, n long")
    assert [tuple(r) for r in spelling.near_pairs(words).collect()] == [("abcdefg", 5, "abcdefgh", 50)]
    keyed = spelling.with_signatures(words)
    monkeypatch.setattr(spelling, "with_signatures", lambda *_: keyed.selectExpr("signature + n AS signature", "letters", "word", "n"))
    assert spelling.near_pairs(words).count() == 0


def test_chains_lead_to_the_last_form(spark):
    """Each word ten times as common as the one before it: every root is the last."""
    chain = ["wandern", "wandernd", "wanderndx", "wanderndxy"]
    words = [(w, 3 * 11**i) for i, w in enumerate(chain)]
    rows = [(None, " ".join([w] * n)) for w, n in words]
    rows = [(i, t) for i, (_, t) in enumerate(rows, 1000)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert {r[2] for r in got if r[0] in chain} == {chain[-1]}


def test_odd_rows(spark):
    long = "abcdefghij" * 5000
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "wandern wandern"), (4, "wandern wandern"), (5, "WANDERN Wandern"),
        (None, "wanderm wanderm"), (6, f"{long} {long}x"), (7, f"{long} {long}x"), (8, "ÀÉÎÕÜŸß àéîõüÿß " * 40),
        (9, "𝒳wandern𝒳 wanderń"), (10, "a" * 100_000), (11, "a" * 100_000),
    ]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[:3]) == [] and spelling.variants(frame(spark, rows).limit(0)).count() == 0


def test_query_matches_its_sql_and_brute_force(spark, sf_dir):
    got = queries.op13_spelling_variants(spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, connect(sf_dir).execute(sql.oracle_sql()["op13_spelling_variants"]).df()) is None
