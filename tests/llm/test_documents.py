"""Operators on document texts against plain Python over the same rows."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from docflow.llm import decontaminate, line_dedup, packing, pii, quality, queries, sharding, simhash

SCHEMA = "doc_id long, text string, lang string, source string, fp long, _row long, n_words long, group string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 7, 7, 7, "x") for i, t in rows], SCHEMA)


ODD_ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "one"), (None, "a null id"), (6, "é ß 𝒳 " * 5000),
    (7, "x" * 100_000), (8, "1 " * 30_000),
]


def rows_of(sf_dir, name):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


# -- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, m.end()))
    return sorted(out)


def test_pii_base_matches_plain_patterns(spark):
    rng = random.Random(4)
    bits = ["a.b@c.de", "@", "x@y", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (206) 555-0100",
            ".", "-", " ", "1", "25", "é", "𝒳", "+44", "_", "\n", "a@b.cc_d@e.ff", "001.002.003.004", "12", "4381893557741609"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(600)]
    rows = [*enumerate(texts, 100), *ODD_ROWS]
    got = pii.with_base(frame(spark, rows), F.coalesce("text", F.lit(""))).select("text", "base").collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r["base"]] == base_spans(r["text"] or ""), r["text"]


def test_pii_runs_and_context_words_of_any_length(spark):
    """A pattern of long words, met with five seeds, finds an address of 300 characters."""
    left, right = "w" * 90, "v" * 120
    rows = [(i, f"{left}a {left} write{left} user{i}@host{i}.org {right} {right}b") for i in range(8)]
    # Addresses without a dot have the shape, but no seed; another long word makes another context.
    rows += [(100, f"{left}a {left} write{left} {'x' * 290}@intranet {right} {right}b")]
    rows += [(200 + i, f"{left}c {left} writes{left} other{i}@ {right}c {right}b") for i in range(9)]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, rows)).collect()}
    assert [s["end"] - s["start"] for s in got[100]] == [299]
    assert all(len(got[i]) == 1 for i in range(8)) and all(not got[200 + i] for i in range(9))


def test_pii_rounds_go_on_while_something_is_found(spark):
    """A chain of contexts, each learnt from what the one before it found: four rounds, and one that finds nothing."""
    sizes = [2100, 460, 100, 20, 4]
    names = [[f"seed{i}@host.org" for i in range(sizes[0])]]
    names += [[f"l{link}x{i}@local" for i in range(size)] for link, size in enumerate(sizes[1:])]
    texts = [
        f"go{link} see{link} {name} then{link} stop{link}"
        for place, link in enumerate("abcd")
        for name in names[place] + names[place + 1]
    ]
    got = pii.find_pii(frame(spark, enumerate(texts))).collect()
    missed = [texts[r["doc_id"]] for r in got if len(r["spans"]) != 1]
    assert len(got) == len(texts) and not missed, (len(missed), missed[:3])


def test_pii_query_on_the_tables(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in rows_of(sf_dir, "documents")}
    got = queries.op1_pii(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        base = base_spans(texts[r["doc_id"]])
        listed = [f"{list(BASE)[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(listed) <= set(r["spans"].split(","))


def test_pii_contexts_find_unseen_identifiers(spark):
    seen = [(i, f"please mail to user{i}@mail.example.org for more") for i in range(8)]
    rows = [*seen, (90, "please mail to someone@intranet for more"), (91, "we saw 12@99 in a log")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find_pii(frame(spark, rows))).collect()}
    assert got[90] == "email:15:31"
    assert got[91] == ""


def test_pii_empty(spark):
    assert pii.digest(pii.find_pii(frame(spark, []))).collect() == []


# -- quality


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    covered = set()
    if often is None:
        from collections import Counter

        counts = Counter(windows)
        often = {w for w in windows if counts[w] > 1}
    for i, w in enumerate(windows):
        if w in often:
            covered |= set(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_match_plain_python(spark, sf_dir):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [t or "" for _, t in ODD_ROWS] + [r["text"] for r in rows_of(sf_dir, "documents")[:80]] + ["a\nb\na \n\na\x85b\xa0c"]
    for t in texts:
        assert quality.statistics(t)[:5] == plain_counts(t)


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    rng = random.Random(2)
    words = ["tree", "house", "running", "over", "green", "the", "a", "water,", "stone."]
    text = lambda: " ".join(rng.choice(words) + str(rng.randint(0, 99)).replace("1", "x") for _ in range(60))
    rows = [(i, text()) for i in range(300)] + [(1000 + i, " ".join(f"{w}$%#" for w in text().split())) for i in range(30)]
    got = {r["doc_id"]: r for r in quality.judge(frame(spark, rows)).collect()}
    assert len(got) == 330
    assert all(got[i]["kept"] for i in range(300) if not got[i]["base_failed"])
    assert not any(got[1000 + i]["kept"] for i in range(30))


def test_quality_mcd_is_near_an_exact_search():
    import numpy as np

    assert abs(quality.chi2_cdf(quality.chi2_quantile(0.9999, 6), 6) - 0.9999) < 1e-9
    draws = (np.random.default_rng(0).normal(size=(200_000, 6)) ** 2).sum(axis=1)
    assert abs((draws <= quality.chi2_quantile(0.75, 6)).mean() - 0.75) < 0.005


def test_quality_defined_cases(spark):
    got = quality.judge(frame(spark, ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    assert all(not r["kept"] for r in got if r["n_words"] < 20)
    assert quality.judge(frame(spark, [])).collect() == []


def test_quality_query_on_the_tables(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in rows_of(sf_dir, "documents")}
    good = {r["doc_id"] for r in rows_of(sf_dir, "labels") if r["quality"] == 1}
    got = queries.op3_quality_rules(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        counts = plain_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == counts
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    assert all(r["kept"] for r in got if r["doc_id"] in good and not r["base_failed"])


# -- packing


def test_pieces_are_those_of_the_tokenizer(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder(packing.VOCABULARY)
    texts = [r["text"] for r in rows_of(sf_dir, "documents")[:60]] + ["<|endoftext|>a", "\x85　 x  \n", " " * 3000, "", "it's İ"]
    for t in texts:
        assert encode(t) == plain.encode(t, add_special_tokens=False).ids


def check_packing(got, docs, length):
    import struct

    encode = packing.encoder(packing.VOCABULARY)
    want = []
    for key, text in docs:
        ids = [*encode(text or ""), 0]
        first = (len(ids) - 1) % length + 1
        cuts = [0, *range(first, len(ids), length), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((key, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    order = lambda rows: sorted(rows, key=repr)
    assert order((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == order(want)
    filled = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= length for n in filled.values())
    return len(filled), -(-sum(filled.values()) // length)


def test_packing_query_on_the_tables(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents")]
    bins, bound = check_packing(queries.op6_best_fit_packing(spark, sf_dir).collect(), docs, 2048)
    assert bins <= bound + 1


def test_packing_defined_cases(spark):
    bins, bound = check_packing(packing.pack(frame(spark, ODD_ROWS)).collect(), ODD_ROWS, 2048)
    assert bins <= bound + 1
    assert packing.pack(frame(spark, [])).collect() == []


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(0)
    for _ in range(150):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 8))]
        best = [len(sizes)]

        def place(i, rooms):
            if len(rooms) >= best[0]:
                return
            if i == len(sizes):
                best[0] = len(rooms)
                return
            for r in range(len(rooms)):
                if rooms[r] >= sizes[i]:
                    rooms[r] -= sizes[i]
                    place(i + 1, rooms)
                    rooms[r] += sizes[i]
            rooms.append(100 - sizes[i])
            place(i + 1, rooms)
            rooms.pop()

        place(0, [])
        got, proved = packing.complete_bins(sizes, 100, max_work=None)
        assert proved
        assert sorted(x for b in got for x in b) == sorted(sizes) and all(sum(b) <= 100 for b in got)
        assert len(got) == best[0], sizes


def test_bin_completion_is_optimal_where_best_fit_is_not():
    """Against every way to fill bins, on lengths that best fit packs badly."""
    rng, missed = random.Random(1), 0
    for _ in range(300):
        sizes = [rng.choice((11, 13, 17, 19, 23, 29, 31, 37, 41)) for _ in range(9)]
        got, proved = packing.complete_bins(sizes, 60, max_work=None)
        counts = {x: sizes.count(x) for x in sizes}
        first = len(packing.best_fit(sorted(counts, reverse=True), counts, 60))

        @functools.lru_cache(maxsize=None)
        def fewest(rest):
            if not rest:
                return 0
            others = range(1, len(rest))
            return 1 + min(
                fewest(tuple(x for i, x in enumerate(rest) if i and i not in chosen))
                for n in range(len(rest))
                for chosen in itertools.combinations(others, n)
                if rest[0] + sum(rest[i] for i in chosen) <= 60
            )

        assert proved and len(got) == fewest(tuple(sorted(sizes, reverse=True))) >= packing.lower_bound(sizes, 60)
        missed += first > len(got)
    assert missed


def test_bin_completion_packs_triplets():
    """Triplets that fill their bins exactly, where best fit needs several bins more."""
    for seed in range(5):
        rng, sizes = random.Random(seed), []
        for _ in range(25):
            a = rng.randint(780, 1000)
            b = rng.randint(410, (2048 - a) // 2)
            sizes += [a, b, 2048 - a - b]
        counts = {x: sizes.count(x) for x in sizes}
        assert len(packing.best_fit(sorted(counts, reverse=True), counts, 2048)) > 26
        got, proved = packing.complete_bins(sizes, 2048)
        assert proved and len(got) == 25
        assert sorted(x for b in got for x in b) == sorted(sizes) and {sum(b) for b in got} == {2048}


def test_fillings_are_all_that_are_undominated():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randint(1, 12) for _ in range(7)]
        counts, room, spare = {x: sizes.count(x) for x in sizes}, rng.randint(5, 25), rng.randint(0, 6)
        subsets = {
            tuple(sorted(c, reverse=True)) for n in range(8) for c in itertools.combinations(sizes, n)
        }

        def dominated(f):
            out = set((collections.Counter(sizes) - collections.Counter(f)).elements())
            parts = [p for n in range(len(f) + 1) for p in itertools.combinations(f, n)]
            return any(
                sum(p) <= x <= sum(p) + room - sum(f) and (x > sum(p) or len(p) > 1) for p in parts for x in out
            )

        want = {f for f in subsets if room - spare <= sum(f) <= room and not dominated(f)}
        got = [f for f in packing.fillings(counts, room, spare) if f is not None]
        assert len(got) == len(set(got))
        assert set(got) == want or (got == [(room,)] and room in sizes)


# -- line runs


def plain_line_dedup(rows, min_words):
    """Every run of every length, longest first, against every earlier place."""
    docs = sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0]))
    at, order = {}, []
    for n, (_, text) in docs:
        lines = (text or "").split("\n")
        kept = [i for i, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
        at[n] = kept
        order.append((n, [lines[i] for i in kept]))
    seen, gone = set(), {n: set() for n, _ in docs}
    for n, lines in order:
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        for a in range(len(lines)):
            runs = [tuple(lines[a:b]) for b in range(a + 1, len(lines) + 1)]
            for run in runs:
                if sum(words[a : a + len(run)]) >= min_words and run in seen:
                    gone[n] |= set(range(a, a + len(run)))
            seen |= set(runs)
    out = []
    for n, (key, text) in enumerate(rows):
        lines, deleting, kept = (text or "").split("\n"), False, []
        numbers = {i: j for j, i in enumerate(at[n])}
        for i, line in enumerate(lines):
            deleting = numbers[i] in gone[n] if i in numbers else deleting
            if not deleting:
                kept.append(line)
        out.append((key, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_line_dedup_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = ["a b c", "d e", "f", "", "  ", "g h i j", "k l m n o p q r", "s"]
    rows = [(rng.choice([n, n, None]), "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for n in range(25)]
    rows += [(500, rows[3][1]), (500, rows[3][1]), (501, None)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), min_words=7).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == plain_line_dedup(rows, 7)


def test_line_dedup_query_on_the_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents") if len((r["text"] or "").split("\n")) < 120]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr) == plain_line_dedup(rows, 50)
    assert queries.op7_line_dedup(spark, sf_dir).count() == len(rows_of(sf_dir, "documents"))


def test_line_dedup_defined_cases(spark):
    got = line_dedup.dedup_lines(frame(spark, ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


# -- sharding


def check_shards(got, docs, shards):
    want = sorted(((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    counts = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(shards)]
    assert all(slots == list(range(len(slots))) for slots in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1


def test_sharding_query_on_the_tables(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents")]
    got = queries.op8_sharding(spark, sf_dir).collect()
    check_shards(got, docs, 8)
    for source in {r["source"] for r in got}:
        each = [sum(r["source"] == source and r["shard"] == s for r in got) for s in range(8)]
        assert max(each) - min(each) <= 2  # every shard has the mixture, but for the rows at its edges


@pytest.mark.parametrize("n", [0, 3, 10])
def test_sharding_defined_cases(spark, n):
    rows = ODD_ROWS[:n]
    check_shards(sharding.interleave(frame(spark, rows)).collect(), rows, 8)


# -- near duplicates


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, fps, bits):
    n, root = len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        least[r] = min((k for k in (least.get(r), key) if k is not None), default=None)
    return [least[find(i)] for i in range(n)]


def test_simhash_query_on_the_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"] or "") for r in rows_of(sf_dir, "documents")]
    fps = [plain_fingerprint(t) for _, t in rows]
    want = sorted((k, f"{f:016x}", c) for (k, _), f, c in zip(rows, fps, plain_components(rows, fps, 4)))
    assert sorted(map(tuple, queries.op9_simhash_near_dedup(spark, sf_dir).collect())) == want


@pytest.mark.parametrize("block", [3, 8192])
@pytest.mark.parametrize("wide_from", [0, simhash.WIDE_FROM])
def test_simhash_links_match_brute_force(spark, block, wide_from):
    rng = random.Random(3)
    fps = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            fps.add(centre)
            for _ in range(rng.randint(1, 3)):
                centre ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), block=block, wide_from=wide_from).collect()
    mask = (1 << 64) - 1
    assert all(((e["a"] ^ e["b"]) & mask).bit_count() <= 4 for e in edges)
    got = {r["node"] & mask: r["root"] for r in simhash.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain_components([(f, "") for f in fps], fps, 4)
    for i, f in enumerate(fps):
        for j, g in enumerate(fps):
            assert (got.get(f, f) == got.get(g, g)) == (want[i] == want[j])


def test_simhash_defined_cases(spark):
    got = simhash.near_duplicates(frame(spark, ODD_ROWS)).collect()
    assert len(got) == len(ODD_ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == by_id[3]["component_id"] == 1
    assert by_id[1]["fingerprint"] == "0" * 16 and by_id[5]["component_id"] == 4
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


# -- benchmarks


def plain_hits(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    words, hit, met = split(text), set(), set()
    for item, item_text in items:
        of_item = split(item_text or "")
        n = min(10, len(of_item))
        windows = {tuple(of_item[i : i + n]) for i in range(len(of_item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                met.add(str(item))
    return len(words), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def test_decontamination_query_on_the_tables(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in rows_of(sf_dir, "benchmark")]
    texts = {r["doc_id"]: r["text"] or "" for r in rows_of(sf_dir, "documents")}
    got = queries.op10_benchmark_decontamination(spark, sf_dir).collect()
    assert len(got) == len(texts) and any(r["contaminated"] for r in got)
    for r in got:
        assert tuple(r)[1:] == plain_hits(texts[r["doc_id"]], items)


@pytest.mark.parametrize("limit", [0, 1000])
def test_decontamination_matches_brute_force(spark, limit):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "é", "42", "c", "x"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "--", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 4, 7, 10, 12, 20]) if i else 3)) for i in range(9)] + [(20, None), (21, "!!"), (0, "x x c c")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + ODD_ROWS[:5]
    merged = {}
    for i, t in items:
        merged.setdefault(i, []).append(t)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(frame(spark, docs), bench, filter_limit=limit, keep=("source",)).collect()
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], len(r["items"]), r["contaminated"]) for r in found)
    want = sorted((i or -1, *(x[0], x[1], x[2], x[4])) for i, x in ((i, plain_hits(t or "", items)) for i, t in docs))
    assert got == want


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, ODD_ROWS), bench).collect()
    assert len(got) == len(ODD_ROWS) and not any(r["contaminated"] for r in got)
    assert decontaminate.decontaminate(frame(spark, []), bench).collect() == []
