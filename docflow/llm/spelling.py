"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters, as a multiset, are a binary vector: one place per letter and
occurrence, ``a1, a2, b1, ...``. One inserted or deleted letter changes one place, a
replaced letter two, so near words lie within a Hamming distance of two. The places
are cut into ``PARTS`` parts by a hash. Two differing places touch two parts at most,
so near words agree on all places of some ``PARTS - 2`` parts: each such choice of
parts, with a hash of the word's places in them, is a signature, and near words share
at least one. The words meet in an equality join on signatures and are verified there.

Letters alone do not tell words of the same syllables apart. An edit lies in the first
or in the second half of a word, so near words also share their beginning or their
end. Each signature is therefore taken twice, once with the first ``t`` letters and
once with the last ``t - 1``; no near pair is lost, and a group holds only words that
have half of their letters in one place in common. A word of an odd length is indexed
for both of its possible halves, so that it meets the words one letter shorter and
longer.

The words are counted before any shuffle, so a word that makes up a third of all
texts is one row. Verified pairs only leave the join.

Defined cases: a null text is empty; a null id counts as the empty text in the hash;
rows with equal ids and texts count as often as they occur; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import tasks, text_of
from docflow.sources.scratch import recorded, remove, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 7
LEAST_COUNT = 2
SLIP = 31
RATIO = 10

PARTS = 4
MAX_PLACES = 2

_MASK = (1 << 64) - 1


def slipped(doc_id: Column, run: Column, slip: int = SLIP) -> Column:
    """The run, without one letter where the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % slip == 0, shorter).otherwise(run)


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)`` of all words of the texts, as the hash leaves them."""
    lowered = F.translate(text_of(docs, text_col), UPPER, LOWER)
    # A slip only shortens, so runs that are too short already need not be looked at.
    pattern = F.lit(f"[a-zÀ-ÿ]{{{least_letters},}}")
    runs = docs.select(docs[id_col].alias("id"), F.explode(F.regexp_extract_all(lowered, pattern, F.lit(0))).alias("run"))
    words = runs.select(slipped(F.col("id"), F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def places(word: str) -> list[int]:
    """A hash for each place of the word's letter vector that is set."""
    seen: dict[str, int] = {}
    found = []
    for letter in word:
        seen[letter] = n = seen.get(letter, 0) + 1
        found.append(_place(letter, n))
    return found


_places: dict[tuple[str, int], int] = {}


def _place(letter: str, n: int) -> int:
    if n > 64:  # long runs of one letter are not worth remembering
        return xxhash.xxh64_intdigest(f"{letter}{n}")
    known = _places.get((letter, n))
    if known is None:
        known = _places[letter, n] = xxhash.xxh64_intdigest(f"{letter}{n}")
    return known


def signatures(word: str, parts: int = PARTS) -> tuple[list[int], int]:
    """One number for each choice of all parts but ``MAX_PLACES``, and each half of the
    word; and a number for all its places."""
    sums = [0] * parts
    for place in places(word):
        sums[place % parts] += place
    n = len(word)
    halves = []
    for t in {n // 2, (n + 1) // 2}:
        halves.append(xxhash.xxh64_intdigest(f"<{t}{word[:t]}"))
        halves.append(xxhash.xxh64_intdigest(f">{t}{word[n - t + 1 :]}"))
    chosen = []
    for i, choice in enumerate(combinations(range(parts), parts - MAX_PLACES)):
        own = i
        for p in choice:
            own = (own * 0x9E3779B97F4A7C15 + sums[p]) & _MASK
        chosen += [(own ^ half) * 0xC2B2AE3D27D4EB4F & _MASK for half in halves]
    return chosen, sum(sums) & _MASK


def with_signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``(signature, letters, word, n)``, one row per signature of each word; words of
    the same ``letters`` are the same word or rearranged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(w, parts) for w in batch.column("word").to_pylist()]
            sizes = np.fromiter((len(own) for own, _ in found), np.int64, len(found))
            rows = np.repeat(np.arange(len(found)), sizes)
            keys = np.fromiter((s for own, _ in found for s in own), np.uint64, len(rows)).view(np.int64)
            letters = np.fromiter((all_ for _, all_ in found), np.uint64, len(found)).view(np.int64)[rows]
            of = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(letters), batch.column("word").take(of), batch.column("n").take(of)],
                names=["signature", "letters", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(run, "signature long, letters long, word string, n long")


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``(word, n, other, other_n)``: every two of ``words (word, n)`` one edit apart, the lesser word first."""
    keyed = with_signatures(words.repartition(tasks(words.sparkSession)), parts)
    a, b = keyed.alias("a"), keyed.alias("b")
    # An edit never leaves the letters as they are: rearranged words need no closer look.
    met = (
        (F.col("a.signature") == F.col("b.signature"))
        & (F.col("a.letters") != F.col("b.letters"))
        & (F.col("a.word") < F.col("b.word"))
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    pairs = a.join(b, met).select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for every word of ``forms (word, form)``: where its forms lead.

    Every round the way each word has come doubles; a form's count is at least
    ``RATIO`` times the word's, so ways are short and there are no circles.
    """
    spark = forms.sparkSession
    with recorded() as made:
        now = staged(forms.select("word", F.col("form").alias("root")), "roots")
        while True:
            onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
            after = now.join(onward, "root", "left")
            now = staged(after.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("on")), "roots")
            remove(spark, made[:-1])
            del made[:-1]
            if now.filter("on").isEmpty():
                return now.select("word", "root")
            now = now.select("word", "root")


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ratio: int = RATIO,
    parts: int = PARTS,
) -> DataFrame:
    """Every word with its commonest near word ``form``, if that is ``ratio`` times as
    common, the last of the forms that follow (``root``), its count ``n``, the number of
    near words ``n_near`` and the form's count ``form_n``.
    """
    words = staged(count_words(docs, id_col, text_col), "words")
    pairs = near_pairs(words, parts)
    both = pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    # Most occurrences first, then code-point order.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = staged(
        both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("n"), best.alias("best")), "near-words"
    )
    form_n = -F.col("best.less")
    known = near.select(
        "word",
        "n_near",
        F.when(form_n >= ratio * F.col("n"), F.col("best.form")).alias("form"),
        F.when(form_n >= ratio * F.col("n"), form_n).alias("form_n"),
    )
    roots = _roots(known.filter(F.col("form").isNotNull()))
    return (
        words.join(known, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
