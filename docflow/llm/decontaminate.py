"""Benchmark decontamination by winnowed k-gram fingerprints.

Of every ``window - k + 1`` consecutive k-grams of a document the one with the
least hash is kept. Two texts that share ``window`` consecutive words thus share a
kept k-gram, which follows from the words alone. Kept k-grams of documents and of
benchmark items are joined; a document is then read once more against the items it
met, word for word, so a hash decides nothing by itself. An item of fewer than
``window`` words is one window: its whole length is its k-gram, looked for at every
place of every document.

Benchmarks are small beside a corpus. Where their fingerprints are ``filter_limit``
or fewer (8 MB), they go along with the scan, so that it keeps only what can meet
an item. More are joined in full; the result is the same.

Words are the maximal runs of characters other than ASCII signs and blanks, A-Z
lower-cased. Defined cases: a null or wordless text has no hits, a null or wordless
item occurs nowhere; rows with equal ids are rows of their own; items with equal
ids count as one; an item whose id is null has the empty text for one; an empty benchmark leaves all documents clean; documents' further
columns are ignored, except those named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import shielded, small_batches, text_of
from docflow.sources.scratch import staged

WINDOW = 10
K = 5
FILTER_LIMIT = 1_000_000

# Every byte to what it counts as in a word; a blank where it ends one.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def gram_hashes(words: list[bytes], sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """The hash of every run of n words, for every n of ``sizes``."""
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = {}
    for n in sizes:
        places = max(0, len(words) - n + 1)
        mixed = np.zeros(places, np.uint64)
        for i in range(n):
            mixed = (mixed ^ one[i : i + places]) * _ODD
            mixed ^= mixed >> np.uint64(29)
        out[n] = mixed
    return out


def winnowed(hashes: np.ndarray, span: int) -> np.ndarray:
    """Distinct hashes that are the least of some ``span`` consecutive ones."""
    if len(hashes) < span:
        return hashes[:0]
    places = len(hashes) - span + 1
    least = hashes[:places]
    for i in range(1, span):
        least = np.minimum(least, hashes[i : i + places])
    return np.unique(least)


def fingerprints(text: str, window: int, k: int, short: tuple[int, ...]) -> tuple[int, np.ndarray]:
    """How many words, and the fingerprints: winnowed k-grams and all runs of ``short`` lengths."""
    words = words_of(text)
    grams = gram_hashes(words, tuple({k, *short}))
    found = [winnowed(grams[k], window - k + 1), *(grams[n] for n in short)]
    return len(words), np.unique(np.concatenate(found)).view(np.int64)


def windows_of(words: list[bytes], window: int) -> set[bytes]:
    """The windows of an item, each its words joined by blanks."""
    n = min(window, len(words))
    return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def hits(words: list[bytes], items: list[tuple[str, str]], window: int) -> tuple[int, list[str]]:
    """Words of the document inside a window of one of the items; the items met."""
    hit = np.zeros(len(words) + 1, np.int64)
    met = set()
    owners: dict[int, dict[bytes, list[str]]] = {}
    for item, text in items:
        of_item = words_of(text)
        n = min(window, len(of_item))
        for gram in windows_of(of_item, window):
            owners.setdefault(n, {}).setdefault(gram, []).append(item)
    for n, of_length in owners.items():
        for i in range(len(words) - n + 1):
            found = of_length.get(b" ".join(words[i : i + n]))
            if found:
                met.update(found)
                hit[i] += 1
                hit[i + n] -= 1
    return int((np.cumsum(hit) > 0).sum()), sorted(met)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
    window: int = WINDOW,
    k: int = K,
    filter_limit: int = FILTER_LIMIT,
) -> DataFrame:
    """Per document: id, ``keep``, ``n_words``, ``n_hit``, sorted ``items`` and ``contaminated``.

    Kept columns may have any names; see ``common.shielded`` for those of results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    results = ("n_words", "n_hit", "items", "contaminated")
    docs, keep, back = shielded(docs, keep, (id_col, text_col), results)
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        text_of(benchmark, item_text_col).alias("item_text"),
    )

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [len(words_of(t)) for t in batch["item_text"]]
            yield pd.DataFrame({"n": [n for n in sizes if 0 < n < window]})

    # At most window - 1 numbers.
    short = tuple(sorted(r["n"] for r in items.mapInPandas(lengths, "n long").distinct().collect()))

    def of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["item_text"]):
                words = words_of(text)
                n = len(words)
                if 0 < n < window:
                    fps = gram_hashes(words, (n,))[n].view(np.int64)
                else:
                    fps = fingerprints(text, window, k, ())[1]
                yield pd.DataFrame({"fp": fps, "item": item})

    index = staged(items.mapInPandas(of_items, "fp long, item string").distinct(), "item-fingerprints")
    distinct = index.select("fp").distinct()
    known = None
    if distinct.count() <= filter_limit:
        known = spark.sparkContext.broadcast(np.sort(np.array([r["fp"] for r in distinct.collect()], np.int64)))

    picked = docs.select(id_col, *keep, text_of(docs, text_col).alias("_text"))
    schema = T.StructType(
        picked.schema.fields[:-1]
        + [
            T.StructField("n_words", T.LongType()),
            T.StructField("_fps", T.ArrayType(T.LongType())),
            T.StructField("_text", T.StringType()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            sizes, found, kept = [], [], []
            for text in texts:
                n, fps = fingerprints(text, window, k, short)
                if known is not None:
                    at = np.searchsorted(known.value, fps)
                    at[at == len(known.value)] = 0
                    fps = fps[known.value[at] == fps] if len(known.value) else fps[:0]
                sizes.append(n)
                found.append(fps)
                kept.append(text if len(fps) else None)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    # The row number is written with the rows, so later reads agree on it.
    rows = staged(
        picked.mapInArrow(scan, schema).withColumn("_row", F.monotonically_increasing_id()), "scanned-documents"
    )
    met = (
        rows.select("_row", F.explode("_fps").alias("fp"))
        .join(index, "fp")
        .select("_row", "item")
        .distinct()
        .join(items, "item")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("item", "item_text")).alias("items"))
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, text, of_row in zip(batch["_row"], batch["_text"], batch["items"]):
                pairs = [(x["item"], x["item_text"]) for x in of_row]
                out.append((row, *hits(words_of(text), pairs, window)))
            yield pd.DataFrame(out, columns=["_row", "n_hit", "items"])

    verified = (
        rows.filter("_text is not null")
        .select("_row", "_text")
        .join(met, "_row")
        .mapInPandas(verify, "_row long, n_hit long, items array<string>")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return back(
        rows.drop("_fps", "_text")
        .join(verified, "_row", "left")
        .select(
            id_col,
            *keep,
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            (n_hit > 0).alias("contaminated"),
        )
    )
