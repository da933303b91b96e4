"""Repeated line runs, found by a suffix order over line numbers, deleted but for the first.

Every line with a word gets a number; a document is a sequence of them. Distributed
prefix doubling ranks all suffixes of all documents by their first 1, 2, 4, ...
lines: the rank by 2k lines comes from the pair of ranks by k lines at a place and k
lines on. Ranks follow the order of the pairs, so equal ranks are one interval of
the suffix array, whose members share a prefix of that length at least. Places whose
rank is theirs alone share nothing longer and are dropped from later rounds.

A run is deleted where it has ``min_words`` words or more and the same lines stand
earlier: in a document with a lesser id, or in the same one. A place's run of any
length n lies in the interval that the ranks by k lines at its start and at its end
name, k the largest power of two up to n. It is enough to look at the shortest runs
of ``min_words`` words that start at a line and that end at one: in every longer
repeated run each line is in such a run that lies inside it. So the deleted lines
are those of the maximal repeated runs, and rounds end once k passes the length of
the longest such shortest run, ``min_words`` lines at most.

The first occurrence of a run always stays; a later copy may overlap it. Lines
without a word are in no run; those that follow a deleted line go with it.

Defined cases: a null text is empty; ids that are null come after all others; rows
with equal ids come in table order; a document may lose all its lines and stays with
an empty text; an empty table gives no rows; all columns are kept, but for those with
the names of the ones added.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import BLANKS, indexed, shielded, small_batches, text_of, with_row
from docflow.sources.scratch import staged

MIN_WORDS = 50
SALTS = 64

_WINDOW = pa.struct([("start", pa.int32()), ("size", pa.int32())])
_HASH = pa.struct([("high", pa.int64()), ("low", pa.int64())])


def worded(text: str) -> list[int]:
    """Which lines have a word."""
    return [i for i, line in enumerate(text.split("\n")) if line.strip(BLANKS)]


def shortest_runs(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, size) of the shortest runs of ``min_words`` words from each line on and up to each line."""
    runs, start, total = set(), 0, 0
    for end, n in enumerate(words):
        total += n
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words:
            runs.add((start, end - start + 1))
    end, total = len(words) - 1, 0
    for start in range(len(words) - 1, -1, -1):
        total += words[start]
        while total - words[end] >= min_words:
            total -= words[end]
            end -= 1
        if total >= min_words:
            runs.add((start, end - start + 1))
    return sorted(runs)


def _sequences(rows: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Per row: 128-bit hashes of its lines with a word, and its shortest runs."""
    small_batches(rows.sparkSession)
    picked = rows.select("_row", F.col(id_col).alias("id"), text_of(rows, text_col).alias("text"))
    schema = T.StructType(
        picked.schema.fields[:2]
        + T._parse_datatype_string(
            "lines array<struct<high: long, low: long>>, runs array<struct<start: int, size: int>>"
        ).fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def signed(x: int) -> int:
            return x - (1 << 64) if x >> 63 else x

        for batch in batches:
            all_lines, all_runs = [], []
            for text in batch.column(2).to_pylist():
                lines = [x for x in text.split("\n") if x.strip(BLANKS)]
                data = [x.encode("utf-8", "surrogatepass") for x in lines]
                hashes = map(xxhash.xxh3_128_intdigest, data)
                all_lines.append([{"high": signed(h >> 64), "low": signed(h & (1 << 64) - 1)} for h in hashes])
                runs = shortest_runs([len(x.split()) for x in data], min_words)
                all_runs.append([{"start": s, "size": n} for s, n in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(all_lines, pa.list_(_HASH)), pa.array(all_runs, pa.list_(_WINDOW))],
                names=schema.names,
            )

    return picked.mapInArrow(run, schema)


def _ranked(places: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``(row, at, rank)``: the order of (a, b) among all pairs that occur twice or more."""
    pairs = places.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(a, b)
    ranks = indexed(pairs, [F.col(a), F.col(b)], "rank", f"{name}-order")
    return staged(places.join(ranks, [a, b]).select("row", "at", "rank"), name)


def prefix_ranks(lines: DataFrame, longest: int) -> dict[int, DataFrame]:
    """Ranks ``(row, at, rank)`` by 1, 2, 4, ... lines, of places ``(row, at, high, low)``.

    A place is there if its prefix of that length occurs twice or more.
    """
    k, levels = 1, {1: _ranked(lines, "high", "low", "ranks-1")}
    while 2 * k <= longest:
        here = levels[k]
        first = here.select("row", "at", F.col("rank").alias("head"))
        second = here.select("row", (F.col("at") - k).alias("at"), F.col("rank").alias("tail"))
        k *= 2
        levels[k] = _ranked(first.join(second, ["row", "at"]), "head", "tail", f"ranks-{k}")
        if levels[k].isEmpty():
            break
    return levels


def repeated_runs(sequences: DataFrame, longest: int) -> DataFrame:
    """``(row, start, size)`` of the shortest runs that stand earlier as well."""
    lines = sequences.select(F.col("_row").alias("row"), F.posexplode("lines").alias("at", "line"))
    levels = prefix_ranks(lines.select("row", "at", "line.high", "line.low"), longest)
    runs = sequences.select(F.col("_row").alias("row"), "id", F.explode("runs").alias("run"))
    runs = runs.select("row", "id", "run.start", "run.size")
    found: DataFrame | None = None
    for k, ranks in levels.items():
        first = ranks.select("row", F.col("at").alias("start"), F.col("rank").alias("head"))
        last = ranks.select("row", F.col("at").alias("end"), F.col("rank").alias("tail"))
        these = (
            runs.filter(F.col("size").between(k, 2 * k - 1))
            .join(first, ["row", "start"])
            .withColumn("end", F.col("start") + F.col("size") - k)
            .join(last, ["row", "end"])
            .select("row", "id", "start", "size", "head", "tail")
        )
        found = these if found is None else found.unionByName(these)
    # The size tells the round; equal sizes, heads and tails are equal lines.
    found = staged(found, "run-intervals")
    place = F.struct(F.col("id").isNull().alias("no"), "id", "row", "start")
    # A run may stand in a third of all rows: its places are dealt over salts, and the
    # first goes to those salts that have some. Runs that stand once go nowhere.
    key = ["size", "head", "tail"]
    found = found.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int"))
    firsts = (
        found.groupBy(*key, "salt")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .groupBy(*key)
        .agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .filter("n > 1")
        .select(*key, "first", F.explode("salts").alias("salt"))
    )
    return found.join(firsts, [*key, "salt"]).filter(
        (F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start"))
    ).select("row", "start", "size")


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[int], int]:
    """The text without the runs, the numbers of the lines that went, and how many there were."""
    lines = text.split("\n")
    at = worded(text)
    gone = {at[i] for start, size in runs for i in range(start, start + size)}
    deleting, deleted, kept = False, [], []
    having = set(at)
    for i, line in enumerate(lines):
        deleting = i in gone if i in having else deleting
        (deleted if deleting else kept).append(i)
    return "\n".join(lines[i] for i in kept), deleted, len(lines)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with repeated runs taken out of the text, ``n_lines`` and ``removed_lines``.

    Other columns may have any names; see ``common.shielded`` for those of results.
    """
    if min_words < 1:
        raise ValueError("a run has one word at least")
    docs, _, back = shielded(docs, tuple(docs.columns), (id_col, text_col), ("n_lines", "removed_lines"))
    rows = with_row(docs, "_row", "line-documents")
    sequences = staged(_sequences(rows, id_col, text_col, min_words), "line-sequences")
    longest = sequences.agg(F.max(F.array_max(F.transform("runs", lambda r: r["size"])))).first()[0] or 1
    runs = repeated_runs(sequences, longest).groupBy("row").agg(F.collect_list(F.struct("start", "size")).alias("_runs"))
    names = [c for c in docs.columns]
    at = names.index(text_col)
    schema = T.StructType(
        docs.schema.fields
        + [T.StructField("n_lines", T.LongType()), T.StructField("removed_lines", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            all_runs = columns.pop().to_pylist()
            results = [
                without(t or "", [(r["start"], r["size"]) for r in of_row or ()])
                for t, of_row in zip(columns[at].to_pylist(), all_runs)
            ]
            columns[at] = pa.array([r[0] for r in results], pa.string())
            columns.append(pa.array([r[2] for r in results], pa.int64()))
            columns.append(pa.array([r[1] for r in results], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    marked = rows.join(runs, rows["_row"] == runs["row"], "left").select(*[rows[c] for c in names], "_runs")
    return back(marked.mapInArrow(run, schema))
