"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

A fingerprint has 64 bits. Two that differ in at most four are linked. Cut into
three segments, two linked fingerprints differ in at most one bit of at least one
segment. Each segment is therefore indexed once per bit with that bit deleted: 64
signatures per fingerprint, and two fingerprints share one exactly if a segment of
theirs differs by at most one bit. Fingerprints that share a signature are
compared in full. The segments follow from the distance: the fewest of which one
must differ by at most one bit.

A signature of 20 or 21 bits is shared by chance too, by the more the larger the
table. From ``wide_from`` fingerprints on, each signature is taken together with one
of five parts of the bits outside its segment: linked fingerprints differ in four of
those at most, so one part is equal and no link is lost, and a signature has 8 or 9
bits more, for five times as many. Both forms give the same components.

Nothing pairs all members of a signature. A task walks its members from one to
the next within reach and writes the links of a spanning forest, which keeps every
component. Members are distinct fingerprints, so thousands of copies are one
member. A signature with more than ``block`` members is walked in pairs of blocks
of that size, so a task holds two blocks at most. Which ones have is known from
counts of the segments' values, three to a fingerprint, before signatures are made.

Defined cases: a null text is empty; a text without words has fingerprint zero and
is linked like any other; a text of fewer words than a shingle is one shingle; rows
with equal ids are rows of their own; the component's id is the least id in it that
is not null; an empty table gives no rows; further columns are ignored, except
those named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import shielded, small_batches, tasks, text_of
from docflow.llm.components import connected_components
from docflow.sources.scratch import staged

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 8192
WIDE_FROM = 1 << 24


def fingerprint(text: str, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text: a bit is set if set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    last = ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last)), np.uint64, n
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    shingle: int = SHINGLE_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Id, ``keep`` and the fingerprint as a signed long ``fp``, one row per row."""
    small_batches(docs.sparkSession)
    picked = docs.select(id_col, *keep, text_of(docs, text_col).alias("_text"))
    schema = T.StructType(picked.schema.fields[:-1] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            seen: dict[str, int] = {}
            for t in texts:
                if t not in seen:
                    seen[t] = fingerprint(t, shingle, seed)
            fps = np.array([seen[t] for t in texts], np.uint64).view(np.int64)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps)], names=schema.names)

    return picked.mapInArrow(run, schema)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the fewest segments of which one differs by at most one bit."""
    n = max(1, (max_bits + 2) // 2)
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def pieces(segment: tuple[int, int], max_bits: int) -> list[int]:
    """Masks of ``max_bits + 1`` parts of the bits outside a segment: of two linked fingerprints one part is equal."""
    shift, width = segment
    bits = [i for i in range(64) if not shift <= i < shift + width]
    n = max_bits + 1
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(max_bits: int, wide: bool) -> list[tuple[int, list[int]]]:
    """Per segment, and if ``wide`` per piece beside it: the mask, and those with one bit of the segment deleted."""
    found = []
    for shift, width in segments(max_bits):
        segment = (1 << width) - 1 << shift
        for beside in pieces((shift, width), max_bits) if wide else [0]:
            whole = segment | beside
            found.append((whole, [whole & ~(1 << shift + bit) for bit in range(width)]))
    return found


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _masked(rows: DataFrame, found: list[int], name: str) -> DataFrame:
    """``rows`` once per mask: its number ``name``, and the bits ``rest`` of ``fp`` under it."""
    each = rows.select("*", F.posexplode(F.array(*map(_signed, found))).alias(name, "_mask"))
    return each.withColumn("rest", F.col("fp").bitwiseAND(F.col("_mask"))).drop("_mask")


def forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members within ``max_bits`` of each other."""
    rest, links = members, []
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached: list[np.ndarray] = []
            for node in front:
                near = np.bitwise_count(rest ^ node) <= max_bits
                if near.any():
                    found = rest[near]
                    links += [(int(node), int(x)) for x in found]
                    reached.append(found)
                    rest = rest[~near]
                    if not len(rest):
                        break
            front = np.concatenate(reached) if reached else rest[:0]
    return links


def _members(keyed: DataFrame, by: list[str]) -> DataFrame:
    """The fingerprints of every group of two or more."""
    return keyed.groupBy(*by).agg(F.collect_list("fp").alias("fps")).select("fps").filter(F.size("fps") > 1)


def _large(fps: DataFrame, found: list[tuple[int, list[int]]], block: int) -> DataFrame:
    """``(slot, rest, n)``: signatures that may have more than ``block`` members, ``n`` at most.

    The members of a signature have one of two values under the mask with the bit,
    so one of these values has over half of ``block``. Only values are counted.
    """
    values = _masked(fps, [whole for whole, _ in found], "at").groupBy("at", "rest").agg(F.count(F.lit(1)).alias("n"))
    heavy = staged(values.filter(F.col("n") > block // 2), "heavy-values")
    slots = [(at, _signed(mask)) for at, (_, deleted) in enumerate(found) for mask in deleted]
    all_slots = F.array(
        *[F.struct(F.lit(at).alias("at"), F.lit(i).alias("slot"), m.alias("mask")) for i, (at, m) in enumerate(slots)]
    )
    own = F.explode(F.filter(all_slots, lambda s: s["at"] == F.col("at"))).alias("own")
    each = heavy.select("rest", "n", own).select(
        F.col("own.slot").alias("slot"), F.col("rest").bitwiseAND(F.col("own.mask")).alias("rest"), "n"
    )
    return each.groupBy("slot", "rest").agg((F.sum("n") + block // 2).alias("n")).filter(F.col("n") > block)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, wide_from: int = WIDE_FROM) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``, enough for every component."""
    found = masks(max_bits, fps.count() >= wide_from)
    fps = fps.select("fp").repartition(tasks(fps.sparkSession), "fp")
    keyed = _masked(fps, [mask for _, deleted in found for mask in deleted], "slot")
    large = staged(_large(fps, found, block), "large-signatures")
    if large.isEmpty():
        groups = _members(keyed, ["slot", "rest"])
    else:
        rest = keyed.join(large, ["slot", "rest"], "left_anti")
        blocks = F.ceil(F.col("n") / block).cast("int")
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        # A block meets every block once: the smaller number first.
        meet = lambda o: F.struct(F.least(o, own).alias("x"), F.greatest(o, own).alias("y"))
        pairs = F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), meet)).alias("pair")
        cut = keyed.join(large, ["slot", "rest"]).select("fp", "slot", "rest", pairs)
        groups = _members(rest, ["slot", "rest"]).unionByName(_members(cut, ["slot", "rest", "pair"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for fps in batch["fps"]:
                group = np.sort(np.asarray(fps, np.int64)).view(np.uint64)
                found += forest(group, max_bits)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}).drop_duplicates()

    return groups.mapInPandas(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """Each row's id and ``keep``, its ``fingerprint`` as hex digits, and its component.

    ``component_id`` is the least id that can be reached over links,
    ``component_fp`` the least fingerprint, a key that is never null. Kept columns may
    have any names; see ``common.shielded`` for those of results.
    """
    results = ("fingerprint", "component_id", "component_fp")
    docs, keep, back = shielded(docs, keep, (id_col, text_col), results)
    rows = staged(with_fingerprints(docs, id_col, text_col, keep, shingle, seed), "fingerprints")
    fps = staged(rows.groupBy("fp").agg(F.min(id_col).alias("_id")), "distinct-fingerprints")
    stars = connected_components(links(fps.select("fp"), max_bits, block))
    placed = fps.join(stars.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component_fp", F.coalesce("root", "fp")
    )
    least = placed.groupBy("component_fp").agg(F.min("_id").alias("component_id"))
    of_fp = placed.select("fp", "component_fp").join(least, "component_fp")
    found = rows.join(of_fp, "fp").select(
        id_col,
        *keep,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component_fp",
    )
    return back(found)


def representatives(found: DataFrame, id_col: str, row: str) -> DataFrame:
    """The ``row`` of one row per component: the least id's first row."""
    first = F.min(F.struct(F.col(id_col).isNull().alias("no"), F.col(id_col).alias("id"), F.col(row).alias("row")))
    return found.groupBy("component_fp").agg(first.alias("_first")).select(F.col("_first.row").alias(row))
