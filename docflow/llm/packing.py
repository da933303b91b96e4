"""Best-fit packing of token sequences by bin completion, branch and bound.

A document's tokens, with the end token, are one piece; only documents longer than
a sequence are cut, into full pieces after a first one that takes the rest. Pieces
are dealt at random over groups of about ``GROUP_TOKENS`` tokens, and each group is
packed by itself: hundreds of sequences, against one that may stay part empty.

Within a group the search fills one sequence at a time around the largest piece
left. It enumerates all undominated fillings of the room beside it, fullest first
(a filling is dominated if some of its pieces can be exchanged for one left out
that is longer, or as long as several, and still fits), and goes on with what
remains. A branch ends when the room it has left empty is more than the incumbent's
number of sequences less one can spare, or when it comes to pieces that another
branch failed with. The first incumbent is the best-fit decreasing solution; the
search ends once a solution meets the lower bound or nothing is left to try. Such a
search can take exponential time, so ``pack`` looks at ``max_work`` fillings a group
at most and then lets the incumbent stand; None takes that limit away. Equal lengths
are exchangeable, so the search is over counts of lengths and finds the same for any
order of rows.

Token ids are those of the ``tokenizers`` library with the given vocabulary file;
the same vocabulary is encoded by ``tiktoken``, several times faster, and by
``tokenizers`` itself where the file has no such twin or the text defeats it.

Defined cases: a null or empty text is the end token alone; rows with equal ids are
documents of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import random
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import small_batches, text_of
from docflow.sources.scratch import staged

LENGTH = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
GROUP_TOKENS = 1 << 24
MAX_PARTITIONS = 1 << 14
MAX_WORK = 50_000
LIVE = 64

# What a search gets where no filling is left.
END = (-1,)

Encoder = Callable[[str], list[int]]


@lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Encoder:
    """Text to ids, without special tokens added. ``vocabulary``: a path, or a public file's name."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = Path(vocabulary)
    path = path if path.is_absolute() else Path(public_tokenizers.path(vocabulary))
    slow: list[Tokenizer] = []

    def by_tokenizers(text: str) -> list[int]:
        if not slow:
            slow.append(Tokenizer.from_file(str(path)))
        return slow[0].encode(text, add_special_tokens=False).ids

    twin = path.with_suffix(".tiktoken")
    if path.name != VOCABULARY or not twin.exists():
        return by_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, twin.read_bytes().splitlines())}
    fast = tiktoken.Encoding(
        path.stem,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={"<|endoftext|>": len(ranks)},
    )

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except BaseException as error:  # its pattern engine gives up on very long runs of blanks
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return by_tokenizers(text)

    return encode


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens."""
    first = (n - 1) % length + 1
    return [(0, first), *((s, length) for s in range(first, n, length))]


def with_pieces(
    docs: DataFrame, id_col: str, text_col: str, length: int, vocabulary: str, end_id: int
) -> DataFrame:
    """One row per piece: id, document number ``_row``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("_text"))
    schema = T.StructType(
        [
            T.StructField("id", picked.schema["id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            seen: dict[str, list[tuple]] = {}
            rows: list[tuple] = []
            owners: list[int] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text not in seen:
                    ids = np.array([*encode(text), end_id], "<u4")
                    seen[text] = [
                        (k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), length))
                    ]
                rows += seen[text]
                owners += [i] * len(seen[text])
            columns = [batch.column(0).take(pa.array(owners, pa.int64()))]
            for j, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64())):
                columns.append(pa.array([r[j] for r in rows], kind))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return picked.mapInArrow(run, schema)


def best_fit(sizes: list[int], counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; bins as lists of lengths."""
    rooms: list[list[int]] = []  # (room, bin) ascending by room
    bins: list[list[int]] = []
    for size in sizes:
        for _ in range(counts[size]):
            at = bisect_right(rooms, [size, -1])
            if at < len(rooms):
                room, which = rooms.pop(at)
            else:
                room, which = capacity, len(bins)
                bins.append([])
            bins[which].append(size)
            entry = [room - size, which]
            rooms.insert(bisect_right(rooms, entry), entry)
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Bins that any packing needs.

    No two pieces above half share a bin, and beside one of them a bin has no room
    for pieces of a threshold or more if it is that full; the best threshold counts.
    """
    a = np.sort(np.asarray(lengths, np.int64))
    sums = np.concatenate([[0], np.cumsum(a)])
    half = np.searchsorted(a, capacity // 2, "right")
    threshold = np.unique(np.concatenate([[0], a[:half]]))
    low = np.searchsorted(a, threshold, "left")
    high = np.searchsorted(a, capacity - threshold, "right")
    beside = (high - half) * capacity - (sums[high] - sums[half])
    more = -(-(sums[half] - sums[low] - beside) // capacity)
    return int(len(a) - half + np.maximum(more, 0).max())


def _spread(bits: int, steps: int) -> int:
    """``bits`` together with each of them moved up by 1 to ``steps``."""
    done = 0
    while done < steps:
        by = min(done + 1, steps - done)
        bits |= bits << by
        done += by
    return bits


def fillings(counts: dict[int, int], room: int, spare: int) -> Iterator[tuple[int, ...] | None]:
    """Every undominated multiset of ``counts`` that leaves at most ``spare`` of ``room``, fullest first.

    Lazily, with a None for each dominated one on the way. Sums that the shorter
    lengths can reach are bits of a number, so no branch ends without a filling.
    """
    if counts.get(room, 0):
        yield (room,)  # dominates every other
        return
    sizes = sorted((x for x, c in counts.items() if c and x <= room), reverse=True)
    whole = (1 << room + 1) - 1
    reach = [1] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        bits = reach[i + 1]
        few, part = min(counts[sizes[i]], room // sizes[i]), 1
        while few and bits != whole:
            k = min(part, few)
            bits = (bits | bits << k * sizes[i]) & whole
            few, part = few - k, 2 * part
        reach[i] = bits

    def summing(i: int, target: int) -> Iterator[tuple[int, ...]]:
        if not target:
            yield ()
            return
        while reach[i] >> target & 1:
            size = sizes[i]
            for k in range(min(counts[size], target // size), 0, -1):
                if reach[i + 1] >> target - k * size & 1:
                    for tail in summing(i + 1, target - k * size):
                        yield (size,) * k + tail
            i += 1

    present = sum(1 << x for x in sizes)

    def dominated(picked: tuple[int, ...], waste: int) -> bool:
        """Some of the picked, or none, could be one left out that is longer, or as long as several."""
        one, several, out = 0, 0, present
        for x in picked:
            several |= (several | one) << x
            one |= 1 << x
        for x in set(picked):
            if counts[x] == picked.count(x):
                out ^= 1 << x
        longer = _spread(one << 1, waste - 1) if waste else 0
        return bool(out & (_spread(several | 1, waste) | longer))

    for waste in range(min(spare, room) + 1):
        if reach[0] >> room - waste & 1:
            for found in summing(0, room - waste):
                yield None if dominated(found, waste) else found


def _search(lengths: list[int], capacity: int, max_work: int | None) -> tuple[list[list[int]], bool]:
    """Bins for lengths below ``capacity``, and whether it is proved that fewer cannot do."""
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    total, bound = sum(lengths), lower_bound(lengths, capacity)
    best = best_fit(sorted(left, reverse=True), left, capacity)
    # What is left is known by a sum of random codes; ``dead``: the least waste it failed with.
    rng = random.Random(0)
    code = {x: rng.getrandbits(128) for x in left}
    state, dead, work = sum(code[x] * c for x, c in left.items()), {}, 0
    path: list[list[int]] = []

    def take(items: list[int], n: int) -> None:
        nonlocal state
        for x in items:
            left[x] -= n
            state -= n * code[x]

    def around(waste: int) -> list:
        """The longest piece, the fillings beside it, the waste so far, how many fillings were taken."""
        head = max(x for x, c in left.items() if c)
        beside = {x: c - (x == head) for x, c in left.items() if c}
        return [head, fillings(beside, capacity - head, (len(best) - 1) * capacity - total - waste), waste, 0]

    stack = [around(0)]
    while stack and len(best) > bound:
        if len(path) == len(stack):
            take(path.pop(), -1)
        work += 1
        if max_work is not None and work > max_work:
            return best, False
        level = stack[-1]
        head, tries, waste, taken = level
        if tries is None:
            tries = level[1] = around(waste)[1]
            for _ in range(taken):
                next(tries, END)
        level[3] += 1
        filling = next(tries, END)
        if filling is None:
            continue
        items = [head, *filling]
        after = waste + capacity - sum(items)
        if filling is END or after > (len(best) - 1) * capacity - total:
            dead[state] = min(waste, dead.get(state, waste))
            stack.pop()
            continue
        take(items, 1)
        path.append(items)
        if not any(left.values()):
            best = [list(b) for b in path]
        elif after < dead.get(state, after + 1):
            stack.append(around(after))
            # A search can be thousands of bins deep; fillings further up are made again when wanted.
            if len(stack) > LIVE:
                stack[-LIVE - 1][1] = None
    return best, True


def complete_bins(lengths: list[int], capacity: int, max_work: int | None = MAX_WORK) -> tuple[list[list[int]], bool]:
    """As few bins as the search finds, and whether they are proved to be the fewest.

    ``max_work`` bounds the fillings looked at; without it (None) the search is complete.
    """
    full = [[capacity] for n in lengths if n == capacity]
    rest = [n for n in lengths if n < capacity]
    if not rest:
        return full, True
    best, proved = _search(rest, capacity, max_work)
    return full + best, proved


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
    max_work: int | None = MAX_WORK,
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    pieces = staged(
        with_pieces(docs, id_col, text_col, length, vocabulary, end_id).withColumn("_at", F.monotonically_increasing_id()),
        "pieces",
    )
    tokens = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, round(tokens / group_tokens))
    # Random groups, so even ones, and the same on every attempt. A given number of
    # partitions is not merged by bytes: a search costs time, not room.
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups)).cast("int"))
    dealt = dealt.repartition(min(2 * groups, MAX_PARTITIONS), "_group")
    schema = T.StructType(
        [f for f in pieces.schema.fields if f.name != "_at"]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = [f.name for f in schema.fields]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("_at", "ascending")])
        sizes = group.column("length").to_numpy()
        # Where the rows of each length start; each bin takes the next one.
        values, starts = np.unique(-sizes, return_index=True)
        next_row = dict(zip((-values).tolist(), starts.tolist()))
        sequence = np.empty(len(sizes), np.int64)
        offset = np.empty(len(sizes), np.int64)
        bins, _ = complete_bins(sizes.tolist(), length, max_work)
        for b, items in enumerate(bins):
            at = 0
            for size in items:
                row = next_row[size]
                next_row[size] += 1
                sequence[row], offset[row] = (key[0].as_py() << 32) + b, at
                at += size
        group = group.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        return group.select(names)

    return dealt.groupBy("_group").applyInArrow(run, schema).withColumnRenamed("id", id_col)
