"""Cross-entropy difference: how much a document reads like a target corpus.

Two bigram models, of the target documents and of all others, share one vocabulary:
every word of either. Both interpolate bigram with add-one word frequencies by the
same weight, and the background's counts are scaled to the target's number of words,
so they differ in what was read and in nothing else. Per word, the loss under the
target less that under the background is taken, and a document's score is the mean:
the lower, the more like the target. A document's own counts are taken off first, so
each is scored as unseen.

The models grow with the corpus and are never in one place. Documents are gathered
into chunks of about ``CHUNK_WORDS`` words; a chunk counts each of its distinct words
and word pairs once and sends them, split by the leading bits of their hashes, to as
many parts as the corpus's size asks for. A part adds up what the chunks sent and
answers each with the corpus's counts, in the order of the question. Answers and
chunks meet again, and a chunk scores its documents. A frequent pair is thus sent
once per chunk, whatever its share of the corpus; a document longer than a chunk is
a chunk of its own. Chunks are written to the shared folder, so a repeated task
answers the same chunks.

Words are maximal runs of characters other than ASCII signs and blanks, and each
sign by itself; A-Z lower-cased. Defined cases: a null or wordless text has no words and null losses; a
null target flag means background; no target or no background documents leave that
model the uniform one; rows with equal ids are rows of their own; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import small_batches, text_of
from docflow.sources.scratch import staged

CHUNK_WORDS = 1 << 20
PART_BYTES = 1 << 24
BIGRAM_WEIGHT = 0.6

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+|[!-/:-@\[-`{-~]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_START = np.uint64(1)


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def shrink(values: np.ndarray) -> bytes:
    """An array as compressed bytes, equal places of all values side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unshrink(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def sorted_bytes(values: np.ndarray) -> bytes:
    return shrink(np.diff(values, prepend=np.uint64(0)))


def from_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unshrink(data, "<u8"), dtype=np.uint64)


def words_by_hash(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word among the distinct ones in hash order; their hashes."""
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[codes], hashes[order]


def pairs_by_hash(words: np.ndarray, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word's predecessor, from 1, with 0 for none; the number of its pair in hash order; the pairs' hashes."""
    before = np.empty(len(words), np.int64)
    before[1:] = words[:-1] + 1
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    pairs, pair_of = np.unique(before * len(hashes) + words, return_inverse=True)
    first, second = pairs // len(hashes), pairs % len(hashes)
    mixed = (np.concatenate([[_START], hashes])[first] * _ODD) ^ hashes[second]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD
    mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return before, rank[pair_of], mixed[order]


def _chunks(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Chunks of whole documents: their ids, flags and lengths, their words in a row as numbers, the words' hashes."""
    small_batches(docs.sparkSession)
    kind = docs.schema["id"].dataType.simpleString()
    names = ["chunk", "ids", "flags", "lengths", "words", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        made, size = 0, 0
        ids: list = []
        flags: list[bool] = []
        texts: list[list[bytes]] = []
        id_type = pa.int64()

        def emit() -> pa.RecordBatch:
            lengths = np.array([len(t) for t in texts], np.int64)
            words, hashes = words_by_hash([w for t in texts for w in t])
            row = [task + made, ids, np.array(flags, np.uint8).tobytes(), lengths.tobytes(), shrink(words.astype("<u4")), sorted_bytes(hashes)]
            kinds = [pa.int64(), pa.list_(id_type), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, flag, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                if texts and size + len(words) > chunk_words:
                    yield emit()
                    made, size, ids, flags, texts = made + 1, 0, [], [], []
                ids.append(key)
                flags.append(bool(flag))
                texts.append(words)
                size += len(words)
        if texts:
            yield emit()

    schema = f"chunk long, ids array<{kind}>, flags binary, lengths binary, words binary, hashes binary"
    return docs.select("id", "flag", "text").mapInArrow(run, schema)


_SORTS = ("word", "pair")
_SIDES = ("target", "background")


def _questions(chunks: DataFrame, bits: int) -> DataFrame:
    """What each chunk asks of each part: hashes of words and pairs, and its own counts of them."""
    names = ["chunk", "part", *[f"{s}_{x}" for s in _SORTS for x in ("hashes", *_SIDES)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int64)
                if not lengths.sum():
                    continue
                words, hashes = unshrink(row["words"], "<u4").astype(np.int64), from_sorted(row["hashes"])
                _, pair_of, pair_hashes = pairs_by_hash(words, hashes, lengths)
                target = np.repeat(np.frombuffer(row["flags"], np.uint8) == 1, lengths)
                cells: dict[int, list] = {}
                for sort, (of, wanted) in enumerate(((words, hashes), (pair_of, pair_hashes))):
                    counts = [np.bincount(of[chosen], minlength=len(wanted)) for chosen in (target, ~target)]
                    parts = (wanted >> np.uint64(64 - bits)).astype(np.int64)
                    edges = np.flatnonzero(np.diff(parts, prepend=-1)).tolist() + [len(parts)]
                    for a, b in zip(edges, edges[1:]):
                        cell = cells.setdefault(int(parts[a]), [None] * 6)
                        cell[3 * sort : 3 * sort + 3] = [sorted_bytes(wanted[a:b]), *(shrink(c[a:b].astype("<i8")) for c in counts)]
                keys = sorted(cells)
                columns = [pa.array([row["chunk"]] * len(keys), pa.int64()), pa.array(keys, pa.int32())]
                columns += [pa.array([cells[k][i] for k in keys], pa.binary()) for i in range(6)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return chunks.select("chunk", "flags", "lengths", "words", "hashes").mapInArrow(
        run, "chunk long, part int, " + ", ".join(f"{n} binary" for n in names[2:])
    )


def _answers(asked: DataFrame) -> DataFrame:
    """Each question with the corpus's counts in its order; a part's first answer has its number of words."""

    def run(group: pa.Table) -> pa.Table:
        out = {"chunk": group.column("chunk"), "part": group.column("part")}
        vocabulary = 0
        for sort in _SORTS:
            held = group.column(f"{sort}_hashes").to_pylist()
            hashes = [from_sorted(h) if h else np.zeros(0, np.uint64) for h in held]
            distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
            vocabulary += len(distinct) if sort == "word" else 0
            edges = np.cumsum([0, *map(len, hashes)])
            for side in _SIDES:
                counts = [unshrink(c, "<i8") for c in group.column(f"{sort}_{side}").to_pylist() if c]
                total = np.bincount(place, weights=np.concatenate(counts) if counts else None, minlength=len(distinct))
                total = total.astype("<i8")
                answers = [shrink(total[place[a:b]]) if b > a else None for a, b in zip(edges, edges[1:])]
                out[f"{sort}_{side}"] = pa.array(answers, pa.binary())
        out["words"] = pa.array([vocabulary] + [0] * (len(group) - 1), pa.int64())
        return pa.table(out)

    schema = "chunk long, part int, " + ", ".join(f"{s}_{x} binary" for s in _SORTS for x in _SIDES) + ", words long"
    return asked.groupBy("part").applyInArrow(run, schema)


def losses(
    own: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...], n: np.ndarray, scale: float, vocabulary: int, weight: float
) -> np.ndarray:
    """Loss per word. ``counts``: of the word, its pair and the pair's first word, less ``own`` ones, times ``scale``."""
    word, pair, first = (np.maximum(c - o, 0) * scale for c, o in zip(counts, own))
    alone = (word + 1) / (n * scale + max(vocabulary, 1))
    seen = first > 0
    mixed = weight * pair / np.where(seen, first, 1) + (1 - weight) * alone
    return -np.log(np.where(seen, mixed, alone))


def score(
    docs: DataFrame,
    target_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_words: int = CHUNK_WORDS,
    part_bytes: int = PART_BYTES,
    weight: float = BIGRAM_WEIGHT,
) -> DataFrame:
    """Per row: id, ``n_words``, mean ``target_loss`` and ``background_loss``, and their difference ``score``."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(target_col).alias("flag"), text_of(docs, text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_of(docs, text_col)))).first()[0] or 0
    bits = max(2, int(np.ceil(np.log2(max(size / part_bytes, 1)))))
    held = staged(_chunks(picked, chunk_words), "lm-chunks")
    answers = staged(_answers(_questions(held, bits)), "lm-answers")
    vocabulary = answers.agg(F.sum("words")).first()[0] or 0

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = b = 0
            for flags, lengths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, of = np.frombuffer(lengths, np.int64), np.frombuffer(flags, np.uint8)
                t, b = t + int(n[of == 1].sum()), b + int(n[of == 0].sum())
            yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([b])], names=["t", "b"])

    summed = held.select("flags", "lengths").mapInArrow(totals, "t long, b long").agg(F.sum("t"), F.sum("b")).first()
    n_target, n_background = summed[0] or 0, summed[1] or 0
    scale = n_target / n_background if n_target and n_background else 1.0

    def judge(chunk: pa.Table, answered: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        answered = answered.sort_by("part")
        lengths = np.frombuffer(row["lengths"], np.int64)
        flags = np.frombuffer(row["flags"], np.uint8) == 1
        out: dict[str, np.ndarray] = {}
        if lengths.sum():
            words, hashes = unshrink(row["words"], "<u4").astype(np.int64), from_sorted(row["hashes"])
            before, pair_of, pair_hashes = pairs_by_hash(words, hashes, lengths)
            document = np.repeat(np.arange(len(lengths)), lengths)

            def own(values: np.ndarray, of: int) -> np.ndarray:
                """How often each word's value is in its own document."""
                _, at, counts = np.unique(document * of + values, return_inverse=True, return_counts=True)
                return counts[at]

            def answer(sort: str, side: str) -> np.ndarray:
                return np.concatenate([unshrink(x, "<i8") for x in answered.column(f"{sort}_{side}").to_pylist() if x])

            own_words = own(words, len(hashes))
            # The word before counts wherever it stands, at the document's end too.
            own_counts = (own_words, own(pair_of, len(pair_hashes)), np.concatenate([[0], own_words[:-1]]))
            is_target = flags[document]
            for side, mine, factor, n in (
                ("target", is_target, 1.0, n_target),
                ("background", ~is_target, scale, n_background),
            ):
                of_word, of_pair = answer("word", side), answer("pair", side)
                # A document's start has no count: its first word is scored by itself.
                counts = (of_word[words], of_pair[pair_of], np.concatenate([[0], of_word])[before])
                less = tuple(np.where(mine, c, 0) for c in own_counts)
                own_n = np.where(mine, lengths[document], 0)
                per_word = losses(less, counts, np.maximum(n - own_n, 0), factor, vocabulary, weight)
                out[side] = np.bincount(document, weights=per_word, minlength=len(lengths))
        none = np.zeros(len(lengths))
        mean = [np.divide(out.get(s, none), lengths, where=lengths > 0, out=none.copy()) for s in ("target", "background")]
        empty = lengths == 0
        return pa.table(
            {
                "id": chunk.column("ids").combine_chunks().flatten(),
                "n_words": pa.array(lengths),
                "target_loss": pa.array(mean[0], mask=empty),
                "background_loss": pa.array(mean[1], mask=empty),
                "score": pa.array(mean[0] - mean[1], mask=empty),
            }
        )

    kind = picked.schema["id"].dataType.simpleString()
    found = (
        held.groupBy("chunk")
        .cogroup(answers.drop("words").groupBy("chunk"))
        .applyInArrow(judge, f"id {kind}, n_words long, target_loss double, background_loss double, score double")
    )
    return found.withColumnRenamed("id", id_col)
