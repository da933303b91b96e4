"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A text's words, lower-cased, are read in overlapping windows of ``WINDOW`` words, one
every ``STRIDE``, to the end of the text. A word's input is a vector of its own, if it
is in the vocabulary, beside the mean of vectors of its letter groups (three and five
letters, the word's borders included), so that unseen words are read by their letters.
To both belongs the evidence: how much commoner the word, or the strongest of its letter
groups, is in the sample's toxic documents than in others.
Two gated recurrent layers, one from each side, run over a window; attention weights
their states, and the weighted sum gives the window's logit. The text's score is the
sigmoid of its highest window's logit. A text without words is one empty window.

The network is trained in numpy on the driver, on a bounded sample: of the labelled
rows that are not held out, the ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` other ones
of the least hashes of their ids, as far as their texts have at most ``SAMPLE_CHARS``
characters. Loss reaches a document through its windows, weighted by how high each
scores, so that a single window can make a document toxic. Scoring is one pass over
all rows and needs no shuffle. A word's share in the gates' inputs depends on the word
only and is kept per task for the words met, in a store of bounded size.

Defined cases: a null text is empty; a null id hashes as the empty text and is
therefore held out; an id with several labels is toxic if one of them is 1; null
labels are none; rows with equal ids are scored each; without labels of both kinds
every score is the smoothed share of toxic ones; an empty table gives no rows; further
columns are ignored, except those named in ``keep``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import small_batches, text_of

WINDOW = 64
STRIDE = 48
HIDDEN = 12
WORD_DIMS = 12
CHAR_DIMS = 12
CHAR_BUCKETS = 1 << 15
VOCABULARY = 8192
LEAST_DOCUMENTS = 2
GROUPS = (3, 5)

SAMPLE_TOXIC = 1200
SAMPLE_CLEAN = 2400
SAMPLE_CHARS = 16_384
FOLDS = 5

STEPS = 250
BATCH_WINDOWS = 96
LEARNING_RATE = 0.01
WORD_DROPOUT = 0.5
DECAY = 0.1
SHRINK = 10
SEED = 11

# Words whose inputs a task keeps, windows of one pass, letters hashed at a time.
STORE_WORDS = 200_000
PASS_WINDOWS = 1024
HASH_LETTERS = 1 << 18

INPUTS = WORD_DIMS + 1 + CHAR_DIMS + 1

TOKEN = re.compile(r"[^\W\d_]+")
Weights = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def windows_of(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[tuple[int, int]]:
    """(start, end) of the windows over ``n`` words; the last one ends with the text."""
    if n <= window:
        return [(0, n)]
    return [(a, a + window) for a in (*range(0, n - window, stride), n - window)]


def letter_groups(words: list[str], buckets: int = CHAR_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words' letter groups, one word after the other, and how many each has."""
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(lengths), lengths)
    of = np.repeat(np.arange(len(words)), lengths)
    hashes, owners = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for size in range(1, max(GROUPS) + 1):
        rolled = rolled[: len(codes) - size + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 :]
        if size in GROUPS:
            at = np.flatnonzero(np.arange(len(rolled)) + size <= ends[: len(rolled)])
            mixed = (rolled[at] + np.uint64(size)) * np.uint64(0xC2B2AE3D27D4EB4F)
            hashes.append((mixed >> np.uint64(40)) % np.uint64(buckets))
            owners.append(of[at])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    found = np.concatenate(hashes)[order].astype(np.int64)
    return found, np.bincount(owner, minlength=len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Vocabulary and weights; without weights, ``prior`` is every text's logit."""

    vocabulary: dict[str, int]
    weights: Weights
    prior: float = 0.0

    def char_vectors(self, words: list[str]) -> np.ndarray:
        """The mean letter-group vector of each word and the strongest evidence of a group; a
        word's memory does not grow with its length."""
        table, evidence = self.weights["char"], self.weights["char_evidence"]
        out = np.zeros((len(words), table.shape[1] + 1), np.float32)
        start = 0
        while start < len(words):
            end, letters = start, 0
            while end < len(words) and (end == start or letters + len(words[end]) <= HASH_LETTERS):
                letters += len(words[end])
                end += 1
            groups, counts = letter_groups(words[start:end])
            if end - start == 1:
                share = np.bincount(groups, minlength=len(table)).astype(np.float32) / counts[0]
                out[start, :-1] = share @ table
                out[start, -1] = evidence[groups].max()
            else:
                cuts = np.cumsum(counts) - counts
                out[start:end, :-1] = np.add.reduceat(table[groups], cuts, axis=0) / counts[:, None]
                out[start:end, -1] = np.maximum.reduceat(evidence[groups], cuts)
            start = end
        return out

    def inputs(self, words: list[str]) -> np.ndarray:
        """The vector of each word: its own and its evidence, and those of its letters."""
        known = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        own = (self.weights["word"][known], self.weights["word_evidence"][known][:, None])
        return np.concatenate([*own, self.char_vectors(words)], axis=1)


def _live(lengths: np.ndarray, t: int, steps: int) -> np.ndarray:
    """(direction, 1, window): whether step ``t`` lies inside the window."""
    return np.stack([t < lengths, steps - 1 - t < lengths])[:, None]


def run_network(weights: Weights, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Logits of windows; ``x`` is (time, window, input), the words beyond a window's length ignored.

    Gates are cut off linearly at 0 and 1. Arrays inside have the windows last, which
    keeps every step's slices contiguous.
    """
    steps, n, _ = x.shape
    u, ub = weights["u"], weights["ub"][:, :, None]
    h = u.shape[2]
    gates = weights["w"] @ x.transpose(0, 2, 1) + weights["b"][:, None]
    gates = gates.reshape(steps, 2, 3 * h, n)
    state = np.zeros((2, h, n), np.float32)
    seen = np.empty((steps, 2, h, n), np.float32)  # by place in the window
    saved = []
    even = bool((lengths == steps).all())
    for t in range(steps):
        back = steps - 1 - t
        inner = u @ state
        both = inner[:, : 2 * h]
        both[0] += gates[t, 0, : 2 * h]
        both[1] += gates[back, 1, : 2 * h]
        np.clip(both, 0, 1, out=both)
        update, reset = both[:, :h], both[:, h:]
        candidate = inner[:, 2 * h :] + ub
        if keep:
            candidate_in = candidate.copy()
        candidate *= reset
        candidate[0] += gates[t, 0, 2 * h :]
        candidate[1] += gates[back, 1, 2 * h :]
        np.tanh(candidate, out=candidate)
        after = state - candidate
        after *= update
        after += candidate
        if not even:
            after = np.where(_live(lengths, t, steps), after, state)
        if keep:
            saved.append((state, both, candidate_in, candidate))
        state = after
        seen[t, 0], seen[back, 1] = state
    seen = seen.reshape(steps, 2 * h, n)
    view = np.tanh(weights["aw"] @ seen + weights["ab"][:, None])
    raw = weights["av"] @ view
    raw = np.where(np.arange(steps)[:, None] < np.maximum(lengths, 1), raw, -np.inf)
    weight = np.exp(raw - raw.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,thn->hn", weight, seen)
    logits = weights["ow"] @ pooled + weights["ob"]
    return (logits, (x, lengths, saved, seen, view, weight, pooled)) if keep else logits


def gradients(weights: Weights, cache: tuple, d_logits: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Of the loss, for all weights but the words' vectors, and for ``x``."""
    x, lengths, saved, seen, view, weight, pooled = cache
    steps, n, _ = x.shape
    u = weights["u"]
    h = u.shape[2]
    grads = {"ow": pooled @ d_logits, "ob": d_logits.sum(keepdims=True)}
    d_pooled = weights["ow"][:, None] * d_logits
    d_weight = np.einsum("hn,thn->tn", d_pooled, seen)
    d_raw = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grads["av"] = np.einsum("tn,tan->a", d_raw, view)
    d_view = d_raw[:, None] * weights["av"][:, None] * (1 - view**2)
    grads["ab"] = d_view.sum(axis=(0, 2))
    grads["aw"] = (d_view @ seen.transpose(0, 2, 1)).sum(axis=0)
    d_seen = weight[:, None] * d_pooled + weights["aw"].T @ d_view
    d_seen = d_seen.reshape(steps, 2, h, n)
    d_gates = np.zeros((steps, 2, 3 * h, n), np.float32)
    d_u, d_ub = np.zeros_like(u), np.zeros_like(weights["ub"])
    d_state = np.zeros((2, h, n), np.float32)
    for t in reversed(range(steps)):
        back = steps - 1 - t
        state, both, candidate_in, candidate = saved[t]
        update, reset = both[:, :h], both[:, h:]
        d_state[0] += d_seen[t, 0]
        d_state[1] += d_seen[back, 1]
        live = _live(lengths, t, steps)
        d_live = np.where(live, d_state, 0)
        d_candidate = d_live * (1 - update) * (1 - candidate**2)
        d_both = np.concatenate([d_live * (state - candidate), d_candidate * candidate_in], axis=1)
        d_both *= (both > 0) & (both < 1)
        d_inner = np.concatenate([d_both, d_candidate * reset], axis=1)
        d_gates[t, 0, : 2 * h], d_gates[back, 1, : 2 * h] = d_both
        d_gates[t, 0, 2 * h :], d_gates[back, 1, 2 * h :] = d_candidate
        d_u += d_inner @ state.transpose(0, 2, 1)
        d_ub += d_inner[:, 2 * h :].sum(axis=2)
        d_state = u.transpose(0, 2, 1) @ d_inner + d_live * update + np.where(live, 0, d_state)
    d_gates = d_gates.reshape(steps, 6 * h, n)
    grads |= {"u": d_u, "ub": d_ub, "w": (d_gates @ x).sum(axis=0), "b": d_gates.sum(axis=(0, 2))}
    return grads, (weights["w"].T @ d_gates).transpose(0, 2, 1)


def fresh_weights(vocabulary: int, rng: np.random.Generator) -> Weights:
    def some(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    inputs = INPUTS
    word = some(vocabulary + 1, WORD_DIMS, scale=0.1)
    word[0] = 0  # words outside the vocabulary
    bias = np.tile(np.repeat(np.array([0.5, 0.5, 0], np.float32), HIDDEN), 2)
    return {
        "word": word,
        "char": some(CHAR_BUCKETS, CHAR_DIMS, scale=0.3),
        "w": some(6 * HIDDEN, inputs, scale=0.5 * inputs**-0.5),
        "b": bias,
        "u": some(2, 3 * HIDDEN, HIDDEN, scale=0.5 * HIDDEN**-0.5),
        "ub": np.zeros((2, HIDDEN), np.float32),
        "aw": some(HIDDEN, 2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
        "ab": np.zeros(HIDDEN, np.float32),
        "av": some(HIDDEN, scale=HIDDEN**-0.5),
        "ow": some(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
        "ob": np.full(1, -1.0, np.float32),
    }


def padded(docs: list[np.ndarray], spans: list[list[tuple[int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of word numbers, filled up with zeros, and their lengths."""
    flat = [d[a:b] for d, own in zip(docs, spans) for a, b in own]
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    ids = np.zeros((len(flat), max(1, int(lengths.max(initial=0)))), np.int64)
    for row, part in zip(ids, flat):
        row[: len(part)] = part
    return ids, lengths


def _ranges(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` at ``starts``, ``counts`` long, one after the other."""
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


def summed(rows: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each owner below ``size``."""
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[owner[order][cuts]] = np.add.reduceat(rows[order], cuts, axis=0)
    return out


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The log odds of a toxic document where something is met in so many documents of
    each kind, against those of any document; nearly 0 for what is met in few."""
    share = n_toxic / (n_toxic + n_clean)
    odds = (toxic + SHRINK * share) / (clean + SHRINK * (1 - share))
    return (np.log(odds) - np.log(share / (1 - share))).astype(np.float32)


def without_own(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """(label, thing): the evidence as a document of each label sees it that is not counted itself."""
    return np.stack([
        evidence(toxic, np.maximum(clean - 1, 0), n_toxic, n_clean),
        evidence(np.maximum(toxic - 1, 0), clean, n_toxic, n_clean),
    ])


def train(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = SEED) -> Network:
    """A network fitted to whole texts and their labels.

    What a word or letter group says by itself is counted over the documents. A
    document's own count is left out of what it sees in training, or rare words would
    give the labels away.
    """
    toxic = sum(labels)
    split = [words_of(t) for t in texts]
    if not 0 < toxic < len(labels) or not any(split):
        share = (toxic + 1) / (len(labels) + 2)
        return Network({}, {}, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    met = Counter(w for words in split for w in set(words))
    common = sorted((w for w, n in met.items() if n >= LEAST_DOCUMENTS), key=lambda w: (-met[w], w))[:VOCABULARY]
    vocabulary = {w: i + 1 for i, w in enumerate(common)}
    weights = fresh_weights(len(vocabulary), rng)
    every = sorted(met)
    number = {w: i for i, w in enumerate(every)}
    known = np.array([vocabulary.get(w, 0) for w in every])
    groups, counts = letter_groups(every)
    starts = np.cumsum(counts) - counts
    docs = [np.array([number[w] for w in words], np.int64) for words in split]
    spans = [windows_of(len(d)) for d in docs]
    target = np.array(labels, np.float32)
    in_words = np.zeros((2, len(every)), np.int64)
    in_groups = np.zeros((2, CHAR_BUCKETS), np.int64)
    for doc, label in zip(docs, labels):
        own = np.unique(doc)
        in_words[label, own] += 1
        if len(own):
            in_groups[label, np.unique(_ranges(groups, starts[own], counts[own]))] += 1
    sizes = (toxic, len(labels) - toxic)
    in_known = np.zeros((2, len(vocabulary) + 1), np.int64)
    in_known[:, known] = in_words * (known > 0)
    weights["word_evidence"] = evidence(in_known[1], in_known[0], *sizes)
    weights["char_evidence"] = evidence(in_groups[1], in_groups[0], *sizes)
    word_seen = without_own(in_known[1], in_known[0], *sizes)
    word_seen[:, 0] = 0
    char_seen = without_own(in_groups[1], in_groups[0], *sizes)
    fixed = ("word_evidence", "char_evidence")
    kinds = [np.flatnonzero(target == k) for k in (0, 1)]
    first = {k: np.zeros_like(v) for k, v in weights.items() if k not in fixed}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    for step in range(1, steps + 1):
        chosen, windows = [], 0
        while windows < BATCH_WINDOWS:  # both kinds in turn
            chosen.append(int(rng.choice(kinds[len(chosen) % 2])))
            windows += len(spans[chosen[-1]])
        ids, lengths = padded([docs[i] for i in chosen], [spans[i] for i in chosen])
        sizes = np.array([len(spans[i]) for i in chosen])
        # A word is told apart by the label of the document it is seen from.
        seen_from = np.repeat(np.array(labels)[chosen], sizes)
        used, at = np.unique((2 * ids + seen_from[:, None]).T, return_inverse=True)
        used, label = used // 2, used % 2
        rows = _ranges(groups, starts[used], counts[used])
        offsets = np.cumsum(counts[used]) - counts[used]
        chars = np.add.reduceat(weights["char"][rows], offsets, axis=0) / counts[used][:, None]
        strongest = np.maximum.reduceat(char_seen[np.repeat(label, counts[used]), rows], offsets)
        own = np.where(rng.random(len(used)) < WORD_DROPOUT, 0, known[used])
        inputs = np.concatenate(
            [weights["word"][own], word_seen[label, known[used]][:, None], chars, strongest[:, None]], axis=1
        ).astype(np.float32)
        logits, cache = run_network(weights, inputs[at.reshape(ids.T.shape)], lengths, keep=True)
        grads, d_x = gradients(weights, cache, _document_loss(logits, sizes, target[chosen]))
        d_inputs = summed(d_x.reshape(at.size, -1), at.reshape(-1), len(used))
        grads["word"] = summed(d_inputs[:, :WORD_DIMS], own, len(weights["word"]))
        grads["word"][0] = 0
        d_chars = d_inputs[:, WORD_DIMS + 1 : -1] / counts[used][:, None]
        by_group = np.repeat(d_chars, counts[used], axis=0)
        grads["char"] = summed(by_group, rows, CHAR_BUCKETS)
        rate = LEARNING_RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, grad in grads.items():
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.01 * (grad * grad - second[name])
            scaled = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
            decay = DECAY if name in ("word", "char") else 0
            weights[name] = (weights[name] * (1 - rate * decay) - rate * scaled).astype(np.float32)
    return Network(vocabulary, weights)


def _document_loss(logits: np.ndarray, sizes: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The loss's gradient by window: a document's own, dealt by how high each window scores."""
    out = np.empty_like(logits)
    at = 0
    for size, label in zip(sizes, target):
        part = logits[at : at + size]
        share = np.exp(part - part.max())
        share /= share.sum()
        out[at : at + size] = (_sigmoid(part.max()) - label) * share / len(sizes)
        at += size
    return out


class Scorer:
    """A network with the vectors of the words a task has met."""

    def __init__(self, network: Network):
        self.network = network
        self.number: dict[str, int] = {}
        self.vectors = np.zeros((1024, INPUTS), np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Rows of ``vectors``, of all the words and, last, of no word."""
        if len(self.number) > STORE_WORDS:
            self.number.clear()
        new = list(set(words).difference(self.number))
        if new:
            first = len(self.number)
            size = first + len(new)
            if size > len(self.vectors):
                grown = np.zeros((2 * size, self.vectors.shape[1]), np.float32)
                grown[:first] = self.vectors[:first]
                self.vectors = grown
            self.vectors[first:size] = self.network.inputs(new)
            self.number.update(zip(new, range(first, size)))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def score(self, texts: list[str]) -> np.ndarray:
        """The score of every text."""
        if not self.network.weights:
            return np.full(len(texts), 1 / (1 + np.exp(-self.network.prior)))
        best = np.empty(len(texts))
        split = [words_of(t) for t in texts]
        start = 0
        while start < len(split):  # as many texts at a time as make a pass, or one long one
            end, held = start, 0
            while end < len(split) and (end == start or held + len(split[end]) <= PASS_WINDOWS * STRIDE):
                held += len(split[end])
                end += 1
            best[start:end] = self._highest(split[start:end])
            start = end
        return 1 / (1 + np.exp(-best))

    def _highest(self, split: list[list[str]]) -> np.ndarray:
        """The highest window's logit of each text."""
        number = np.append(self.numbers([w for words in split for w in words]), 0)
        starts, lengths, owner = [], [], []
        at = 0
        for i, words in enumerate(split):
            spans = windows_of(len(words))
            starts += [at + a for a, _ in spans]
            lengths += [b - a for a, b in spans]
            owner += [i] * len(spans)
            at += len(words)
        starts, lengths, owner = (np.array(found, np.int64) for found in (starts, lengths, owner))
        out = np.full(len(split), -np.inf)
        order = np.argsort(lengths, kind="stable")
        for i in range(0, len(order), PASS_WINDOWS):
            part = order[i : i + PASS_WINDOWS]
            steps = max(1, int(lengths[part[-1]]))
            places = np.minimum(starts[part] + np.arange(steps)[:, None], len(number) - 1)
            logits = run_network(self.network.weights, self.vectors[number[places]], lengths[part])
            np.maximum.at(out, owner[part], logits.astype(np.float64))
        return out


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows that no training may see the label of."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    toxic: int = SAMPLE_TOXIC,
    clean: int = SAMPLE_CLEAN,
    chars: int = SAMPLE_CHARS,
    folds: int = FOLDS,
) -> tuple[list[str], list[int]]:
    """Texts and labels of the sample, at most ``toxic + clean`` of at most ``chars`` characters each."""
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), folds))
    known = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    hashed = known.withColumn("_hash", F.xxhash64("_id"))
    picked = docs.select(F.col(id_col).alias("_id"), text_of(docs, text_col).alias("_text"))
    picked = picked.filter(F.char_length("_text") <= chars)
    texts, found = [], []
    for label, most in ((1, toxic), (0, clean)):
        # Twice as many ids, as some have no document or a long one; at most that many rows.
        ids = hashed.filter(F.col("_label") == label).orderBy("_hash", "_id").limit(2 * most)
        rows = picked.join(F.broadcast(ids), "_id").orderBy("_hash", "_id", "_text").limit(most)
        own = list(dict.fromkeys(r["_text"] for r in rows.select("_text").collect()))
        texts += own
        found += [label] * len(own)
    return texts, found


def score(
    docs: DataFrame,
    network: Network,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Each row's id, ``keep`` and the ``score`` of its whole text."""
    small_batches(docs.sparkSession)
    own = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    picked = docs.select(own.alias("_row"), text_of(docs, text_col).alias("_text"))
    schema = T.StructType([picked.schema.fields[0], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(network)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            distinct = list(dict.fromkeys(texts))
            of = dict(zip(distinct, scorer.score(distinct)))
            scores = pa.array([float(of[t]) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=schema.names)

    scored = picked.mapInArrow(run, schema)
    return scored.select(
        F.col("_row.id").alias(id_col), *[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(keep)], "score"
    )


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """The network trained on the sample of ``labels`` with the texts of ``docs``."""
    return train(*training_sample(docs, labels))
