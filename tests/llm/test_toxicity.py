"""The recurrent network: gradients, windows, learning, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from docflow.llm import queries
from docflow.llm import toxicity as tx

SCHEMA = "doc_id long, text string, score double, _row long, _text string"
INSULTS = ("blorgface", "snargwit", "wumpkin")


def made_up(n, seed, toxic_share=0.3):
    """(text, label): toxic texts hold a few insults somewhere among plain words."""
    rng = np.random.default_rng(seed)
    plain = [f"{a}{b}{c}" for a in ("lo", "mi", "ta", "re") for b in ("na", "du", "ki") for c in ("s", "nt", "l", "mo")]
    texts, labels = [], []
    for _ in range(n):
        words = list(rng.choice(plain, rng.integers(3, 200)))
        toxic = bool(rng.random() < toxic_share)
        for _ in range(2 if toxic else 0):
            words.insert(int(rng.integers(len(words) + 1)), str(rng.choice(INSULTS)))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        spans = tx.windows_of(n)
        assert spans[0][0] == 0 and spans[-1][1] == n
        assert all(b - a == min(n, tx.WINDOW) for a, b in spans)
        assert all(c < b for (_, b), (c, _) in zip(spans, spans[1:]))


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    weights = {k: v.astype(np.float64) for k, v in tx.fresh_weights(3, rng).items()}
    x = rng.normal(size=(5, 4, tx.INPUTS))
    lengths = np.array([5, 3, 1, 0])
    out = rng.normal(size=4)

    def loss():
        return float((tx.run_network(weights, x, lengths) * out).sum())

    logits, cache = tx.run_network(weights, x, lengths, keep=True)
    grads, d_x = tx.gradients(weights, cache, out)
    for array, grad in [*((weights[k], g) for k, g in grads.items()), (x, d_x)]:
        for _ in range(12):
            at = tuple(rng.integers(s) for s in array.shape)
            was = array[at]
            array[at] = was + 1e-3
            up = loss()
            array[at] = was - 1e-3
            down = loss()
            array[at] = was
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-2 * max(1, abs(grad[at]))


def test_letter_groups_by_hand():
    groups, counts = tx.letter_groups(["ab", "abc", "éabcd"])
    # <ab> has two groups of three, <abc> three of three and one of five, <éabcd> five and three.
    assert counts.tolist() == [2, 4, 8]
    again, _ = tx.letter_groups(["abc"])
    assert groups[2:6].tolist() == again.tolist()


def test_learns_insults_and_finds_them_anywhere():
    network = tx.train(*made_up(300, 1), steps=120)
    texts, labels = made_up(200, 2)
    scores = tx.Scorer(network).score(texts)
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.95
    plain = " ".join(["lonas", "midunt"] * 20_000)
    late = tx.Scorer(network).score([plain, plain + " wumpkin snargwit", "", "wumpkin snargwit " + plain])
    assert late[0] < 0.5 <= late[1] and late[3] >= 0.5
    # The order and number of texts at a time change nothing but the last digits.
    one_by_one = [tx.Scorer(network).score([t])[0] for t in texts[:40]]
    assert np.allclose(one_by_one, scores[:40], atol=1e-4)


def test_network_reads_order_and_every_part():
    """With the recurrent states or the attention replaced by constants, results change."""
    texts, labels = made_up(120, 3)
    network = tx.train(texts, labels, steps=60)
    scores = tx.Scorer(network).score(texts)
    for name in ("u", "aw", "word", "char"):
        other = tx.Network(network.vocabulary, network.weights | {name: np.zeros_like(network.weights[name])})
        assert not np.allclose(tx.Scorer(other).score(texts), scores, atol=1e-3), name


def test_without_both_labels_the_share_is_scored():
    for texts, labels, share in ([], [], 1 / 2), (["a b", "c"], [0, 0], 1 / 4), (["", "?"], [0, 1], 2 / 4):
        network = tx.train(texts, labels)
        assert np.allclose(tx.Scorer(network).score(["a", "", "x y"]), share)


def test_odd_rows(spark):
    network = tx.train(*made_up(60, 5), steps=20)
    rows = [
        (1, None), (2, ""), (3, " \n?"), (4, "wumpkin"), (4, "wumpkin"), (5, "WUMPKIN"), (None, "lonas"),
        (6, "é ß 𝒳 " * 5000), (7, "x" * 300_000), (8, "1 " * 30_000), (9, "퟿ "),
    ]
    docs = spark.createDataFrame([(i, t, 7.0, 7, "x") for i, t in rows], SCHEMA)
    got = tx.score(docs, network, keep=("text", "_row", "_text")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted((i or 0, t or "") for i, t in rows)
    assert all(0 <= r["score"] <= 1 and (r["_row"], r["_text"]) == (7, "x") for r in got)
    by_text = {r["text"]: r["score"] for r in got}
    assert by_text[None] == by_text[""] == by_text[" \n?"]
    assert by_text["wumpkin"] == by_text["WUMPKIN"]
    assert tx.score(docs.limit(0), network).count() == 0


def test_sample_leaves_out_what_is_held_out(spark):
    labels = spark.createDataFrame(
        [(i, i % 2, "x") for i in range(200)] + [(None, 1, "x"), (3, None, "x"), (4, 5, "x")], "doc_id long, toxic int, _label string"
    )
    learnt = next(i for i in range(200) if zlib.crc32(str(i).encode()) % 5)
    docs = spark.createDataFrame(
        [(i, f"text {i}", 1) for i in range(200)] + [(2, "y" * 50, 1), (learnt, None, 1), (7, "text 7", 1)],
        "doc_id long, text string, _id int",
    )
    texts, found = tx.training_sample(docs, labels, chars=40)
    want = {f"text {i}": i % 2 for i in range(200) if zlib.crc32(str(i).encode()) % 5} | {"": learnt % 2}
    assert dict(zip(texts, found)) == want
    few, few_labels = tx.training_sample(docs, labels, toxic=7, clean=9)
    assert (few_labels.count(1), few_labels.count(0)) == (7, 9) and set(few) <= set(want)
    assert tx.training_sample(docs.limit(0), labels) == ([], [])
    assert tx.training_sample(docs, labels.limit(0)) == ([], [])


def test_held_out_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op11_toxicity(spark, folder).toPandas()
    assert list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    labels = pq.read_table(f"{folder}/labels.parquet").to_pandas().drop_duplicates("doc_id")
    assert len(got) == pq.read_table(f"{folder}/documents.parquet").num_rows
    known = got.merge(labels, on="doc_id")
    known = known[known.held_out]
    assert (known.predicted == known.toxic).mean() > 0.95
    order = known.score.rank()
    toxic = known.toxic == 1
    area = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.92, area


def test_query_does_not_shuffle_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = tx.score(docs, tx.Network({}, {}, 0.0))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert tx.score(docs, tx.Network({}, {}, 0.0)).filter(F.col("score") != 0.5).count() == 0
