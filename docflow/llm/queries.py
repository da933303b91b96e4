"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import (
    centroids,
    chat,
    decontaminate,
    html_text,
    line_dedup,
    lm_score,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    toxicity,
)
from docflow.llm.common import small_batches

Query = Callable[[SparkSession, str], DataFrame]

CONTROL_CONVERSATION = -7
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of every document, and whether it is kept."""
    return quality.judge(table(spark, sf_dir, "documents"))


# Labels of more documents than this are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored against those labelled good."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    good = F.broadcast(good) if good.count() <= BROADCAST_LABELS else good
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(good, "doc_id", "left")
    return lm_score.score(docs, "good")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reads back from every formatted conversation and from its loss mask."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(CONTROL_CONVERSATION, 0, "user", CONTROL_TEXT), (CONTROL_CONVERSATION, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    formatted = chat.format_conversations(turns.unionByName(control))
    small_batches(spark)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = chat.read_back(text)
                loss = chat.learnt(text, [(s["start"], s["end"]) for s in spans])
                whole = "".join(f"{role}\n{content}\n" for role, content in turns)
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return formatted.mapInArrow(
        digest,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's removed lines, and a digest of what is left of its text."""
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_lines",
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed_lines", lambda x: x.cast("string")), ",").alias("removed_lines"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text"), 256).alias("text_sha256"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.interleave(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside benchmark windows, and the items they are of."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a network trained on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector, its distance, and the clusters' inertia."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with the commoner form it may be a slip of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    own = [f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()]
    return {f.__name__: f for f in own}
