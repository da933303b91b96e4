"""The append-only table of answers to gap-filling requests.

Every append is a folder of its own, ``part=<time>``, with the answers partitioned by
the first digits of their keys, so that a reader who knows which keys are asked for
opens those prefixes only. Many small parts are merged by :func:`compact_answers` into a
snapshot, which holds once a pointer names it: a compaction that ends half-way leaves
the table as it was, and a reader sees every answer once at any time.
"""

from __future__ import annotations

import json
import time
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from docflow.sources import folders

# ``seq`` is the append order: every answer of a run carries the run's number.
ANSWER_SCHEMA = StructType(
    [
        StructField("seq", LongType()),
        StructField("key", StringType()),
        StructField("fields", StringType()),
        StructField("input_tokens", LongType()),
        StructField("output_tokens", LongType()),
        StructField("cost_usd", DoubleType()),
        StructField("latency_seconds", DoubleType()),
    ]
)


# As stored: a request that failed has the ``error`` and no fields.
STORED_SCHEMA = StructType([*ANSWER_SCHEMA.fields, StructField("error", StringType())])
_PARTED = StructType([*STORED_SCHEMA.fields, StructField("part", StringType()), StructField("prefix", StringType())])

# Keys are hexadecimal: 256 prefixes.
PREFIX_DIGITS = 2

_POINTERS = "_pointers"
_SNAPSHOT = "part=snapshot-"


def key_prefix(key: Column) -> Column:
    """The part of a key that the table is partitioned by."""
    return F.substring(key, 1, PREFIX_DIGITS)


def touched_prefixes(requests: DataFrame) -> list[str]:
    """The prefixes of the keys in ``requests``, at most as many as there are prefixes."""
    keyed = requests.filter(F.col("key").isNotNull())
    return sorted(row[0] for row in keyed.select(key_prefix(F.col("key"))).distinct().collect())


def append_answers(answers: DataFrame, path: str) -> None:
    """Append answers, and failures if the frame has the column ``error``, as one new part.

    Rows that come dealt by prefix make one file a prefix.
    """
    if "error" not in answers.columns:
        answers = answers.withColumn("error", F.lit(None).cast("string"))
    rows = answers.select(*STORED_SCHEMA.names, key_prefix(F.col("key")).alias("prefix"))
    rows.write.partitionBy("prefix").parquet(f"{path}/part={time.time_ns():020}-{uuid4().hex[:8]}")


def read_answers(spark: SparkSession, path: str, prefixes: list[str] | None = None) -> DataFrame:
    """All answers ever given, or those of some prefixes; none if there is no table yet.

    Failures are not among them.
    """
    return _stored(spark, path, prefixes).filter("error IS NULL").select(*ANSWER_SCHEMA.names)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """``(seq, key, error)`` of every request that failed; they stay pending."""
    return _stored(spark, path).filter("error IS NOT NULL").select("seq", "key", "error")


def _pointer(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The number of the last pointer and what it says."""
    _, files = folders.names(spark, f"{path}/{_POINTERS}")
    numbers = [int(name) for name in files if name.isdigit()]
    if not numbers:
        return 0, {"snapshot": None, "covers": []}
    return max(numbers), json.loads(folders.get(spark, f"{path}/{_POINTERS}/{max(numbers):010}"))


def live_parts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The folders and the files, of a table as first laid out, that make up the table now."""
    _, pointer = _pointer(spark, path)
    parts, files = folders.names(spark, path)
    covered = set(pointer["covers"])
    parts = [p for p in parts if p not in covered and (not p.startswith(_SNAPSHOT) or p == pointer["snapshot"])]
    return [p for p in parts if p.startswith("part=")], [f for f in files if f not in covered]


def _stored(spark: SparkSession, path: str, prefixes: list[str] | None = None) -> DataFrame:
    parts, files = live_parts(spark, path)
    return _rows(spark, path, parts, files, prefixes)


def _rows(
    spark: SparkSession, path: str, parts: list[str], files: list[str], prefixes: list[str] | None = None
) -> DataFrame:
    """Rows of the named folders and files, with their ``prefix``."""
    columns = [*STORED_SCHEMA.names, "prefix"]
    rows = spark.createDataFrame([], StructType([*STORED_SCHEMA.fields, _PARTED["prefix"]]))
    if parts:
        below = [f"{path}/{part}" for part in parts]
        rows = spark.read.schema(_PARTED).option("basePath", path).parquet(*below).select(*columns)
    if files:
        flat = spark.read.schema(STORED_SCHEMA).parquet(*[f"{path}/{file}" for file in files])
        flat = flat.withColumn("prefix", key_prefix(F.col("key")))
        rows = rows.unionByName(flat) if parts else flat
    return rows if prefixes is None else rows.filter(F.col("prefix").isin(prefixes))


def compact_answers(spark: SparkSession, path: str) -> None:
    """Merge all finished parts into one snapshot, one file a prefix, and remove them.

    The snapshot is written, then a pointer names it and what it covers, then what is
    covered goes. Parts that are still being written stay as they are. One compaction
    at a time; of two at once the later pointer is refused.
    """
    parts, files = live_parts(spark, path)
    done = [p for p in parts if folders.exists(spark, f"{path}/{p}/_SUCCESS")]
    if not done and not files:
        return
    number, pointer = _pointer(spark, path)
    # What an earlier pointer covers may still be there.
    there = sum(folders.names(spark, path), [])
    covers = done + files + [name for name in pointer["covers"] if name in there]
    name = f"{_SNAPSHOT}{time.time_ns():020}-{uuid4().hex[:8]}"
    rows = _rows(spark, path, done, files)
    rows.repartition("prefix").write.partitionBy("prefix").parquet(f"{path}/{name}")
    point_to(spark, path, number + 1, name, covers)
    sweep(spark, path)


def point_to(spark: SparkSession, path: str, number: int, snapshot: str, covers: list[str]) -> None:
    said = json.dumps({"snapshot": snapshot, "covers": covers})
    folders.put(spark, f"{path}/{_POINTERS}/{number:010}", said)


def sweep(spark: SparkSession, path: str) -> None:
    """Remove what the pointer says is covered, and snapshots that no pointer names."""
    number, pointer = _pointer(spark, path)
    parts, files = folders.names(spark, path)
    live, flat = live_parts(spark, path)
    for name in [p for p in parts if p.startswith("part=") and p not in live] + [f for f in files if f not in flat]:
        folders.remove(spark, f"{path}/{name}")
    for old in folders.names(spark, f"{path}/{_POINTERS}")[1]:
        if old.isdigit() and int(old) < number:
            folders.remove(spark, f"{path}/{_POINTERS}/{old}")


def first_answers(answers: DataFrame) -> DataFrame:
    """One row per key: the answer that was appended first.

    An aggregate rather than a ranking window: it combines before the shuffle,
    so a key with very many entries does not have to fit in one task.
    """
    first = F.min(F.struct(*ANSWER_SCHEMA.names))
    return answers.groupBy("key").agg(first.alias("first")).select("first.*")
