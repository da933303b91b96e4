"""Filling gaps: ask an outside caller for the fields no pattern found.

The caller may be a paid service, so its answers are appended to a table before
anything else uses them, each distinct request is asked once, and a request
answered in an earlier run is never asked again. An answer of null is an answer:
the value is not in the document.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from docflow.certificate import CERTIFICATES
from docflow.functions import present
from docflow.operators.frames import require_columns
from docflow.operators.review import missing_fields
from docflow.operators.score import ratio, same_value, with_truth
from docflow.sources.answers import PREFIX_DIGITS, append_answers, first_answers, key_prefix
from docflow.sources.scratch import staged
from docflow.spec import Field, Spec

# What a caller returns: the answered fields, tokens read and tokens written.
Answer = tuple[dict[str, object], int, int]
# A caller gets the document's text and the names of the missing fields.
Caller = Callable[[str, list[str]], Answer]

# List prices in dollars per million tokens.
INPUT_PRICE_PER_MTOK = 5.00
OUTPUT_PRICE_PER_MTOK = 25.00

# Requests of one key are spread over this many join partitions. Many copies of
# one document make one key, and these may be a large part of all requests.
SALTS = 64

# Requests that are asked between two commits of the answer table.
WAVE_REQUESTS = 100_000
WAVE_WRITERS = 16

_REQUEST_TYPES = {"string": "string", "bigint": "integer", "double": "number", "date": "string"}


@dataclass(frozen=True)
class GapFill:
    """What is asked, of what, about which layouts, and at what price."""

    model: str
    prompt: str
    layouts: tuple[str, ...] = ("C",)
    input_price_per_mtok: float = INPUT_PRICE_PER_MTOK
    output_price_per_mtok: float = OUTPUT_PRICE_PER_MTOK

    def __post_init__(self) -> None:
        if "#" in self.model:
            raise ValueError("'#' separates the parts of a request key; the model name has one")

    @property
    def version(self) -> str:
        """Changes with the prompt, so answers to another prompt are never reused."""
        return hashlib.sha256(self.prompt.encode("utf-8")).hexdigest()


def request_key(config: GapFill, missing: Column, text: Column) -> Column:
    """SHA-256 over model, prompt version, sorted field names and text."""
    names = F.array_join(F.array_sort(missing), ",")
    parts = F.concat_ws("#", F.lit(config.model), F.lit(config.version), names, text)
    return F.sha2(parts, 256)


def request_schema(missing: Column, spec: Spec = CERTIFICATES) -> Column:
    """JSON schema of an answer that has exactly the missing fields, each nullable."""
    shape = StructType(
        [StructField("type", ArrayType(StringType())), StructField("format", StringType())]
    )
    entries: list[Column] = []
    for field in spec.fields:
        types = F.array(F.lit(_REQUEST_TYPES[field.dtype]), F.lit("null"))
        form = F.lit("date" if field.dtype == "date" else None).cast("string")
        entries += [F.lit(field.name), F.struct(types.alias("type"), form.alias("format"))]
    every = F.create_map(*entries).cast(MapType(StringType(), shape))
    asked = F.map_filter(every, lambda name, _: F.array_contains(missing, name))
    return F.to_json(
        F.struct(
            F.lit("object").alias("type"),
            asked.alias("properties"),
            missing.alias("required"),
            F.lit(False).alias("additionalProperties"),
        )
    )


def plan_requests(routed: DataFrame, config: GapFill, spec: Spec = CERTIFICATES) -> DataFrame:
    """Extracted documents of the configured layouts, with what they lack.

    Adds ``missing`` and, where something is missing, the request ``key``; the
    text is kept only there. A document that lacks nothing needs no request.
    """
    require_columns(routed, ("file", "text", "layout", "no_extraction"), "the routed frame")
    asks = F.size("missing") > 0
    eligible = F.col("layout").isin(*config.layouts) & ~F.col("no_extraction")
    return (
        routed.filter(eligible)
        .withColumn("missing", missing_fields(spec))
        .select(
            "file",
            "layout",
            *spec.names,
            "missing",
            F.when(asks, request_key(config, F.col("missing"), F.col("text"))).alias("key"),
            F.when(asks, F.col("text")).alias("text"),
        )
    )


def pending_requests(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per distinct request that no answer exists for yet.

    What is open is found from keys and file names; texts are fetched for open
    requests only, so a rerun moves none.
    """
    files = requests.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("file").alias("file"))
    still_open = files.join(answers.select("key"), "key", "left_anti")
    texts = requests.select("key", "file", "text", "missing")
    return texts.join(still_open, ["key", "file"], "left_semi").dropDuplicates(["key"])


def request_cost(config: GapFill) -> Column:
    read = F.col("input_tokens") / 1_000_000 * config.input_price_per_mtok
    written = F.col("output_tokens") / 1_000_000 * config.output_price_per_mtok
    return read + written


def answer_requests(
    pending: DataFrame,
    caller: Caller,
    config: GapFill,
    path: str,
    parallelism: int | None = None,
    allow_speculation: bool = False,
    concurrency: int = 1,
    wave_requests: int = WAVE_REQUESTS,
) -> int:
    """Ask the caller once per pending request, append the answers, return the run.

    The run's number is the ``seq`` of its answers. A call that raises costs only
    itself: it is stored with its error (``read_failures``) and stays pending. The
    requests go in waves of about ``wave_requests``, each committed before the next
    is asked, so a job that is aborted loses the answers of one wave at most. The
    requests are written once, in a folder per wave, and a wave reads its own. A wave
    is dealt by key prefix, as the answer table is laid out.

    ``parallelism`` is the number of tasks of a wave and ``concurrency`` the calls a
    task makes at a time; more tasks also mean fewer calls to repeat when an executor
    is lost. Speculative copies of a task would call, and pay, twice, so they are
    refused.
    """
    spark = pending.sparkSession
    if not allow_speculation and spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("spark.speculation is on: requests would be asked, and paid, twice")
    tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        from concurrent.futures import ThreadPoolExecutor

        def one(key: str, text: str, missing: list[str]) -> tuple:
            start = time.monotonic()
            try:
                fields, read, written = caller(text, [str(name) for name in missing])
                answer = (json.dumps(fields), read, written, None)
            except Exception as error:
                answer = (None, 0, 0, f"{type(error).__name__}: {error}")
            return (key, *answer, time.monotonic() - start)

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                rows = list(pool.map(one, batch["key"], batch["text"], batch["missing"]))
                yield pd.DataFrame(
                    rows,
                    columns=["key", "fields", "input_tokens", "output_tokens", "error", "latency_seconds"],
                )

    run = time.time_ns() // 1000
    requests, waves = wave_table(pending, wave_requests)
    # More tasks than prefixes share the prefixes out.
    share = F.pmod(F.xxhash64("key"), F.lit(-(-tasks // 16**PREFIX_DIGITS)))
    for wave in range(waves):
        answers = (
            one_wave(requests, wave)
            .repartition(tasks, key_prefix(F.col("key")), share)
            .mapInPandas(
                ask,
                "key string, fields string, input_tokens bigint, output_tokens bigint, "
                "error string, latency_seconds double",
            )
            .withColumns({"seq": F.lit(run).cast("bigint"), "cost_usd": request_cost(config)})
        )
        append_answers(answers, path)
    return run


def wave_table(pending: DataFrame, wave_requests: int = WAVE_REQUESTS) -> tuple[DataFrame, int]:
    """``(key, text, missing, wave)`` written in a folder per wave, and how many waves there are.

    The keys are counted before their texts are fetched.
    """
    keys = pending.select("key").count()
    waves = -(-keys // wave_requests)
    if not waves:
        return pending.select("key", "text", "missing", F.lit(0).alias("wave")), 0
    dealt = pending.select("key", "text", "missing").withColumn(
        "wave", F.pmod(F.xxhash64("key"), F.lit(waves)).cast("int")
    )
    # A wave's folder is written by several tasks, not by all.
    writers = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(WAVE_WRITERS))
    return staged(dealt.repartition("wave", writers), "pending-requests", ("wave",)), waves


def one_wave(requests: DataFrame, wave: int) -> DataFrame:
    return requests.filter(F.col("wave") == wave).select("key", "text", "missing")


def _iso_date(text: Column) -> Column:
    """YYYY-MM-DD or YYYYMMDD, nothing else; impossible dates and year 0 are null."""
    plain = text.rlike(r"^\d{4}-\d{2}-\d{2}\z|^\d{8}\z") & ~F.startswith(text, F.lit("0000"))
    return F.try_to_date(F.when(plain, F.replace(text, F.lit("-"))), "yyyyMMdd")


def _coerced(field: Field) -> Column:
    """One answered value in the field's type, null if it cannot be."""
    wanted = "string" if field.dtype == "date" else field.dtype
    value = F.try_variant_get("_answer", f"$.{field.name}", wanted)
    return _iso_date(value) if field.dtype == "date" else value


def coerce_answers(answers: DataFrame, spec: Spec = CERTIFICATES) -> DataFrame:
    """Add ``answered_<field>``, typed, to rows with the answer JSON in ``fields``."""
    return (
        answers.withColumn("_answer", F.try_parse_json("fields"))
        .withColumns({f"answered_{field.name}": _coerced(field) for field in spec.fields})
        .drop("_answer")
    )


def apply_answers(
    requests: DataFrame, answers: DataFrame, run: int | None = None, spec: Spec = CERTIFICATES
) -> DataFrame:
    """Outcome per document: the record with its gaps filled, and what that took.

    Only missing fields are filled. A request first answered in run ``run`` is
    paid for by the first of its files; all others had it from the answer table.
    Documents that lack nothing take no part in the join.
    """
    needing = requests.filter(F.size("missing") > 0).withColumn(
        "_salt", F.pmod(F.xxhash64("file"), F.lit(SALTS))
    )
    # At most SALTS rows per key are left after the first aggregation.
    salts = needing.groupBy("key", "_salt").agg(F.min("file").alias("_first"))
    keys = salts.groupBy("key").agg(
        F.min("_first").alias("_payer"), F.collect_list("_salt").alias("_salts")
    )
    answered = (
        keys.join(coerce_answers(first_answers(answers), spec), "key")
        .select("*", F.explode("_salts").alias("_salt"))
        .drop("_salts", "fields", "input_tokens", "output_tokens")
    )
    fresh = F.col("_fresh")
    merged = [
        F.coalesce(name, f"answered_{name}").alias(name) for name in spec.names
    ]
    filled = present(
        *[
            F.when(F.col(name).isNull() & F.col(f"answered_{name}").isNotNull(), F.lit(name))
            for name in spec.names
        ]
    )
    outcomes = (
        needing.join(answered, ["key", "_salt"], "left")
        .withColumns(
            {
                "called": F.col("seq").isNotNull(),
                "_fresh": F.coalesce(
                    (F.col("seq") == F.lit(run).cast("bigint")) & (F.col("file") == F.col("_payer")),
                    F.lit(False),
                ),
            }
        )
        .select(
            "file",
            "layout",
            *merged,
            "called",
            (F.col("called") & ~fresh).alias("from_cache"),
            F.when(fresh, F.col("cost_usd")).otherwise(F.lit(0.0)).alias("cost_usd"),
            F.when(fresh, F.col("latency_seconds")).otherwise(F.lit(0.0)).alias("latency_seconds"),
            F.col("missing").alias("fields_requested"),
            filled.alias("fields_filled"),
        )
    )
    nothing = F.array().cast("array<string>")
    complete = requests.filter(F.size("missing") == 0).select(
        "file",
        "layout",
        *spec.names,
        F.lit(False).alias("called"),
        F.lit(False).alias("from_cache"),
        F.lit(0.0).alias("cost_usd"),
        F.lit(0.0).alias("latency_seconds"),
        nothing.alias("fields_requested"),
        nothing.alias("fields_filled"),
    )
    return outcomes.unionByName(complete)


def gapfill_report(
    outcomes: DataFrame, truth: DataFrame, config: GapFill, spec: Spec = CERTIFICATES
) -> DataFrame:
    """One row: accuracy before and after, cost and latency, over the key's documents
    of the configured layouts. Key rows without an outcome are counted apart."""
    key = truth.filter(F.col("layout").isin(*config.layouts))
    scored = with_truth(
        outcomes.withColumn("no_extraction", F.lit(False)), key, spec, how="right",
        also=("called", "from_cache", "cost_usd", "latency_seconds", "fields_filled"),
    )
    has_outcome = F.col("called").isNotNull()
    fresh = F.col("called") & ~F.col("from_cache")

    def correct(before: bool) -> Column:
        hits = F.lit(0).cast("bigint")
        for field in spec.fields:
            after = F.col(field.name)
            unfilled = F.when(~F.array_contains("fields_filled", field.name), after)
            hits = hits + same_value(field, unfilled if before else after).cast("bigint")
        return F.coalesce(F.sum(F.when(has_outcome, hits)), F.lit(0))

    totals = scored.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(~has_outcome).alias("without_extraction"),
        F.count_if("called").alias("needing"),
        F.count_if("from_cache").alias("cache_hits"),
        F.count_if(fresh).alias("fresh_calls"),
        (F.count_if(has_outcome) * len(spec.names)).alias("fields"),
        correct(before=True).alias("correct_before"),
        correct(before=False).alias("correct_after"),
        F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost_usd"),
        F.avg(F.when(fresh, F.col("latency_seconds"))).alias("mean_fresh_latency_seconds"),
    )
    return totals.withColumns(
        {
            "accuracy_before": ratio(F.col("correct_before"), F.col("fields")),
            "accuracy_after": ratio(F.col("correct_after"), F.col("fields")),
            "cost_per_needing_usd": ratio(F.col("total_cost_usd"), F.col("needing")),
            "cost_per_document_usd": ratio(F.col("total_cost_usd"), F.col("documents")),
        }
    )
