"""Quality rules: fixed base rules, and robust multivariate outliers per language and source.

Each document's statistics become a vector of six: log mean word length, and the
square roots of five shares (symbols, other signs and capitals among characters,
repeated words, repeated lines). Per language and source the centre and scatter of
these vectors are the minimum covariance determinant estimate: that of the three
quarters of the rows which give the least determinant. It is found by
concentration steps over all rows, from two starts (medians with absolute
deviations, means with covariances): keep the rows nearest to the centre, estimate
anew, until the determinants rest. One reweighting step follows. A document is
rejected if its squared Mahalanobis distance exceeds a high quantile of the
chi-squared law.

A step is two aggregations over all rows of all groups at once: a histogram of
distances, whose bins decide which rows are near, then sums of products. A group
of any size is thus a few numbers per task; only these meet. Scatters get a floor
(``FLOORS``), since half of a source may be alike to the last digit.

Groups of fewer than ``min_rows`` rows are judged by their language, and that by
the whole table; a table of fewer rows rejects by the base rules alone. Defined
cases: a null text has no words; null languages and sources are values like any
other; a document without words is rejected by the base rules and in no estimate;
rows with equal ids are rows of their own; an empty table gives no rows; further
columns are kept if asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import BLANKS, shielded, small_batches, text_of
from docflow.sources.scratch import staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
MIN_ROWS = 200
SUPPORT = 0.75
CUT = 0.9999
REWEIGHT_CUT = 0.975
# Groups of languages and sources beyond which rows are joined to them by a shuffle.
BROADCAST_GROUPS = 100_000
# Standard deviations below which no direction of a statistic is trusted.
FLOORS = (0.08, 0.05, 0.05, 0.05, 0.15, 0.15)

_P = len(FLOORS)
_BLANK_BYTES = BLANKS.encode()
_SYMBOL_BYTES = SYMBOLS.encode()
_SIGN_BYTES = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in SYMBOLS)
_CAPITALS = bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = tuple(f"v{i}" for i in range(_P))


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside a run of ``window`` words that is there twice or more."""
    n = len(words) - window + 1
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if n < 2 or len(known) == len(words):
        return 0
    name, size = ids, 1
    while size < window:  # names of runs of 2, 4, ... words, then of the whole window
        step = min(size, window - size)
        pair = name[: len(name) - step] * (len(words) + 1) + name[step:]
        name, size = np.unique(pair, return_inverse=True)[1], size + step
    counts = np.bincount(name)
    if len(counts) == n:
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[name] > 1)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str) -> tuple:
    """The five counts, then the vector (zeros for a text without words)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return (0,) * 5 + (0.0,) * _P

    def count(of: bytes) -> int:
        return len(data) - len(data.translate(None, of))

    chars = len(text) - count(_BLANK_BYTES)
    symbols = count(_SYMBOL_BYTES)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    same = len(lines) - len(set(lines))
    again = repeated_words(words)
    shares = (symbols / chars, count(_SIGN_BYTES) / chars, count(_CAPITALS) / chars, again / len(words), same / len(lines))
    return (len(words), chars, symbols, same, again, math.log(chars / len(words)), *map(math.sqrt, shares))


def with_statistics(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """``keep``, the counts, ``base_failed`` and the vector of each row."""
    small_batches(docs.sparkSession)
    picked = docs.select(*[docs[c] for c in keep], text_of(docs, text_col).alias("_text"))
    added = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in VECTOR]
    schema = T.StructType(picked.schema.fields[:-1] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            for i, field in enumerate(added):
                kind = pa.int64() if field.dataType == T.LongType() else pa.float64()
                columns.append(pa.array([f[i] for f in found], kind))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return picked.mapInArrow(run, schema).withColumn("base_failed", failed)


def chi2_cdf(x: float, dims: int) -> float:
    """Of the chi-squared law with an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(dims // 2):
        total, term = total + term, term * (x / 2) / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dims) < p else (low, mid)
    return low


def consistency(share: float) -> float:
    """What the scatter of the nearest ``share`` of normal rows is too small by."""
    return 1.0 if share >= 1 else share / chi2_cdf(chi2_quantile(share, _P), _P + 2)


def _distance() -> Column:
    off = [F.col(v) - F.col("mean")[i] for i, v in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i in range(_P):
        for j in range(i, _P):
            total = total + (1 if i == j else 2) * F.col("inverse")[i * _P + j] * off[i] * off[j]
    return F.greatest(total, F.lit(0.0))


def _moments() -> list[Column]:
    pairs = [(i, j) for i in range(_P) for j in range(i, _P)]
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v) for v in VECTOR]).alias("sums"),
        F.array(*[F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])) for i, j in pairs]).alias("products"),
    ]


def _estimates(moments: DataFrame, share: float, keys: dict[str, str]) -> DataFrame:
    """Centre, inverse scatter and log determinant of each group from its sums."""
    names = list(keys)
    factor = consistency(share)
    schema = ", ".join([f"{k} {t}" for k, t in keys.items()]) + ", mean array<double>, inverse array<double>, logdet double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(_P)
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                mean = np.asarray(row["sums"], float) / row["n"]
                scatter = np.zeros((_P, _P))
                scatter[upper] = np.asarray(row["products"], float) / row["n"]
                scatter = scatter + np.triu(scatter, 1).T - np.outer(mean, mean)
                scatter = factor * scatter + np.diag(np.square(FLOORS))
                logdet = float(np.linalg.slogdet(scatter)[1])
                out.append((*[row[k] for k in names], mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), logdet))
            yield pd.DataFrame(out, columns=[*names, "mean", "inverse", "logdet"])

    return moments.mapInPandas(run, schema)


def _starts(rows: DataFrame, few: bool) -> DataFrame:
    """Two first estimates of each group: ``start`` 0 from medians, 1 from means."""
    small = F.broadcast if few else lambda found: found
    medians = rows.groupBy("group").agg(F.array(*[F.percentile_approx(v, 0.5, 10000) for v in VECTOR]).alias("mean"))
    off = [F.abs(F.col(v) - F.col("mean")[i]) for i, v in enumerate(VECTOR)]
    spread = (
        rows.join(small(medians), "group").groupBy("group").agg(F.array(*[F.percentile_approx(x, 0.5, 10000) for x in off]).alias("mad"))
    )
    zero = F.lit(0.0)
    inverse = F.array(
        *[
            1 / (F.pow(1.4826 * F.col("mad")[i], 2) + FLOORS[i] ** 2) if i == j else zero
            for i in range(_P)
            for j in range(_P)
        ]
    )
    robust = medians.join(spread, "group").select(
        "group", F.lit(0).alias("start"), "mean", inverse.alias("inverse"), zero.alias("logdet")
    )
    plain = rows.groupBy("group").agg(*_moments()).withColumn("start", F.lit(1))
    return robust.unionByName(_estimates(plain, 1.0, {"group": "string", "start": "int"}))


def mcd(rows: DataFrame, support: float = SUPPORT, few: bool = False) -> DataFrame:
    """``(group, mean, inverse, logdet)`` of the rows ``(group, v0..)``, reweighted once.

    Each group's starts take steps until their own determinant rests: one that no longer
    falls is left as it is, whatever the other groups do. If the groups are ``few``, what
    there is per group goes to every task, and no row is dealt by its group.
    """
    small = F.broadcast if few else lambda found: found
    now = staged(_starts(rows, few).withColumn("rests", F.lit(False)), "mcd-starts")
    first = True
    while not now.filter("not rests").isEmpty():
        moving = now.filter("not rests")
        near = rows.join(small(moving), "group").select(
            "group", "start", *VECTOR, F.floor(32 * F.log2(_distance() + 1e-9)).cast("int").alias("bin")
        )
        bins = near.groupBy("group", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
        # Bins of one group are a few thousand at most, however many rows it has.
        bins = bins.selectExpr(
            "group", "start", "bin",
            "sum(n) over (partition by group, start order by bin) as below",
            "sum(n) over (partition by group, start) as total",
        )
        cut = bins.filter(F.col("below") >= F.ceil(support * F.col("total"))).groupBy("group", "start").agg(F.min("bin").alias("cut"))
        chosen = near.join(small(cut), ["group", "start"]).filter("bin <= cut")
        moments = chosen.groupBy("group", "start").agg(*_moments())
        made = _estimates(moments, support, {"group": "string", "start": "int"})
        estimate = ("mean", "inverse", "logdet")
        was = moving.select("group", "start", F.struct(*estimate).alias("was"))
        falls = F.col("logdet") < F.col("was.logdet") - 1e-6 * (1 + F.abs("was.logdet"))
        # The starts are no estimates yet: what the first step makes is taken as it is.
        falls = F.lit(True) if first else falls
        stepped = made.join(was, ["group", "start"]).select(
            "group", "start", *[F.when(falls, F.col(c)).otherwise(F.col(f"was.{c}")).alias(c) for c in estimate], (~falls).alias("rests")
        )
        now, first = staged(now.filter("rests").unionByName(stepped), "mcd-step"), False
    best = now.groupBy("group").agg(F.min(F.struct("logdet", "start", "mean", "inverse")).alias("best"))
    best = best.select("group", "best.mean", "best.inverse")
    close = rows.join(small(best), "group").filter(_distance() <= chi2_quantile(REWEIGHT_CUT, _P))
    return staged(_estimates(close.groupBy("group").agg(*_moments()), REWEIGHT_CUT, {"group": "string"}), "mcd")


def _grouped(rows: DataFrame, lang_col: str, source_col: str, min_rows: int) -> tuple[DataFrame, bool]:
    """``rows`` with the ``group`` each is judged in, null where there are too few rows.

    And whether the groups are few enough to go to every task.
    """
    fine = F.to_json(F.struct(F.lit(2).alias("level"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")))
    coarse = F.to_json(F.struct(F.lit(1).alias("level"), F.col(lang_col).alias("lang")))
    rows = rows.withColumns({"_fine": fine, "_coarse": coarse})
    fines = rows.filter("n_words > 0").groupBy("_fine", "_coarse").agg(F.count(F.lit(1)).alias("_n"))
    totals = fines.groupBy("_coarse").agg(F.sum("_n").alias("_m"))
    everything, groups = fines.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    few = groups <= BROADCAST_GROUPS
    whole = F.lit('{"level":0}' if everything >= min_rows else None).cast("string")
    group = F.when(F.col("_n") >= min_rows, F.col("_fine")).when(F.col("_m") >= min_rows, F.col("_coarse")).otherwise(whole)
    sizes = fines.join(totals, "_coarse").select("_fine", group.alias("group"))
    sizes = F.broadcast(sizes) if few else sizes
    return rows.join(sizes, "_fine", "left").withColumn("_whole", whole), few


def _fitting(rows: DataFrame, few: bool) -> DataFrame:
    """``(group, v0..)``: the rows of every group in use, all of a language in its own."""
    used = rows.filter("group is not null").select("group").distinct()
    # As many as the groups at most, so counted: their rows need not meet in one task.
    used = F.broadcast(used) if few else used
    levels = F.explode(F.array("_fine", "_coarse", "_whole")).alias("group")
    return rows.filter("n_words > 0").select(levels, *VECTOR).join(used, "group", "left_semi")


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
    min_rows: int = MIN_ROWS,
    support: float = SUPPORT,
    cut: float = CUT,
) -> DataFrame:
    """Per row: id, ``keep``, the counts, ``base_failed``, ``distance`` squared and ``kept``.

    Kept columns may have any names; see ``common.shielded`` for those of results.
    """
    own = (id_col, lang_col, source_col, text_col)
    docs, keep, back = shielded(docs, keep, own, (*COUNTS, "base_failed", "distance", "kept"))
    columns = tuple(dict.fromkeys((id_col, lang_col, source_col, *keep)))
    rows = staged(with_statistics(docs, columns, text_col), "quality-statistics")
    rows, few = _grouped(rows, lang_col, source_col, min_rows)
    fitted = mcd(staged(_fitting(rows, few), "quality-vectors"), support, few)
    fitted = F.broadcast(fitted) if few else fitted
    judged = rows.join(fitted, "group", "left").withColumn("distance", F.when(F.col("n_words") > 0, _distance()))
    fits = F.coalesce(F.col("distance") <= chi2_quantile(cut, _P), F.lit(True))
    return back(judged.select(
        id_col, *[k for k in keep if k != id_col], *COUNTS, "base_failed", "distance",
        (~F.col("base_failed") & fits).alias("kept"),
    ))
