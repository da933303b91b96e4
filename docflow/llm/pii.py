"""Personal data: fixed patterns as seeds, and contextual patterns learnt from them.

Seeds are e-mail addresses, IP addresses, card and phone numbers that fixed patterns
find (``base``). Around every *run*, words with a digit or an at sign in a row, stand
contexts: the two words before it, the word before and the word after, the two words
after. Contexts and runs form a graph over the whole corpus, scored in rounds:

* a context's precision for a kind is the weight of its runs of that kind over the
  number of its distinct runs, of which those still undecided, with the kind's shape
  and no seed, count half; with ``min_support`` weight and ``min_precision`` it is a
  pattern of that kind;
* a run no seed lies in, of a kind's shape, gets the noisy-or of the precisions of
  the patterns it stands in; at ``min_weight`` it is an identifier, and counts
  towards contexts in the next round. Rounds go on until one finds nothing new.

All of it is DataFrame work: regular expressions and array functions per text, then
aggregations over distinct (context, run) pairs, which combine before they move. The
texts are read once and not moved.

Positions are code points, ends exclusive. Base spans are those of the leftmost
non-overlapping matches of each kind; what fails its check is dropped, without a
second try. Defined cases: a null text is empty; a text without spans has empty
strings and zeros; rows with equal ids are rows of their own; an empty table gives no
rows; further columns are ignored. Runs and context words may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import text_of
from docflow.sources.scratch import staged

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 5.0
MIN_PRECISION = 0.9
MIN_WEIGHT = 0.9

# Each matches what the plain form of the pattern does, without its backtracking: a
# long run of letters or digits is read once. The card pattern takes whole runs of 12
# to 19 digits; the plain one takes whole runs of any length, most of which fail.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be worth trying.
_SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + "
    "if(i % 2 = 1, int(substr({d}, length({d}) - i + 1, 1)), "
    "2 * int(substr({d}, length({d}) - i + 1, 1)) - if(substr({d}, length({d}) - i + 1, 1) >= '5', 9, 0))) % 10 = 0"
)
_CHECKS = {
    "email": "true",
    "ip": "forall(split(x.text, '[.]'), p -> length(trim(leading '0' from p)) <= 3 "
    "and coalesce(try_cast(trim(leading '0' from p) as int), 0) <= 255)",
    "card": _LUHN.format(d="translate(x.text, ' -', '')"),
    "phone": "length(translate(x.text, '+ ().-', '')) between 9 and 15",
}
_W = r"[^\x20\x09-\x0D]"
_B = r"[\x20\x09-\x0D]"
_BLANKS = r"\u0020\u0009\u000A\u000B\u000C\u000D"
_RUN = rf"(?<!{_W}){_W}*[0-9@]{_W}*+(?:\x20{_W}*[0-9@]{_W}*+)*+"
_TRIMMED = ".,;:!?\"'*#|&%$"
# Shapes of identifiers that the fixed patterns may have missed.
_SHAPES = {
    "email": r"^[a-z0-9._%+-]{2,}@[a-z0-9.-]{2,}$",
    "ip": r"^[0-9]{1,3}(?:[.:-][0-9]{1,3}){3}$",
    "card": r"^[0-9](?:[ .-]?[0-9]){11,18}$",
    "phone": r"^[+(]?[0-9](?:[ ().-]{0,2}[0-9]){8,14}$",
}


def _positions(pieces: str, found: str) -> str:
    """Start, end and text of each match, from the texts between matches and the matches."""
    start = f"acc.at + length(x.{pieces})"
    span = f"named_struct('start', {start}, 'end', {start} + length(x.{found}), 'text', x.{found})"
    return (
        f"coalesce(aggregate(arrays_zip({pieces}, {found}), "
        "named_struct('at', 0, 'spans', cast(array() as array<struct<start: int, end: int, text: string>>)), "
        f"(acc, x) -> if(x.{found} is null, acc, named_struct('at', {start} + length(x.{found}), "
        f"'spans', array_append(acc.spans, {span}))), acc -> acc.spans), "
        "cast(array() as array<struct<start: int, end: int, text: string>>))"
    )


def _matched(df: DataFrame, name: str, pattern: str, sign: str) -> DataFrame:
    """``df`` with the matches of a pattern in ``_text`` as spans in column ``name``."""
    has = F.col("_text").rlike(sign)
    df = df.withColumns(
        {
            "_pieces": F.when(has, F.split("_text", pattern, -1)),
            "_found": F.when(has, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))),
        }
    )
    return df.withColumn(name, F.expr(_positions("_pieces", "_found")))


def with_base(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``base``: ``(start, kind, end)`` of every seed, by start, then kind."""
    df = docs.withColumn("_text", text)
    for number, kind in enumerate(KINDS):
        df = _matched(df, f"_{kind}", _PATTERNS[kind], _SIGNS[kind])
        kept = f"filter(_{kind}, x -> {_CHECKS[kind]})"
        span = f"x -> named_struct('start', x.start, 'kind', {number}, 'end', x.end)"
        df = df.withColumn(f"_{kind}", F.expr(f"transform({kept}, {span})"))
    return df.withColumn("base", F.array_sort(F.concat(*[f"_{k}" for k in KINDS]))).drop(
        *[f"_{k}" for k in KINDS], "_pieces", "_found"
    )


def with_runs(df: DataFrame) -> DataFrame:
    """``df`` with ``runs``: place, text, seed kind, shape and contexts of every run."""
    df = _matched(df, "_spans", _RUN, "[0-9@]")
    # The last two words before a run, the first two after it, whole: a piece between
    # runs with every kind of blank made the same, cut at blanks from its end or start.
    df = df.withColumn("_pieces", F.expr(f"transform(_pieces, p -> trim(lower(translate(p, '{_BLANKS}', '      '))))"))
    before, after = "_pieces[i]", "_pieces[i + 1]"
    l1 = f"substring_index({before}, ' ', -1)"
    l2 = f"substring_index(rtrim(left({before}, length({before}) - length({l1}))), ' ', -1)"
    r1 = f"substring_index({after}, ' ', 1)"
    r2 = f"substring_index(ltrim(substr({after}, length({r1}) + 1)), ' ', 1)"
    pairs = (f"concat_ws(' ', {l2}, {l1}, '_')", f"concat_ws(' ', {l1}, '_', {r1})", f"concat_ws(' ', '_', {r1}, {r2})")
    contexts = f"array({', '.join(f'xxhash64({p})' for p in pairs)})"
    trimmed = _TRIMMED.replace("'", "\\'")
    place = f"""transform(_spans, (x, i) -> named_struct(
        'start', x.start + length(x.text) - length(trim(leading '{trimmed}' from x.text)),
        'text', trim(both '{trimmed}' from x.text),
        'contexts', {contexts}))"""
    df = df.withColumn("_runs", F.expr(place))
    shape = "case " + " ".join(f"when lower(x.text) rlike '{p}' then {i}" for i, p in enumerate(_SHAPES.values())) + " end"
    run = f"""transform(filter(_runs, x -> length(x.text) > 0), x -> named_struct(
        'start', x.start, 'end', x.start + length(x.text), 'text', lower(x.text), 'shape', {shape},
        'seeds', array_distinct(transform(
            filter(base, b -> b.start < x.start + length(x.text) and b.end > x.start), b -> b.kind)),
        'contexts', x.contexts))"""
    return df.withColumn("runs", F.expr(run)).drop("_spans", "_runs", "_pieces", "_found")


def bootstrap(
    graph: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_precision: float = MIN_PRECISION,
    min_weight: float = MIN_WEIGHT,
) -> DataFrame:
    """``(text, kind, weight)`` of the runs found in the graph ``(context, text, kind, seed)``.

    ``kind`` is null for runs of no kind: those only lower a context's precision. What
    is found once stays found, as its weight only helps the contexts it stands in.
    """
    found: DataFrame | None = None
    before, now = -1, 0
    while now > before:
        if found is None:
            weighted = graph.withColumn("weight", F.when(F.col("seed"), 1.0).otherwise(0.0))
        else:
            known = found.select("text", F.col("kind").alias("_kind"), F.col("weight").alias("_weight"))
            match = (graph["text"] == known["text"]) & (graph["kind"] == known["_kind"])
            weight = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("_weight", F.lit(0.0)))
            weighted = graph.join(known, match, "left").select(graph["*"], weight.alias("weight"))
        sums = [F.sum(F.when(F.col("kind") == i, F.col("weight")).otherwise(0.0)) for i in range(len(KINDS))]
        open_ = [F.count_if((F.col("kind") == i) & (F.col("weight") == 0)) for i in range(len(KINDS))]
        of_kind = F.array(*[F.struct(s.alias("support"), o.alias("undecided")) for s, o in zip(sums, open_)])
        contexts = weighted.groupBy("context").agg(F.count(F.lit(1)).alias("n"), of_kind.alias("of_kind"))
        patterns = (
            contexts.select("context", "n", F.posexplode("of_kind").alias("kind", "_of"))
            .select("context", "n", "kind", "_of.support", "_of.undecided")
            .withColumn("precision", F.col("support") / (F.col("n") - F.col("undecided") / 2))
            .filter((F.col("support") >= min_support) & (F.col("precision") >= min_precision))
        )
        missed = F.sum(F.log(F.greatest(1 - F.col("precision"), F.lit(1e-9))))
        found = staged(
            graph.filter("not seed and kind is not null")
            .join(patterns, ["context", "kind"])
            .groupBy("text", "kind")
            .agg((1 - F.exp(missed)).alias("weight"))
            .filter(F.col("weight") >= min_weight),
            "pii-found",
        )
        before, now = now, found.count()
    return found


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning: float) -> DataFrame:
    """Per row: id, ``base`` and all ``spans`` as ``(start, kind, end)``, by start, then kind."""
    picked = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("_text"))
    read = with_runs(with_base(picked, F.col("_text"))).select("id", "base", "runs")
    rows = staged(read.withColumn("row", F.monotonically_increasing_id()), "pii-runs")
    runs = rows.filter(F.size("runs") > 0).select("row", F.explode("runs").alias("run")).select("row", "run.*")
    one_seed = F.size("seeds") == 1
    kind = F.when(one_seed, F.col("seeds")[0]).when(F.size("seeds") == 0, F.col("shape"))
    graph = staged(
        runs.select(F.explode("contexts").alias("context"), "text", kind.alias("kind"), one_seed.alias("seed")).distinct(),
        "pii-graph",
    )
    found = bootstrap(graph, **learning)
    added = (
        runs.filter((F.size("seeds") == 0) & F.col("shape").isNotNull())
        .join(found.select("text", F.col("kind").alias("shape")), ["text", "shape"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", F.col("shape").alias("kind"), "end")).alias("added"))
    )
    nothing = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    every = F.array_sort(F.concat("base", F.coalesce("added", nothing)))
    return rows.join(added, "row", "left").select(F.col("id").alias(id_col), "base", every.alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans per kind, the digest of their list, and the list of all spans."""
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        id_col, *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
