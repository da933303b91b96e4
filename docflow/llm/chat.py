"""Conversations formatted by a template, with a mask of what a model learns from.

The template is parsed, folded and compiled to closures once per task (see
``template``). Rows are brought together by conversation and sorted by turn inside
Spark's shuffle; a task reads them as a stream and holds one conversation at a time,
which is one row of the result.

Control strings inside roles and texts are escaped, so that only the template can
start or end a turn: backslashes are doubled, a single backslash goes after the
first character of a control string, and a role's line feeds are written ``\\n``.
``unescape`` undoes all three.

Defined cases: a null text or role is empty; turns with equal numbers are ordered by
role, then text; a null turn comes first; rows without a conversation id form one
conversation; equal rows are turns of their own; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import small_batches, tasks
from docflow.llm.template import compile_template

# The control strings of common chat formats.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
TEMPLATE = (
    "{% for turn in turns %}<|im_start|>{{ turn.role | escape_line }}\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


FILTERS = {"escape": escape, "escape_line": escape_line}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN_START)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape(role), unescape(text[: -len(TURN_END)])))
    return turns


def learnt(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def format_conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: str = TEMPLATE,
) -> DataFrame:
    """Per conversation: id, ``formatted`` and the ``loss_spans`` ``[start, end)``."""
    small_batches(turns.sparkSession, 2000)
    compile_template(template, FILTERS)  # a faulty template fails here, not in a task
    kind = turns.schema[id_col].dataType.simpleString()
    ordered = (
        turns.select(
            F.col(id_col).alias("id"),
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
        .repartition(tasks(turns.sparkSession), "id")
        .sortWithinPartitions("id", "turn", "role", "text")
        .select("id", "role", "text")
    )

    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)
        held: list[dict] = []
        current: object = None

        def done() -> tuple:
            text, spans = render({"turns": held})
            return (current, text, [{"start": a, "end": b} for a, b in spans])

        def rows(out: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            ids, texts, spans = zip(*out)
            columns = [pa.array(ids, key_type), pa.array(texts, pa.string()), pa.array(spans, spans_type)]
            return pa.RecordBatch.from_arrays(columns, names=["id", "formatted", "loss_spans"])

        key_type = pa.int64()
        for batch in batches:
            out = []
            key_type = batch.schema.field(0).type
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and key != current:
                    out.append(done())
                    held = []
                current = key
                held.append({"role": role, "text": text})
            if out:
                yield rows(out, key_type)
        if held:
            yield rows([done()], key_type)

    found = ordered.mapInArrow(run, f"id {kind}, formatted string, loss_spans array<struct<start: long, end: long>>")
    return found.withColumnRenamed("id", id_col)
