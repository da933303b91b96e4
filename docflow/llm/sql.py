"""The SQL of those registered queries that SQL can express, for DuckDB."""

from __future__ import annotations

import re

from docflow.llm import centroids, chat, decontaminate, queries, spelling


def crc32(text: str) -> str:
    """CRC-32 of a string expression's UTF-8, byte by byte over the table of its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    code = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    step = f"xor(crc >> 8, ({table}::BIGINT[])[(xor(crc, byte) & 255) + 1])"
    whole = 0xFFFFFFFF
    return f"""xor({whole}::BIGINT, list_reduce(list_prepend({whole}::BIGINT,
      list_transform(range(strlen({text})), lambda i: {code})), lambda crc, byte: {step}))"""


def centroid_clustering() -> str:
    """Every round's assignment and means written out."""
    dims, k = centroids.DIMS, centroids.CENTROIDS
    dot = "list_inner_product({}::DOUBLE[], {}::DOUBLE[])"
    parts = [
        f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1
    AS c, v FROM kept QUALIFY c < {k}
)"""
    ]
    for turn in range(centroids.ROUNDS + 1):
        parts.append(
            f"""a{turn} AS (
  SELECT r, vec_id, kept.v AS v, c, CAST({dot.format('kept.v', 'kept.v')} - 2 * {dot.format('kept.v', 'm.v')}
    + {dot.format('m.v', 'm.v')} AS BIGINT) AS d
  FROM kept CROSS JOIN c{turn} m QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)"""
        )
        if turn < centroids.ROUNDS:
            parts.append(
                f"""m{turn} AS (
  SELECT c, list(x ORDER BY i) AS v FROM (
    SELECT c, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x
    FROM a{turn} CROSS JOIN range(1, {dims + 1}) t(i) GROUP BY c, i) GROUP BY c
),
c{turn + 1} AS (SELECT o.c, coalesce(n.v, o.v) AS v FROM c{turn} o LEFT JOIN m{turn} n USING (c))"""
            )
    last = centroids.ROUNDS
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(a.c AS INT) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} m ON a.c = m.c"""


def spelling_variants() -> str:
    """Near words by equality of what is left without one letter, and forms followed step by step."""
    least = spelling.LEAST_LETTERS
    return f"""WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
    '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM documents
),
hashed AS (
  SELECT run, times, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named FROM
    (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= {least} GROUP BY ALL)
),
slipped AS (SELECT run, times, {crc32('named')} AS h FROM hashed),
words AS (
  SELECT CASE WHEN h % {spelling.SLIP} = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(times) AS BIGINT) AS n
  FROM slipped GROUP BY 1 HAVING length(word) >= {least} AND n >= {spelling.LEAST_COUNT}
),
shorter AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
),
one_way AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
),
near AS (SELECT word, other FROM one_way UNION SELECT other, word FROM one_way),
ranked AS (
  SELECT near.word, o.word AS other, o.n AS other_n, w.n AS n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words w ON near.word = w.word JOIN words o ON near.other = o.word
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, o.word) = 1
),
forms AS (SELECT word, other AS form, other_n AS form_n FROM ranked WHERE other_n >= {spelling.RATIO} * n),
way(word, last) AS (
  SELECT word, word FROM words UNION ALL SELECT way.word, form FROM way JOIN forms ON way.last = forms.word
)
SELECT words.word, form, way.last AS root, n, coalesce((SELECT n_near FROM ranked r WHERE r.word = words.word), 0) AS n_near,
  form_n
FROM words LEFT JOIN forms USING (word) JOIN way ON way.word = words.word
  AND way.last NOT IN (SELECT word FROM forms)"""


def chat_formatting() -> str:
    """The digests from the turns themselves; the length from what escaping adds."""
    control = "|".join(re.escape(c) for c in chat.CONTROL)
    escaped = f"regexp_replace(replace({{}}, '\\', '\\\\'), '({control})', '_\\1', 'g')"
    frame = len(chat.TURN_START) + len("\n") + len(chat.TURN_END)
    ordered = "ORDER BY turn NULLS FIRST, role, text"
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {queries.CONTROL_CONVERSATION}, i, r, '{queries.CONTROL_TEXT}'
  FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {ordered})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {ordered}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({frame} + length(replace({escaped.format('role')}, chr(10), '__')) + length({escaped.format('text')}))
    AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def benchmark_decontamination() -> str:
    """All windows of all items looked up at every place of every document."""
    window = decontaminate.WINDOW
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), "
        f"'{spelling.UPPER}', '{spelling.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    grams = "array_to_string(words[i:i + n - 1], ' ') AS gram"
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
items AS (
  SELECT item, words, least(len(words), {window}) AS n FROM
    (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS words FROM benchmark) WHERE len(words) > 0
),
wanted AS (
  SELECT DISTINCT item, n, {grams} FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM items)
),
here AS (
  SELECT r, i, n, {grams} FROM (
    SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT n FROM items))
),
met AS (SELECT r, i, n, item FROM here JOIN wanted USING (n, gram)),
places AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM met) GROUP BY r),
owners AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM met) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN places USING (r) LEFT JOIN owners USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_formatting": chat_formatting(),
        "op10_benchmark_decontamination": benchmark_decontamination(),
        "op12_centroid_clustering": centroid_clustering(),
        "op13_spelling_variants": spelling_variants(),
    }
