"""SQL of spelling variants, quality rules and ranked search, for DuckDB over the test tables.

Each is a plain form of its result: near words by all their one-letter deletions, n-grams and
terms as rows. CRC-32 is computed from its polynomial, byte by byte.
"""

from __future__ import annotations

from footfall.llm.quality import BUCKETS, LEAST_WORDS, MOST_REPEATED, STEP, UNIT, WINDOW
from footfall.llm.variants import EDITED, FACTOR, OCCURRENCES, SHORTEST

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  )) AS t
)"""


def _crc32(text: str) -> str:
    """The CRC-32 of the UTF-8 bytes of an expression, beside crc_table."""
    digits = f"hex({text})"
    bytes_ = f"list_transform(range(len({digits}) // 2), lambda j: ('0x' || {digits}[2 * j + 1 : 2 * j + 2])::BIGINT)"
    steps = f"list_reduce(list_concat([4294967295::BIGINT], {bytes_}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


def _variants() -> str:
    return rf"""
WITH RECURSIVE {_CRC_TABLE},
run AS (
  SELECT doc_id, {_LOWER.format('r')} AS r, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)
  WHERE length(r) >= {SHORTEST} GROUP BY ALL
),
hashed AS (SELECT r, c, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || r")} AS h FROM run, crc_table),
word AS (
  SELECT CASE WHEN h % {EDITED} = 0 THEN r[1 : h % length(r)] || r[h % length(r) + 2 :] ELSE r END AS w, sum(c)::BIGINT AS n
  FROM hashed GROUP BY w HAVING length(w) >= {SHORTEST} AND sum(c) >= {OCCURRENCES}
),
cut AS (SELECT w, i, w[1 : i] AS a, w[i + 2 :] AS b FROM (SELECT w, unnest(range(length(w))) AS i FROM word)),
pair AS (
  SELECT x.w AS w, y.w AS v FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.w <> y.w
  UNION
  SELECT cut.w, word.w FROM cut JOIN word ON word.w = cut.a || cut.b
  UNION
  SELECT word.w, cut.w FROM cut JOIN word ON word.w = cut.a || cut.b
),
near AS (
  SELECT pair.w, count(*) AS n_near, arg_min(v, (-n, v)) AS v, max(n) AS vn
  FROM pair JOIN word ON word.w = v GROUP BY pair.w
),
formed AS (
  SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN vn >= {FACTOR} * n THEN v END AS form,
    CASE WHEN vn >= {FACTOR} * n THEN vn END AS form_n
  FROM word LEFT JOIN near USING (w)
),
chain AS (
  SELECT w, w AS at FROM formed
  UNION ALL
  SELECT chain.w, form FROM chain JOIN formed ON formed.w = chain.at WHERE form IS NOT NULL
)
SELECT formed.w AS word, formed.form, chain.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chain ON chain.w = formed.w JOIN formed AS last ON last.w = chain.at AND last.form IS NULL"""


def _quality() -> str:
    space, token = r"[\x20\x09-\x0D]+", r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\x09-\x0D\x20]+"
    return rf"""
WITH {_CRC_TABLE},
doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{space}'), lambda x: x <> '') AS w,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{token}') AS tokens
  FROM documents
),
win AS (
  SELECT row, i, array_to_string(w[i + 1 : i + {WINDOW}], ' ') AS s
  FROM (SELECT row, w, unnest(range(len(w) - {WINDOW - 1})) AS i FROM doc)
),
again AS (
  SELECT row, count(DISTINCT p) AS n FROM (
    SELECT row, unnest(range(i, i + {WINDOW})) AS p FROM (SELECT *, count(*) OVER (PARTITION BY row, s) AS c FROM win) WHERE c > 1
  ) GROUP BY row
),
dup AS (
  SELECT row, count(*) - count(DISTINCT line) AS n FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM doc)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
),
base AS (
  SELECT doc.row, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
    len(w) < {LEAST_WORDS} OR 100 * coalesce(again.n, 0) > {MOST_REPEATED} * len(w) AS base_failed
  FROM doc LEFT JOIN dup USING (row) LEFT JOIN again USING (row)
),
gram AS (
  SELECT row, g, count(*) AS c FROM (
    SELECT row, unnest(tokens) AS g FROM doc
    UNION ALL
    SELECT row, unnest(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) FROM doc
  ) GROUP BY ALL
),
code AS (SELECT g, {_crc32("g")} % {BUCKETS} AS b FROM (SELECT DISTINCT g FROM gram), crc_table),
hashed AS (SELECT row, b, sum(c) AS c FROM gram JOIN code USING (g) GROUP BY ALL),
label AS (
  SELECT doc_id, max(quality) = 1 AS trusted, {_crc32("doc_id::VARCHAR")} % 2 = 0 AS teaches
  FROM labels, crc_table WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id, t
),
raw AS (SELECT b, sum(c) AS n FROM hashed GROUP BY b),
target AS (
  SELECT b, sum(c) AS n FROM hashed JOIN doc USING (row) JOIN label USING (doc_id) WHERE trusted AND teaches GROUP BY b
),
weight AS (
  SELECT b, floor({UNIT} * ln(
    ((coalesce(target.n, 0) + 1) * (SELECT {BUCKETS} + sum(n) FROM raw))::DOUBLE
    / ((raw.n + 1) * (SELECT {BUCKETS} + coalesce(sum(n), 0) FROM target))::DOUBLE
  ) + 0.5)::BIGINT AS v
  FROM raw LEFT JOIN target USING (b)
),
mean AS (SELECT row, floor(sum(c * v)::DOUBLE / sum(c)::DOUBLE)::BIGINT AS score FROM hashed JOIN weight USING (b) GROUP BY row),
scored AS (SELECT base.*, coalesce(score, 0) AS score FROM base LEFT JOIN mean USING (row)),
step AS (
  SELECT floor(score / {STEP})::BIGINT AS step, count(*) FILTER (trusted) AS good, count(*) FILTER (NOT trusted) AS bad
  FROM scored JOIN label USING (doc_id) WHERE NOT base_failed AND NOT teaches GROUP BY ALL
),
below AS (
  SELECT step, lag(step) OVER (ORDER BY step) AS prior, sum(good) OVER () AS good, sum(bad) OVER () AS bad,
    sum(good) OVER (ORDER BY step) - good AS good_below, sum(bad) OVER (ORDER BY step) - bad AS bad_below
  FROM step
),
cut AS (
  SELECT floor((prior + 1 + step) * {STEP} / 2) AS lowest FROM below WHERE bad_below * good > good_below * bad
  ORDER BY bad_below * good - good_below * bad DESC, step LIMIT 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND score >= coalesce((SELECT lowest FROM cut), score) AS kept, score
FROM scored"""


def _search() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{term}')"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS ts FROM documents),
item AS (SELECT row_number() OVER () AS item, item_id, {terms} AS ts FROM benchmark),
corpus AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM doc WHERE len(ts) > 0),
measure AS (SELECT row, doc_id, 75 + (25 * len(ts) * n_docs) // n_terms AS m FROM doc, corpus WHERE len(ts) > 0),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ts) AS term FROM doc) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, corpus GROUP BY term, n_docs
),
wanted AS (SELECT item, item_id, unnest(ts) AS term FROM item),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN held USING (term) JOIN weight USING (term) JOIN measure USING (row) GROUP BY item, row
)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20"""


def oracle_sql() -> dict[str, str]:
    return {"op11_spelling_variants": _variants(), "op12_quality_rules": _quality(), "op13_mask_search": _search()}
