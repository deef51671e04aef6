"""SQL with the results that queries must have, for DuckDB over the test tables.

Each is a plain form of its result, by another way than the operator's: all windows of lines
by their content, all phrases by position, all pairs of documents by their shingles.
"""

from __future__ import annotations

from footfall.llm.license_scan import PHRASES, SEPARATORS, TEMPLATES

_LINE_DEDUP = """
WITH line AS (
  SELECT doc_id, i AS idx, l AS line, len(list_filter(string_split(l, ' '), lambda x: x <> '')) AS n
  FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE text IS NOT NULL
  )
),
upto AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY idx) AS words FROM line),
win AS (
  SELECT a.doc_id, a.idx AS s, min(b.idx) AS e FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.idx >= a.idx AND b.words - a.words + a.n >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.idx) AS s, b.idx AS e FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.idx >= a.idx AND b.words - a.words + a.n >= 50 GROUP BY ALL
),
content AS (
  SELECT win.doc_id, s, e, string_agg(line, chr(10) ORDER BY idx) AS c
  FROM win JOIN line ON win.doc_id = line.doc_id AND idx BETWEEN s AND e GROUP BY ALL
),
later AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY doc_id, s) AS copy FROM content QUALIFY copy > 1),
gone AS (
  SELECT DISTINCT line.doc_id, idx FROM later JOIN line ON later.doc_id = line.doc_id AND idx BETWEEN s AND e
)
SELECT
  documents.doc_id,
  CASE WHEN documents.text IS NOT NULL
    THEN coalesce(string_agg(line, chr(10) ORDER BY line.idx) FILTER (gone.idx IS NULL), '') END AS text,
  count(line.idx) AS n_lines,
  count(gone.idx) AS n_removed
FROM documents LEFT JOIN line USING (doc_id) LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.idx = line.idx
GROUP BY documents.doc_id, documents.text"""

_NEAR_DUPLICATES = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, w
  FROM (
    SELECT doc_id, regexp_replace(lower(unnest(p)), '[^\p{L}\p{N}]', '', 'g') AS w, unnest(range(len(p))) AS i
    FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\s+') AS p FROM documents)
  )
  WHERE w <> ''
),
long AS (SELECT doc_id, list(w ORDER BY pos) AS ws FROM word GROUP BY doc_id),
shingle AS (
  SELECT doc_id, unnest(list_transform(range(greatest(1, len(ws) - 4)), lambda i: array_to_string(ws[i + 1 : i + 5], ' '))) AS s
  FROM long
),
counted AS (SELECT doc_id, s, count(*) AS c FROM shingle GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS shared
  FROM counted a JOIN counted b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
edge AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 10 * shared >= 8 * (p.n + q.n - shared)
  UNION
  SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b
    ON coalesce(a.text, '') = coalesce(b.text, '') AND a.doc_id < b.doc_id
  WHERE a.doc_id NOT IN (SELECT doc_id FROM long) AND b.doc_id NOT IN (SELECT doc_id FROM long)
),
linked AS (SELECT x AS a, y AS b FROM edge UNION SELECT y, x FROM edge),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT b, root FROM reach JOIN linked ON a = doc_id
),
class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM class"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _license_scan() -> str:
    import re

    phrases = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates, widths = [], []
    for i, (label, text) in enumerate(TEMPLATES):
        words = [w for w in re.split(SEPARATORS, text.lower()) if w]
        widths.append(f"({i}, '{label}', {_list(sorted(set(words)))}, {len(words)})")
        templates.append(f"({_list(sorted(set(filter(None, re.split(SEPARATORS, text.lower())))))}, '{label}')")
    return f"""
WITH phrase AS (SELECT * FROM (VALUES {phrases}) AS t(p, label)),
template AS (SELECT * FROM (VALUES {", ".join(templates)}) AS t(ws, label)),
doc AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{SEPARATORS}'), lambda x: x <> '') AS w
  FROM (
    SELECT doc_id,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
  )
),
base AS (
  SELECT doc_id, label, pos
  FROM (SELECT doc_id, w, p, label, unnest(range(len(w) - len(p) + 1)) AS pos FROM doc, phrase WHERE len(w) >= len(p))
  WHERE w[pos + 1 : pos + len(p)] = p
),
line AS (
  SELECT doc_id, line, list_distinct(regexp_split_to_array(line, '{SEPARATORS}')) AS lw
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM doc)
),
held AS (SELECT doc_id, line, label, len(list_intersect(ws, lw)) AS n, len(ws) AS t FROM line, template),
best AS (
  SELECT doc_id, label, n / t AS share FROM held WHERE 5 * n >= 4 * t
  QUALIFY share = max(share) OVER (PARTITION BY doc_id, line)
),
named AS (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM best),
b AS (
  SELECT doc_id, count(*) AS n, min(pos) AS low, max(pos) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM base GROUP BY doc_id
),
m AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM named GROUP BY doc_id),
s AS (SELECT doc_id, max(share) AS share FROM best GROUP BY doc_id),
kind AS (
  SELECT k, label, width, len(ws) AS t, unnest(ws) AS word
  FROM (VALUES {", ".join(widths)}) AS t(k, label, ws, width)
),
run AS (
  SELECT doc_id, k, label, width, t, pos, count(DISTINCT word) OVER (
    PARTITION BY doc_id, k ORDER BY pos RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING
  ) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM doc) JOIN kind USING (word)
),
notice AS (
  SELECT doc_id, label, n / t AS share, pos AS low, pos + width - 1 AS high FROM run WHERE 5 * n >= 4 * t
  QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY n DESC, pos) = 1
),
wide AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share, min(low) AS low
  FROM notice AS a
  WHERE NOT EXISTS (
    SELECT 1 FROM notice AS b
    WHERE a.doc_id = b.doc_id AND b.share > a.share AND b.low <= a.high AND a.low <= b.high
  )
  GROUP BY doc_id
)
SELECT
  doc.doc_id,
  CAST(len(w) AS BIGINT) AS n_words,
  coalesce(b.n, 0) AS n_base,
  b.low AS first_word,
  b.high AS last_word,
  coalesce(b.labels, '') AS base_labels,
  coalesce(m.labels, '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(s.share, 0.0)::DOUBLE END AS score,
  coalesce(wide.labels, '') AS notice_labels,
  coalesce(wide.share, 0.0)::DOUBLE AS notice_score,
  wide.low AS first_notice
FROM doc LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN wide USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": _LINE_DEDUP, "op2_license_scan": _license_scan(), "op4_dart_minhash": _NEAR_DUPLICATES}
