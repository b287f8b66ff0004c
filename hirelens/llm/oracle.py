"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH lines AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
), seen AS (
  SELECT DISTINCT doc_id, source, trim(l, ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT doc_id, source, unnest(ls) AS l FROM lines)
), pages AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
common AS (
  SELECT s.source, s.line
  FROM seen s JOIN pages p ON s.source IS NOT DISTINCT FROM p.source
  WHERE s.line <> ''
  GROUP BY s.source, s.line, p.total
  HAVING count(*) >= 5 AND count(*) > 0.05 * p.total
), listed AS (SELECT source, list(line) AS bad FROM common GROUP BY source)
SELECT l.doc_id, l.source,
  CASE WHEN l.text IS NULL THEN NULL
       ELSE array_to_string(list_filter(l.ls, lambda x: NOT list_contains(coalesce(b.bad, []), trim(x, ' ' || chr(9) || chr(13)))), chr(10)) END AS text,
  CAST(coalesce(len(l.ls), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(list_filter(l.ls, lambda x: list_contains(coalesce(b.bad, []), trim(x, ' ' || chr(9) || chr(13))))), 0) AS BIGINT) AS n_dropped
FROM lines l LEFT JOIN listed b ON l.source IS NOT DISTINCT FROM b.source
"""


OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 5
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), hard AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS r
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
  WHERE 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE r <= 3
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), said AS (
  SELECT k, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d)
), words AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM said GROUP BY lang, term HAVING count(DISTINCT k) >= 10
), used AS (
  SELECT s.lang, s.source, s.term, CAST(count(*) AS HUGEINT) AS c FROM said s JOIN words USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM words GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce((SELECT sum(c) FROM used u WHERE u.lang = g.lang AND u.source = g.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g
), weights AS (
  SELECT g.lang, g.source, w.term, coalesce(u.c, 0) AS c,
         1 + (1000000000 * (coalesce(u.c, 0) + 2)) // CAST(g.n + 2 * l.v AS HUGEINT) AS p,
         1 + (1000000000 * (w.c + 2)) // CAST(l.n + 2 * l.v AS HUGEINT) AS q
  FROM groups g JOIN langs l USING (lang) JOIN words w USING (lang) LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = w.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM weights WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 10
"""


def oracle_queries() -> dict[str, str]:
    return {"op1_site_line_dedup": OP1, "op10_va_top_k": OP10, "op11_hilbert_negatives": OP11, "op13_source_divergence": OP13}
