"""DuckDB SQL of the queries that SQL can express, by plain definitions: all pairs, all runs."""

from __future__ import annotations

LINE_DEDUP = """
WITH all_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
full_lines AS (
  SELECT *, row_number() OVER own AS j, length(line) - length(replace(line, ' ', '')) + 1 AS w,
    sum(length(line) - length(replace(line, ' ', '')) + 1) OVER own AS c
  FROM all_lines WHERE trim(line) <> '' WINDOW own AS (PARTITION BY doc_id ORDER BY line_no)),
runs AS (
  SELECT a.doc_id, a.j AS first, min(b.j) AS last FROM full_lines a JOIN full_lines b
    ON a.doc_id = b.doc_id AND b.j >= a.j AND b.c - a.c + a.w >= 50 GROUP BY a.doc_id, a.j
  UNION
  SELECT b.doc_id, max(a.j), b.j FROM full_lines a JOIN full_lines b
    ON a.doc_id = b.doc_id AND b.j >= a.j AND b.c - a.c + a.w >= 50 GROUP BY b.doc_id, b.j),
contents AS (
  SELECT r.doc_id, r.first, r.last, string_agg(l.line, chr(10) ORDER BY l.j) AS content
  FROM runs r JOIN full_lines l ON l.doc_id = r.doc_id AND l.j BETWEEN r.first AND r.last GROUP BY r.doc_id, r.first, r.last),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS place FROM contents) c WHERE place > 1),
gone AS (
  SELECT DISTINCT l.doc_id, l.line_no FROM later r JOIN full_lines l ON l.doc_id = r.doc_id AND l.j BETWEEN r.first AND r.last),
kept AS (
  SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.line_no) AS text
  FROM all_lines a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.line_no = g.line_no WHERE g.doc_id IS NULL GROUP BY a.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN NULL ELSE length(coalesce(k.text, '')) END AS n_chars, coalesce(c.n, 0) AS lines_deleted
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN counts c ON d.doc_id = c.doc_id
"""

_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM both_ways UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
smallest AS (SELECT node, min(other) AS root FROM reach GROUP BY node)"""

EMBEDDING_JOIN = (
    """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),"""
    + _COMPONENTS
    + """,
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(s.root, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(s.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN smallest s ON e.vec_id = s.node
"""
)

JACCARD_JOIN = (
    """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [hash(array_to_string(w, ' '))]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: hash(w[i], w[i + 1], w[i + 2]))) END AS s FROM words),
sets AS (SELECT *, hash(list_sort(s)) AS h FROM shingled),
firsts AS (SELECT h, min(doc_id) AS doc_id FROM sets WHERE len(s) > 0 GROUP BY h),
tokens AS (SELECT f.doc_id, unnest(s.s) AS t, len(s.s) AS n FROM firsts f JOIN sets s ON s.doc_id = f.doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id < y.doc_id AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),"""
    + _COMPONENTS
    + """
SELECT s.doc_id, len(s.s) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE least(f.doc_id, coalesce(m.root, f.doc_id)) END AS component_id
FROM sets s LEFT JOIN firsts f ON s.h = f.h LEFT JOIN smallest m ON m.node = f.doc_id
"""
)
