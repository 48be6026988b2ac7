"""DuckDB statements that give the rows of the queries SQL can express."""

WORDS = r"""
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM (
  SELECT doc_id, list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents))"""

SUBSTRING = "WITH" + WORDS.format(text="coalesce(text, '')") + """,
windows AS (SELECT doc_id, k, word, string_agg(word, ' ') OVER w AS s, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
seen AS (SELECT *, n = 20 AND row_number() OVER (PARTITION BY s, n = 20 ORDER BY doc_id, k) > 1 AS again FROM windows),
gone AS (SELECT doc_id, k, word, max(again::INT) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS g FROM seen),
sums AS (SELECT doc_id, count(*) AS n_words, sum(g)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (g = 0) AS kept FROM gone GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN sums USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_DUPLICATES = "WITH RECURSIVE" + WORDS.format(text=_LOWER) + """,
windows AS (SELECT doc_id, k, string_agg(word, ' ') OVER w AS s, count(*) OVER w AS n, count(*) OVER (PARTITION BY doc_id) AS all_words FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
sets AS (SELECT DISTINCT doc_id, s FROM windows WHERE n = 5 OR all_words < 5 AND k = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 85 * (m.n + n.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.id),
component AS (SELECT id AS doc_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)"""
