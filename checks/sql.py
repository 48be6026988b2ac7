"""SQL fragments shared by the oracles (DuckDB dialect)."""

EXPR = """
expr AS (
  SELECT o_custkey AS cell_id, p_name AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

EXPR_BY_PART = """
expr AS (
  SELECT o_custkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

CELLS = """
cells AS (
  SELECT c_custkey AS cell_id, c_mktsegment AS sample, CAST(c_nationkey AS VARCHAR) AS cluster, r_name AS status,
         c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

GENES = """
genes AS (SELECT DISTINCT p_name AS gene_id FROM part)"""

NET = """
net AS (SELECT split_part(gene_id, ' ', 1) AS source, gene_id AS target, 1.0::DOUBLE AS weight FROM genes)"""

WEIGHTED_NET = """
net AS (SELECT split_part(p_name, ' ', 1) AS source, p_name AS target, avg(p_size) AS weight FROM part GROUP BY p_name)"""

LOGNORM = """
totals AS (SELECT cell_id, sum(value) AS total FROM expr GROUP BY 1),
ln AS (
  SELECT e.cell_id, e.gene_id, e.value, e.value * (SELECT median(total) FROM totals WHERE total > 0) / t.total AS norm,
         ln(1 + e.value * (SELECT median(total) FROM totals WHERE total > 0) / t.total) AS y
  FROM expr e JOIN totals t USING (cell_id))"""

ULM = """
g AS (SELECT count(*)::DOUBLE AS g FROM genes),
src AS (SELECT source, sum(weight) AS sx, sum(weight * weight) AS sxx FROM net GROUP BY 1 HAVING count(*) >= 2),
cs AS (SELECT c.cell_id, sum(y) AS sy, sum(y * y) AS syy FROM cells c LEFT JOIN ln USING (cell_id) GROUP BY 1),
xy AS (SELECT cell_id, source, sum(y * weight) AS sxy FROM ln JOIN net ON gene_id = target GROUP BY 1, 2),
ulm0 AS (
  SELECT cs.cell_id, src.source, g.g,
         (coalesce(sxy, 0) - sx * sy / g) / sqrt((sxx - sx * sx / g) * nullif(syy - sy * sy / g, 0)) AS r
  FROM cs CROSS JOIN src CROSS JOIN g LEFT JOIN xy ON xy.cell_id = cs.cell_id AND xy.source = src.source),
scores AS (SELECT cell_id, source, r * sqrt((g - 2) / nullif((1 - r) * (1 + r), 0)) AS score FROM ulm0)"""

LABELS = """
tagged AS (SELECT * FROM scores JOIN cells USING (cell_id) WHERE score IS NOT NULL),
ins AS (SELECT cluster, source, count(*)::DOUBLE AS n, sum(score) AS s1, sum(score * score) AS s2 FROM tagged GROUP BY 1, 2),
wh AS (SELECT source, sum(n) AS n, sum(s1) AS s1, sum(s2) AS s2 FROM ins GROUP BY 1),
mom AS (
  SELECT i.cluster, i.source, i.n, i.s1 / i.n AS m, (w.s1 - i.s1) / (w.n - i.n) AS mr,
         (i.s2 - i.s1 * i.s1 / i.n) / (i.n - 1) AS v,
         ((w.s2 - i.s2) - (w.s1 - i.s1) * (w.s1 - i.s1) / (w.n - i.n)) / (w.n - i.n - 1) AS vr
  FROM ins i JOIN wh w USING (source)),
stats AS (SELECT cluster, source, m - mr AS difference, (m - mr) / nullif(sqrt(v / n + vr / n), 0) AS stat FROM mom),
best AS (
  SELECT cluster, source FROM stats WHERE stat > 0
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY stat DESC, source) = 1),
labels AS (
  SELECT c.cluster, coalesce(b.source, 'Unknown') AS label
  FROM (SELECT DISTINCT cluster FROM cells) c LEFT JOIN best b USING (cluster))"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
