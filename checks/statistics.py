"""Differential tests, contingency tables and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellframe.functions.params import parse_equality
from cellframe.operators import differential as de
from cellframe.operators import ranks, summaries
from cellframe.session import scratch_root
from cellframe.sources.dataset import write_ranked
from checks import sql as S
from checks import tables as t
from checks.expression import LOGNORM, lognorm, ulm
from checks.registry import query, r6

GROUPED = """
grp AS (SELECT cell_id, {key} AS grp FROM cells {where}),
sizes AS (SELECT grp, count(*)::DOUBLE AS n1 FROM grp GROUP BY 1),
allc AS (SELECT sum(n1) AS n FROM sizes),
yy AS (SELECT gene_id, grp, y FROM ln JOIN grp USING (cell_id)),
base AS (
  SELECT s.grp, ge.gene_id, n1, n - n1 AS n2, n FROM sizes s CROSS JOIN genes ge CROSS JOIN allc),
sums AS (SELECT gene_id, grp, count(*)::DOUBLE AS k, sum(y) AS s1, sum(y * y) AS s2 FROM yy GROUP BY 1, 2),
tot AS (SELECT gene_id, sum(k) AS k, sum(s1) AS s1, sum(s2) AS s2 FROM sums GROUP BY 1),
m AS (
  SELECT b.grp, b.gene_id, n1, n2, coalesce(s.k, 0) AS k1, coalesce(t.k, 0) AS k, coalesce(s.s1, 0) AS s1,
         coalesce(s.s2, 0) AS s2, coalesce(t.s1, 0) AS t1, coalesce(t.s2, 0) AS t2
  FROM base b LEFT JOIN sums s ON s.gene_id = b.gene_id AND s.grp = b.grp LEFT JOIN tot t ON t.gene_id = b.gene_id),
fc AS (SELECT *, log2((exp(s1 / n1) - 1 + 1e-9) / (exp((t1 - s1) / n2) - 1 + 1e-9)) AS logfc FROM m)"""

WILCOXON = """
rk AS (
  SELECT gene_id, grp, rank() OVER w + (count(*) OVER (PARTITION BY gene_id, y) - 1) / 2.0 AS r
  FROM yy WINDOW w AS (PARTITION BY gene_id ORDER BY y)),
rs AS (SELECT gene_id, grp, sum(r) AS r FROM rk GROUP BY 1, 2),
wx AS (
  SELECT f.grp, f.gene_id, logfc,
    (coalesce(r, 0) + k1 * (n1 + n2 - k) + (n1 - k1) * ((n1 + n2 - k) + 1) / 2 - n1 * (n1 + n2 + 1) / 2)
      / sqrt(n1 * n2 * (n1 + n2 + 1) / 12) AS score
  FROM fc f LEFT JOIN rs ON rs.gene_id = f.gene_id AND rs.grp = f.grp)"""

EVERYONE = GROUPED.format(key="cluster", where="")
TWO = GROUPED.format(key="status", where="WHERE status IN ('ASIA', 'EUROPE')")


@query("de_wilcoxon", S.with_(*LOGNORM, EVERYONE, WILCOXON) + """
SELECT grp AS "group", gene_id, round(score, 6) AS score, round(logfc, 6) AS logfc FROM wx""")
def de_wilcoxon(spark, sf):
    out = de.wilcoxon_scores(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), "cluster")
    return out.select("group", "gene_id", r6("score"), r6("logfc"))


@query("de_ttest", S.with_(*LOGNORM, EVERYONE) + """
, v AS (SELECT grp, gene_id, logfc, n1, n2, s1 / n1 - (t1 - s1) / n2 AS gap, (s2 - s1 * s1 / n1) / (n1 - 1) / n1 AS e1,
  ((t2 - s2) - (t1 - s1) * (t1 - s1) / n2) / (n2 - 1) / n2 AS e2 FROM fc)
SELECT grp AS "group", gene_id, round(gap / sqrt(e1 + e2), 6) AS score, round(logfc, 6) AS logfc,
  round((e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1)), 4) AS dof FROM v""")
def de_ttest(spark, sf):
    out = de.welch_scores(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), "cluster")
    return out.select("group", "gene_id", r6("score"), r6("logfc"), r6("dof", digits=4))


@query("de_two_groups", S.with_(*LOGNORM, TWO, WILCOXON) + """
SELECT grp AS "group", gene_id, round(score, 6) AS score, round(logfc, 6) AS logfc, 'ASIA' AS group1, 'EUROPE' AS group2
FROM wx WHERE grp = 'ASIA'""")
def de_two_groups(spark, sf):
    out = de.rank_genes(
        lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), "status", compare=["ASIA", "EUROPE"]
    )
    return out.select("group", "gene_id", r6("score"), r6("logfc"), "group1", "group2")


@query("de_with_pvalues")
def de_with_pvalues(spark, sf):
    """p-values have no portable SQL form; tests check them against closed forms."""
    return de.rank_genes(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), "cluster")


@query("de_logreg")
def de_logreg(spark, sf):
    return de.rank_genes(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), "status", method="logreg")


TOP = S.with_(*LOGNORM, EVERYONE, WILCOXON) + """, top AS (
  SELECT * FROM wx QUALIFY row_number() OVER (PARTITION BY grp ORDER BY round(score, 6) DESC, gene_id) <= 5)"""


def _rounded_ranking(spark, sf, expr=None):
    out = de.wilcoxon_scores(lognorm(spark, sf) if expr is None else expr, t.cells(spark, sf), t.genes(spark, sf), "cluster")
    return out.select("group", "gene_id", r6("score"), r6("logfc"))


@query("top_genes_per_group", TOP + """
SELECT grp AS "group", gene_id, round(score, 6) AS score, round(logfc, 6) AS logfc FROM top""")
def top_genes_per_group(spark, sf):
    return summaries.top_per_group(_rounded_ranking(spark, sf), "group", [F.desc("score"), F.asc("gene_id")], 5)


@query("top_genes_overall", S.with_(*LOGNORM, EVERYONE, WILCOXON) + """
SELECT grp AS "group", gene_id, round(score, 6) AS score, round(logfc, 6) AS logfc FROM wx
ORDER BY round(score, 6) DESC, gene_id, grp LIMIT 50""")
def top_genes_overall(spark, sf):
    return summaries.top_overall(_rounded_ranking(spark, sf), [F.desc("score"), F.asc("gene_id"), F.asc("group")], 50)


@query("de_result_export", TOP + """
SELECT grp AS "group", gene_id, round(score, 6) AS score, round(logfc, 6) AS logfc FROM top""")
def de_result_export(spark, sf):
    """Write the full and the top table as CSV and read the top table back."""
    root = f"{scratch_root(spark)}/cellframe-{spark.sparkContext.applicationId}/de"
    paths = write_ranked(_rounded_ranking(spark, sf), root, "cluster", n_top=5)
    schema = '`group` string, gene_id string, score double, logfc double'
    return spark.read.csv(paths["top"], header=True, schema=schema)


@query("top_de_dot_table", TOP + """
, hits AS (SELECT t.grp AS source, t.gene_id, s.grp, sum(y) AS s, count(y) AS k, any_value(s.n1) AS n1
  FROM top t CROSS JOIN sizes s LEFT JOIN yy ON yy.gene_id = t.gene_id AND yy.grp = s.grp GROUP BY ALL)
SELECT source, gene_id, grp AS "group", round(coalesce(s, 0) / n1, 6) AS mean_expression, round(k / n1, 6) AS fraction_expressing FROM hits""")
def top_de_dot_table(spark, sf):
    expr = lognorm(spark, sf)
    out = summaries.top_de_table(_rounded_ranking(spark, sf, expr), expr, t.cells(spark, sf), "cluster", 5)
    return out.select("source", "gene_id", "group", r6("mean_expression"), r6("fraction_expressing"))


@query("marker_dot_table", S.with_(*LOGNORM, S.NET, EVERYONE) + """
SELECT source, gene_id, grp AS "group", round(s1 / n1, 6) AS mean_expression, round(k1 / n1, 6) AS fraction_expressing
FROM m JOIN net ON gene_id = target""")
def marker_dot_table(spark, sf):
    out = summaries.dot_table(lognorm(spark, sf), t.cells(spark, sf), t.net(spark, sf), "cluster", genes=t.genes(spark, sf))
    return out.select("source", "gene_id", "group", r6("mean_expression"), r6("fraction_expressing"))


PAIR = """
tg AS (SELECT source, score, status = 'ASIA' AS one FROM scores JOIN cells USING (cell_id) WHERE status IN ('ASIA', 'EUROPE')),
mm AS (SELECT source, count(*) FILTER (one)::DOUBLE AS n1, count(*) FILTER (NOT one)::DOUBLE AS n2,
  count(score) FILTER (one) AS k1, count(score) FILTER (NOT one) AS k2,
  avg(score) FILTER (one) AS m1, avg(score) FILTER (NOT one) AS m2,
  var_samp(score) FILTER (one) AS v1, var_samp(score) FILTER (NOT one) AS v2 FROM tg GROUP BY 1),
tt AS (SELECT source, CASE WHEN k1 = n1 THEN m1 END AS m1, CASE WHEN k2 = n2 THEN m2 END AS m2,
  sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS e FROM mm)"""


@query("score_ttest", S.with_(*LOGNORM, S.NET, S.ULM, PAIR) + """
SELECT source AS feature, round(m1, 6) AS mean_group1, round(m2, 6) AS mean_group2, round(m1 - m2, 6) AS mean_difference,
  round((m1 - m2) / e, 6) AS t_statistic, 'ASIA' AS group1, 'EUROPE' AS group2 FROM tt""")
def score_ttest(spark, sf):
    out = de.score_ttest(ulm(spark, sf), t.cells(spark, sf), "status", ["ASIA", "EUROPE"])
    return out.select(
        "feature", r6("mean_group1"), r6("mean_group2"), r6("mean_difference"), r6("t_statistic"), "group1", "group2"
    )


@query("score_ttest_largest", S.with_(*LOGNORM, S.NET, S.ULM, PAIR) + """
SELECT source AS feature, round(m1 - m2, 6) AS mean_difference FROM tt ORDER BY abs(m1 - m2) DESC, feature LIMIT 4""")
def score_ttest_largest(spark, sf):
    out = de.score_ttest(ulm(spark, sf), t.cells(spark, sf), "status", ["ASIA", "EUROPE"])
    return de.by_absolute(out, "mean_difference", "feature").limit(4).select("feature", r6("mean_difference"))


@query("rank_sum_by_cluster", """
WITH e AS (SELECT extract(hour FROM ts)::VARCHAR AS cluster, event_type AS source, value AS s, user_id % 2 = 1 AS odd FROM events WHERE value IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY cluster, source ORDER BY s) + (count(*) OVER (PARTITION BY cluster, source, s) - 1) / 2.0 AS r FROM e),
a AS (SELECT cluster, source, count(*) FILTER (odd)::DOUBLE AS n1, count(*) FILTER (NOT odd)::DOUBLE AS n2, sum(r) FILTER (odd) AS r1,
  avg(s) FILTER (odd) AS m1, avg(s) FILTER (NOT odd) AS m2 FROM r GROUP BY 1, 2)
SELECT cluster, source, round((coalesce(r1, 0) - n1 * (n1 + n2 + 1) / 2) / nullif(sqrt(n1 * n2 * (n1 + n2 + 1) / 12), 0), 6) AS stat,
  round(m1 - m2, 6) AS delta_mean FROM a""")
def rank_sum_by_cluster(spark, sf):
    scores, cells = t.event_cells(spark, sf)
    out = de.conditions_by_cluster(scores, cells, "hour", "odd")
    return out.select("cluster", "source", r6("stat"), r6("delta_mean"))


@query("rank_sum_scores_by_cluster", S.with_(*LOGNORM, S.NET, S.ULM) + """
, e AS (SELECT cluster, source, score AS s, balance > 4500 AS odd FROM scores JOIN cells USING (cell_id) WHERE score IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY cluster, source ORDER BY s) + (count(*) OVER (PARTITION BY cluster, source, s) - 1) / 2.0 AS r FROM e),
a AS (SELECT cluster, source, count(*) FILTER (odd)::DOUBLE AS n1, count(*) FILTER (NOT odd)::DOUBLE AS n2, sum(r) FILTER (odd) AS r1,
  avg(s) FILTER (odd) AS m1, avg(s) FILTER (NOT odd) AS m2 FROM r GROUP BY 1, 2)
SELECT cluster, source, round((coalesce(r1, 0) - n1 * (n1 + n2 + 1) / 2) / nullif(sqrt(n1 * n2 * (n1 + n2 + 1) / 12), 0), 6) AS stat,
  round(m1 - m2, 6) AS delta_mean FROM a""")
def rank_sum_scores_by_cluster(spark, sf):
    cells = t.cells(spark, sf).withColumn("rich", F.col("balance") > 4500)
    out = de.conditions_by_cluster(ulm(spark, sf), cells, "cluster", "rich")
    return out.select("cluster", "source", r6("stat"), r6("delta_mean"))


@query("fdr_correction", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_discount * l_quantity / 5.5 + 0.001 AS p, l_returnflag AS f FROM lineitem),
raw AS (SELECT *, p * count(*) OVER (PARTITION BY f) / count(*) OVER (PARTITION BY f ORDER BY p) AS q FROM p),
adj AS (SELECT DISTINCT f, p, least(1.0, min(q) OVER (PARTITION BY f ORDER BY p DESC)) AS a FROM raw)
SELECT f, round(p, 6) AS p, round(a, 6) AS pval_adj, count(*) AS n FROM p JOIN adj USING (f, p) GROUP BY ALL""")
def fdr_correction(spark, sf):
    rows = t.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("f"), (F.col("l_discount") * F.col("l_quantity") / 5.5 + 0.001).alias("p")
    )
    return ranks.adjust(rows, "p", ["f"]).groupBy("f", r6("p"), r6("pval_adj")).agg(F.count("*").alias("n"))


@query("fdr_correction_overall", """
WITH p AS (SELECT c_custkey AS id, (c_acctbal + 1000) / 11000 AS p FROM customer),
raw AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY p) AS q FROM p)
SELECT id, round(least(1.0, min(q) OVER (ORDER BY p DESC)), 6) AS pval_adj FROM raw""")
def fdr_correction_overall(spark, sf):
    rows = t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), ((F.col("c_acctbal") + 1000) / 11000).alias("p")
    )
    return ranks.adjust(rows, "p").select("id", r6("pval_adj"))


@query("significance_filter", """
WITH p AS (SELECT p_partkey AS id, p_size / 5000.0 AS pval_adj, (p_retailprice - 950) / 10 AS delta_mean FROM part)
SELECT id, pval_adj::DOUBLE AS pval_adj, round(delta_mean, 6) AS delta_mean FROM p WHERE pval_adj < 0.01 AND abs(delta_mean) > 1.5""")
def significance_filter(spark, sf):
    rows = t.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") / 5000.0).alias("pval_adj"),
        ((F.col("p_retailprice") - 950) / 10).alias("delta_mean"),
    )
    return de.significant(rows).select("id", "pval_adj", r6("delta_mean"))


@query("contingency_table", S.with_(S.CELLS) + """
, o AS (SELECT sample, status, count(*)::DOUBLE AS n FROM cells GROUP BY 1, 2),
r AS (SELECT sample, sum(n) AS n FROM o GROUP BY 1), c AS (SELECT status, sum(n) AS n FROM o GROUP BY 1),
a AS (SELECT sum(n) AS n FROM o)
SELECT r.sample AS "row", c.status AS "column", coalesce(o.n, 0) AS observed, round(r.n * c.n / a.n, 6) AS expected,
  round(coalesce(o.n, 0) - r.n * c.n / a.n, 6) AS residual
FROM r CROSS JOIN c CROSS JOIN a LEFT JOIN o ON o.sample = r.sample AND o.status = c.status""")
def contingency_table(spark, sf):
    out = de.contingency(t.cells(spark, sf), "sample", "status")
    return out.select("row", "column", "observed", r6("expected"), r6("residual"))


@query("chi_square", """
WITH o AS (SELECT o_orderpriority AS r, o_orderstatus AS c, count(*)::DOUBLE AS n FROM orders GROUP BY 1, 2),
e AS (SELECT *, sum(n) OVER (PARTITION BY r) * sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS e FROM o)
SELECT round(sum((n - e) * (n - e) / e), 6) AS statistic, ((count(DISTINCT r) - 1) * (count(DISTINCT c) - 1))::DOUBLE AS dof FROM e""")
def chi_square(spark, sf):
    rows = t.table(spark, sf, "orders")
    return de.chi_square(rows, "o_orderpriority", "o_orderstatus").select(r6("statistic"), "dof")


@query("chi_square_yates", """
WITH x AS (SELECT c_acctbal > 4500 AS r, c_mktsegment = 'BUILDING' AS c FROM customer),
o AS (SELECT r, c, count(*)::DOUBLE AS n FROM x GROUP BY 1, 2),
e AS (SELECT *, sum(n) OVER (PARTITION BY r) * sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS e FROM o)
SELECT round(sum(pow(abs(n - e) - least(0.5, abs(n - e)), 2) / e), 6) AS statistic, 1.0::DOUBLE AS dof FROM e""")
def chi_square_yates(spark, sf):
    rows = t.table(spark, sf, "customer").select(
        (F.col("c_acctbal") > 4500).alias("r"), (F.col("c_mktsegment") == "BUILDING").alias("c")
    )
    return de.chi_square(rows, "r", "c").select(r6("statistic"), "dof")


@query("crosstab", S.with_(S.CELLS) + """
SELECT "row", "column", count(cell_id) AS n_cells
FROM (SELECT DISTINCT cluster AS "row" FROM cells) CROSS JOIN (SELECT DISTINCT sample AS "column" FROM cells)
  LEFT JOIN cells ON cluster = "row" AND sample = "column" GROUP BY 1, 2""")
def crosstab(spark, sf):
    return summaries.crosstab(t.cells(spark, sf), "cluster", "sample")


@query("crosstab_sparse", """
WITH c AS (SELECT c_custkey AS cell_id, c_nationkey::VARCHAR AS r, CASE WHEN c_acctbal < 0 THEN c_nationkey % 7 ELSE 9 END::VARCHAR AS k FROM customer)
SELECT "row", "column", count(cell_id) AS n_cells FROM (SELECT DISTINCT r AS "row" FROM c) CROSS JOIN (SELECT DISTINCT k AS "column" FROM c)
  LEFT JOIN c ON r = "row" AND k = "column" GROUP BY 1, 2""")
def crosstab_sparse(spark, sf):
    """Most pairs of the two attributes do not occur."""
    nation = F.col("c_nationkey")
    kind = F.when(F.col("c_acctbal") < 0, nation % 7).otherwise(9).cast("string")
    rows = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("cell_id"), nation.cast("string").alias("r"), kind.alias("k"))
    return summaries.crosstab(rows, "r", "k")


@query("noise_statistics", """
SELECT count(DISTINCT l) FILTER (l <> -1) AS n_clusters, count(*) FILTER (l = -1) AS n_noise,
  round(count(*) FILTER (l = -1) / count(*), 6) AS noise_fraction
FROM (SELECT CASE WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS l FROM customer)""")
def noise_statistics(spark, sf):
    rows = t.table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") < 0, -1).otherwise(F.col("c_nationkey")).alias("label")
    )
    return summaries.noise_statistics(rows).select("n_clusters", "n_noise", r6("noise_fraction"))


@query("keep_two_groups", S.with_(S.CELLS) + "SELECT cell_id, status FROM cells WHERE status IN ('ASIA', 'EUROPE')")
def keep_two_groups(spark, sf):
    assert parse_equality("status == ASIA") == ("status", "ASIA")
    cells = t.cells(spark, sf)
    return de.keep_groups(cells, "status", ["ASIA", "EUROPE"]).select("cell_id", "status")
