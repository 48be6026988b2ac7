"""Sources, filters, QC, normalisation, variable genes, scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.functions.exprs import first_scalar
from cellframe.functions.params import parse_resolutions, resolution_column, resolution_of
from cellframe.operators import enrich, labels, normalize, qc, sampling, summaries
from cellframe.session import scratch_root, store
from cellframe.sources import manifest as mf
from cellframe.sources import markers as mk
from checks import sql as S
from checks import tables as t
from checks.registry import i64, query, r6

LOGNORM = (S.EXPR, S.CELLS, S.GENES, S.LOGNORM)


def lognorm(spark: SparkSession, sf: str) -> DataFrame:
    """Counts are stored first, as in a dataset: the normalisation reads them twice (median, then scaling)."""
    return normalize.normalize_and_log(store(t.expr(spark, sf)))


def ulm(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.ulm_scores(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), t.net(spark, sf))


@query("flagship_label_clusters", S.with_(*LOGNORM, S.NET, S.ULM, S.LABELS) + """
SELECT cluster, label, count(*) AS n_cells FROM cells JOIN labels USING (cluster) GROUP BY 1, 2""")
def flagship(spark, sf):
    """Normalise, score, label clusters and count cells per cluster and label."""
    cells = t.cells(spark, sf)
    assigned = labels.label_clusters(ulm(spark, sf), cells, ["cluster"])
    labelled = labels.attach_labels(cells, assigned, "cluster", "label")
    return labelled.groupBy("cluster", "label").agg(F.count("*").alias("n_cells"))


# -- sources ---------------------------------------------------------------------------------------

def csv_of(df: DataFrame, name: str) -> str:
    path = f"{scratch_root(df.sparkSession)}/cellframe-{df.sparkSession.sparkContext.applicationId}/{name}"
    df.write.mode("overwrite").csv(path, header=True)
    return path


@query("manifest_source", """
SELECT n_name AS sample, 'data/' || n_name AS path, r_name AS status FROM nation JOIN region ON n_regionkey = r_regionkey""")
def manifest_source(spark, sf):
    rows = t.table(spark, sf, "nation").join(t.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    made = rows.select(F.col("n_name").alias("sample"), F.concat(F.lit("data/"), "n_name").alias("path"), F.col("r_name").alias("status"))
    return mf.read_manifest(spark, csv_of(made, "manifest")).drop("ordinal")


@query("attach_metadata", S.with_(S.CELLS) + """
SELECT cell_id, sample, status, length(sample) AS name_length FROM cells""")
def attach_metadata(spark, sf):
    cells = t.cells(spark, sf).select("cell_id", "sample", "status")
    info = cells.select("sample").distinct().withColumn("path", F.lit("")).withColumn("name_length", F.length("sample"))
    return mf.attach_metadata(cells, info).select("cell_id", "sample", "status", i64("name_length"))


@query("sample_of_region", """
WITH m AS (SELECT r_name AS sample, row_number() OVER (ORDER BY r_regionkey DESC) AS ord FROM region
           UNION ALL SELECT substr(r_name, 3), 100 + r_regionkey FROM region),
reg AS (SELECT DISTINCT 'cells-' || c_mktsegment || '-' || r_name AS region FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION SELECT DISTINCT c_mktsegment FROM customer)
SELECT reg.region, coalesce(first(m.sample ORDER BY ord), reg.region) AS sample
FROM reg LEFT JOIN m ON ends_with(reg.region, m.sample) GROUP BY reg.region""")
def sample_of_region(spark, sf):
    region = t.table(spark, sf, "region")
    info = region.select(F.col("r_name").alias("sample"), (10 - F.col("r_regionkey")).alias("ordinal")).unionByName(
        region.select(F.substring("r_name", 3, 100).alias("sample"), (100 + F.col("r_regionkey")).alias("ordinal"))
    )
    cells = t.cells(spark, sf)
    regions = cells.select(F.concat_ws("-", F.lit("cells"), "sample", "status").alias("region")).unionByName(
        cells.select(F.col("sample").alias("region"))
    )
    return mf.sample_of_region(regions, info)


@query("concat_samples", """
SELECT c_mktsegment AS sample, count(*) AS n_cells, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS n_extra
FROM customer GROUP BY 1""")
def concat_samples(spark, sf):
    """One part per sample, one of them with an attribute that the others lack."""
    cells = t.cells(spark, sf)
    names = [r[0] for r in cells.select("sample").distinct().orderBy("sample").collect()]
    parts = [cells.where(F.col("sample") == n) for n in names]
    parts = [p.withColumn("extra", F.lit(1)) if n == "BUILDING" else p for n, p in zip(names, parts)]
    return mf.concat_samples(parts).groupBy("sample").agg(
        F.count("*").alias("n_cells"), F.coalesce(F.sum("extra"), F.lit(0)).alias("n_extra")
    )


@query("manifest_repoint", """
SELECT n_name AS sample, 'out/' || n_name AS path, n_regionkey::BIGINT AS site FROM nation
WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)""")
def manifest_repoint(spark, sf):
    info = t.table(spark, sf, "nation").select(
        F.col("n_name").alias("sample"), F.lit("raw").alias("path"), i64("n_regionkey", "site"), "n_nationkey"
    )
    made = t.table(spark, sf, "customer").where("c_acctbal > 9900").select("c_nationkey").distinct()
    produced = made.join(t.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("sample"), F.concat(F.lit("out/"), "n_name").alias("path")
    )
    return mf.repoint(info.drop("n_nationkey"), produced)


@query("marker_list_source", """
SELECT p_type AS cell_type, list_sort(list(p_name)) AS genes, len(list(p_name))::BIGINT AS n
FROM (SELECT DISTINCT p_type, p_name FROM part) GROUP BY 1""")
def marker_list_source(spark, sf):
    made = t.table(spark, sf, "part").select(F.col("p_name").alias("gene"), F.col("p_type").alias("cell_type")).distinct()
    out = mk.marker_map(mk.read_markers(spark, csv_of(made, "markers")))
    return out.select("cell_type", "genes", F.size("genes").cast("bigint").alias("n"))


@query("markers_to_net", """
SELECT p_type AS source, p_name AS target, 1.0::DOUBLE AS weight, count(*) AS n FROM part GROUP BY 1, 2""")
def markers_to_net(spark, sf):
    rows = t.table(spark, sf, "part").select(F.col("p_type").alias("cell_type"), F.col("p_name").alias("gene"))
    return mk.markers_to_net(rows).groupBy("source", "target", "weight").agg(F.count("*").alias("n"))


@query("curated_markers", """
SELECT DISTINCT p_type AS source, p_name AS target FROM part WHERE p_size % 2 = 0 AND p_size % 3 = 0 AND p_size / 50.0 > 0.5""")
def curated_markers(spark, sf):
    rows = t.table(spark, sf, "part").select(
        F.col("p_type").alias("cell_type"), F.col("p_name").alias("genesymbol"), (F.col("p_size") % 2 == 0).alias("human"),
        (F.col("p_size") % 3 == 0).alias("canonical_marker"), (F.col("p_size") / 50).alias("human_sensitivity"), "p_partkey",
    )
    return mk.curated_markers(rows, order=["p_partkey"])


@query("first_markers", """
SELECT p_brand AS cell_type, p_name AS gene, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2""")
def first_markers(spark, sf):
    rows = t.table(spark, sf, "part").select(F.col("p_brand").alias("cell_type"), F.col("p_name").alias("gene"), "p_partkey")
    return mk.first_markers(rows, ["cell_type", "gene"], ["p_partkey"])


@query("named_resources", """
SELECT 'hallmark' AS net_name, p_type AS source, p_name AS target, 1.0::DOUBLE AS weight FROM part GROUP BY ALL
UNION ALL SELECT 'progeny', p_brand, p_name, avg(p_size)::DOUBLE FROM part GROUP BY ALL""")
def named_resources(spark, sf):
    part = t.table(spark, sf, "part")
    root = f"{scratch_root(spark)}/cellframe-{spark.sparkContext.applicationId}"
    part.select(F.col("p_type").alias("source"), F.col("p_name").alias("target")).distinct().write.mode("overwrite").parquet(f"{root}/hallmark")
    part.groupBy(F.col("p_brand").alias("source"), F.col("p_name").alias("target")).agg(
        F.avg("p_size").alias("weight")
    ).write.mode("overwrite").parquet(f"{root}/progeny")
    catalog = {"hallmark": f"{root}/hallmark", "progeny": f"{root}/progeny"}
    return mk.read_resources(spark, catalog, ["Hallmark", "progeny"])


@query("saved_types", """
SELECT c_custkey AS cell_id, CAST(c_nationkey AS VARCHAR) AS region, CASE WHEN n > 0 THEN first_key ELSE '' END AS instance_id
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(min(o_orderkey) AS VARCHAR) AS first_key FROM orders GROUP BY 1)
ON c_custkey = o_custkey""")
def saved_types(spark, sf):
    """List cells collapse to their first element, empty lists to an empty string."""
    owned = t.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.array(F.min("o_orderkey").cast("string")).alias("keys")
    )
    rows = t.table(spark, sf, "customer").join(owned, F.col("c_custkey") == F.col("o_custkey"), "left")
    keys = F.coalesce("keys", F.array().cast("array<string>"))
    return rows.select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").cast("string").alias("region"), first_scalar(keys).alias("instance_id"))


# -- filters and flags ---------------------------------------------------------------------------

@query("equality_filter", S.with_(S.CELLS) + "SELECT cell_id, sample FROM cells WHERE status = 'EUROPE'")
def equality_filter(spark, sf):
    return qc.filter_by_equality(t.cells(spark, sf), "status == EUROPE").select("cell_id", "sample")


@query("filter_cells", S.with_(S.EXPR) + """
SELECT cell_id, gene_id, value FROM expr WHERE cell_id IN (SELECT cell_id FROM expr WHERE value > 0 GROUP BY 1 HAVING count(*) >= 30)""")
def filter_cells(spark, sf):
    return qc.filter_cells(t.expr(spark, sf), 30)


@query("filter_cells_then_genes", S.with_(S.EXPR_BY_PART) + """
, kept AS (SELECT * FROM expr WHERE cell_id IN (SELECT cell_id FROM expr WHERE value > 0 GROUP BY 1 HAVING count(*) >= 35))
SELECT cell_id, gene_id, value FROM kept
WHERE gene_id IN (SELECT gene_id FROM kept WHERE value > 0 GROUP BY 1 HAVING count(*) >= 20)""")
def filter_cells_then_genes(spark, sf):
    return qc.filter_cells_and_genes(t.expr_by_part(spark, sf), 35, 20)


@query("gene_flags", """
WITH g AS (
  SELECT DISTINCT prefix || upper(split_part(p_name, ' ', 2)) AS gene_id
  FROM part, (VALUES ('MT-'), ('RPS'), ('RPL'), ('HB'), ('HBP'), ('mt-'), ('')) v(prefix)
  UNION SELECT DISTINCT 'HB' FROM part)
SELECT gene_id, starts_with(gene_id, 'MT-') AS mt, starts_with(gene_id, 'RPS') OR starts_with(gene_id, 'RPL') AS ribo,
       regexp_matches(gene_id, '^HB[^(P)]') AS hb FROM g""")
def gene_flags(spark, sf):
    prefixes = F.array(*[F.lit(p) for p in ("MT-", "RPS", "RPL", "HB", "HBP", "mt-", "")])
    word = F.upper(F.substring_index("p_name", " ", -1))
    part = t.table(spark, sf, "part")
    names = part.select(F.explode(prefixes).alias("_p"), word.alias("_w")).select(F.concat("_p", "_w").alias("gene_id"))
    return qc.flag_genes(names.unionByName(part.select(F.lit("HB").alias("gene_id"))).distinct())


@query("unique_names", """
SELECT p_partkey, CASE WHEN k = 0 THEN p_name ELSE p_name || '-' || k END AS p_name
FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS k FROM part)""")
def unique_names(spark, sf):
    return qc.unique_names(t.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")


@query("suffix_flag", S.with_(S.CELLS) + "SELECT cell_id, ends_with(sample, 'Y') AS flag FROM cells")
def suffix_flag(spark, sf):
    return t.cells(spark, sf).select("cell_id", F.col("sample").endswith("Y").alias("flag"))


@query("resolution_columns", """
SELECT n_nationkey::BIGINT AS id, 'leiden_res' || replace(CAST((n_nationkey + 1) / 10.0 AS DOUBLE)::VARCHAR, '.', 'p') AS key,
       (n_nationkey + 1) / 10.0::DOUBLE AS resolution FROM nation""")
def resolution_columns(spark, sf):
    """Column names of the resolutions that a parameter string lists, and the resolutions read back from them."""
    listed = parse_resolutions(",".join(str((r[0] + 1) / 10) for r in t.table(spark, sf, "nation").select("n_nationkey").collect()))
    keys = [resolution_column(r) for r in listed]
    rows = [(k, resolution_of(k)) for k in keys]
    found = spark.createDataFrame(rows, "key string, resolution double")
    nation = t.table(spark, sf, "nation").select(i64("n_nationkey", "id"))
    return nation.join(found, F.col("id") == F.round(F.col("resolution") * 10).cast("bigint") - 1).select("id", "key", "resolution")


@query("marker_presence", S.with_(S.GENES, S.EXPR) + """
SELECT p_type AS source, p_name || CASE WHEN p_size > 40 THEN '?' ELSE '' END AS target FROM part
WHERE p_size <= 40 AND p_name IN (SELECT gene_id FROM expr) GROUP BY ALL""")
def marker_presence(spark, sf):
    target = F.concat("p_name", F.when(F.col("p_size") > 40, "?").otherwise(""))
    net = t.table(spark, sf, "part").select(F.col("p_type").alias("source"), target.alias("target")).distinct()
    return enrich.present_markers(net, t.expr(spark, sf).select("gene_id").distinct())


@query("missing_targets", """
SELECT DISTINCT p_name || CASE WHEN p_size > 40 THEN '?' ELSE '' END AS target FROM part WHERE p_size > 40""")
def missing_targets(spark, sf):
    target = F.concat("p_name", F.when(F.col("p_size") > 40, "?").otherwise(""))
    net = t.table(spark, sf, "part").select(F.col("p_type").alias("source"), target.alias("target"))
    return enrich.missing_targets(net, t.genes(spark, sf))


# -- QC ------------------------------------------------------------------------------------------

def classed(expr: DataFrame) -> DataFrame:
    """Give part names gene-class prefixes: blue -> MT-, red -> RPS, green -> HBA."""
    g = F.col("gene_id")
    return expr.withColumn("gene_id", F.when(g.startswith("blue"), F.concat(F.lit("MT-"), g)).when(
        g.startswith("red"), F.concat(F.lit("RPS"), g)).when(g.startswith("green"), F.concat(F.lit("HBA"), g)).otherwise(g))


@query("cell_qc", S.with_(S.EXPR, S.CELLS) + """
, s AS (SELECT c.cell_id, count(e.value) AS n, coalesce(sum(value), 0) AS total,
  coalesce(sum(value) FILTER (gene_id LIKE 'blue%'), 0) AS mt, coalesce(sum(value) FILTER (gene_id LIKE 'red%'), 0) AS ribo,
  coalesce(sum(value) FILTER (gene_id LIKE 'green%'), 0) AS hb FROM cells c LEFT JOIN expr e USING (cell_id) GROUP BY 1)
SELECT cell_id, n AS n_genes_by_counts, total AS total_counts, mt AS total_counts_mt, ribo AS total_counts_ribo, hb AS total_counts_hb,
  round(100 * mt / nullif(total, 0), 6) AS pct_counts_mt, round(100 * ribo / nullif(total, 0), 6) AS pct_counts_ribo,
  round(100 * hb / nullif(total, 0), 6) AS pct_counts_hb, round(ln(1 + n), 6) AS log1p_n_genes_by_counts,
  round(ln(1 + total), 6) AS log1p_total_counts, round(ln(1 + mt), 6) AS log1p_total_counts_mt,
  round(ln(1 + ribo), 6) AS log1p_total_counts_ribo, round(ln(1 + hb), 6) AS log1p_total_counts_hb FROM s""")
def cell_qc(spark, sf):
    out = qc.cell_qc(classed(t.expr(spark, sf)), t.cells(spark, sf))
    plain = ("cell_id", "n_genes_by_counts", "total_counts", "total_counts_mt", "total_counts_ribo", "total_counts_hb")
    return out.select(*plain, *[r6(c) for c in out.columns if c not in plain])


@query("gene_qc", S.with_(S.EXPR, S.GENES) + """
, n AS (SELECT count(*)::DOUBLE AS n FROM customer)
SELECT gene_id, count(value) AS n_cells_by_counts, coalesce(sum(value), 0) AS total_counts,
  round(coalesce(sum(value), 0) / (SELECT n FROM n), 6) AS mean_counts,
  round(100 * (1 - count(value) / (SELECT n FROM n)), 6) AS pct_dropout_by_counts,
  round(ln(1 + coalesce(sum(value), 0) / (SELECT n FROM n)), 6) AS log1p_mean_counts,
  round(ln(1 + coalesce(sum(value), 0)), 6) AS log1p_total_counts
FROM genes LEFT JOIN expr USING (gene_id) GROUP BY 1""")
def gene_qc(spark, sf):
    out = qc.gene_qc(t.expr(spark, sf), t.genes(spark, sf), t.cells(spark, sf).count())
    plain = ("gene_id", "n_cells_by_counts", "total_counts")
    return out.select(*plain, *[r6(c) for c in out.columns if c not in plain])


@query("top_gene_share", S.with_(S.EXPR_BY_PART) + """
, r AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY value DESC, gene_id) AS r FROM expr)
SELECT cell_id, round(100 * sum(value) FILTER (r <= 20) / sum(value), 6) AS pct_counts_in_top_20_genes,
  round(100 * sum(value) FILTER (r <= 50) / sum(value), 6) AS pct_counts_in_top_50_genes,
  round(100 * sum(value) FILTER (r <= 100) / sum(value), 6) AS pct_counts_in_top_100_genes FROM r GROUP BY 1""")
def top_gene_share(spark, sf):
    n_genes = t.table(spark, sf, "part").count()
    out = qc.top_gene_share(t.expr_by_part(spark, sf), qc.top_share_sizes(n_genes))
    return out.select("cell_id", *[r6(c) for c in out.columns if c != "cell_id"])


@query("qc_medians", S.with_(S.EXPR, S.CELLS) + """
, s AS (SELECT c.cell_id, count(e.value) AS n, coalesce(sum(value), 0) AS total,
  coalesce(sum(value) FILTER (gene_id LIKE 'blue%'), 0) AS mt FROM cells c LEFT JOIN expr e USING (cell_id) GROUP BY 1)
SELECT 'n_genes_by_counts' AS metric, round(median(n), 6) AS median FROM s
UNION ALL SELECT 'total_counts', round(median(total), 6) FROM s
UNION ALL SELECT 'pct_counts_mt', round(median(100 * mt / nullif(total, 0)), 6) FROM s""")
def qc_medians(spark, sf):
    out = qc.qc_medians(qc.cell_qc(classed(t.expr(spark, sf)), t.cells(spark, sf)))
    return out.select("metric", r6("median"))


@query("qc_distribution", S.with_(S.EXPR, S.CELLS) + """
, s AS (SELECT c.cell_id, count(e.value)::DOUBLE AS n, coalesce(sum(value), 0) AS total FROM cells c LEFT JOIN expr e USING (cell_id) GROUP BY 1),
m AS (SELECT 'n_genes_by_counts' AS metric, n AS v FROM s UNION ALL SELECT 'total_counts', total FROM s),
b AS (SELECT metric, min(v) AS low, (max(v) - min(v)) / 50 AS width FROM m GROUP BY 1)
SELECT metric, least(floor((v - low) / width), 49)::BIGINT AS bin, count(*) AS n_cells,
  round(any_value(low) + least(floor((v - low) / width), 49) * any_value(width), 6) AS bin_start,
  round(any_value(low) + (least(floor((v - low) / width), 49) + 1) * any_value(width), 6) AS bin_end
FROM m JOIN b USING (metric) GROUP BY metric, least(floor((v - low) / width), 49)""")
def qc_distribution(spark, sf):
    out = qc.qc_distribution(qc.cell_qc(t.expr(spark, sf), t.cells(spark, sf)), ["n_genes_by_counts", "total_counts"])
    return out.select("metric", i64("bin"), "n_cells", r6("bin_start"), r6("bin_end"))


@query("downsample_fraction", """
SELECT c_custkey AS cell_id, c_mktsegment AS sample FROM customer
QUALIFY row_number() OVER (ORDER BY md5('7-' || c_custkey), c_custkey) <= floor((SELECT count(*) FROM customer) * 0.3)""")
def downsample_fraction(spark, sf):
    return sampling.downsample_fraction(t.cells(spark, sf).select("cell_id", "sample"), 0.3, seed=7)


@query("downsample_per_sample", """
WITH o AS (SELECT o_orderkey AS cell_id, nullif(o_orderpriority, '2-HIGH') AS sample FROM orders)
SELECT cell_id, sample FROM o QUALIFY row_number() OVER (PARTITION BY sample ORDER BY md5('7-' || cell_id), cell_id) <= 500""")
def downsample_per_sample(spark, sf):
    """One of the samples has no name."""
    sample = F.nullif(F.col("o_orderpriority"), F.lit("2-HIGH")).alias("sample")
    rows = t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("cell_id"), sample)
    return sampling.downsample_per_sample(rows, 500, seed=7)


# -- normalisation and variable genes ---------------------------------------------------------

@query("normalize_and_log", S.with_(*LOGNORM) + """
SELECT cell_id, gene_id, value AS counts, round(norm, 6) AS norm, round(y, 6) AS lognorm FROM ln""")
def normalize_and_log(spark, sf):
    return lognorm(spark, sf).select("cell_id", "gene_id", "counts", r6("norm"), r6("lognorm"))


def _dispersion_sql(batch: bool) -> str:
    tag = "sample" if batch else "'all'"
    sums = (
        "SELECT batch, gene_id, sum(e) AS s1, sum(e * e) AS s2 FROM (SELECT gene_id, sample AS batch, exp(y) - 1 AS e FROM ln "
        "JOIN cells USING (cell_id)) GROUP BY 1, 2"
        if batch else
        "SELECT 'all' AS batch, g.gene_id, coalesce(sum(exp(y) - 1), 0) AS s1, coalesce(sum((exp(y) - 1) * (exp(y) - 1)), 0) AS s2 "
        "FROM pg g LEFT JOIN ln USING (gene_id) GROUP BY 1, 2"
    )
    return f""",
pg AS (SELECT p_partkey AS gene_id FROM part),
nb AS (SELECT {tag} AS batch, count(*)::DOUBLE AS n FROM cells GROUP BY 1),
sums AS ({sums}),
mv AS (SELECT batch, gene_id, s1 / n AS m, greatest((s2 - n * (s1 / n) * (s1 / n)) / (n - 1), 0) AS v FROM sums JOIN nb USING (batch)),
md AS (SELECT batch, gene_id, ln(1 + CASE WHEN m = 0 THEN 1e-12 ELSE m END) AS means,
  CASE WHEN v > 0 THEN ln(v / CASE WHEN m = 0 THEN 1e-12 ELSE m END) END AS d FROM mv),
rg AS (SELECT batch, min(means) AS lo, max(means) AS hi FROM md GROUP BY 1),
bn AS (SELECT md.*, least(greatest(ceil((means - lo) / ((hi - lo) / 20)), 1), 20)::BIGINT AS bin FROM md JOIN rg USING (batch)),
z AS (SELECT *, CASE WHEN d IS NOT NULL AND count(d) OVER w = 1 THEN 1.0
  ELSE (d - avg(d) OVER w) / nullif(stddev_samp(d) OVER w, 0) END AS z FROM bn WINDOW w AS (PARTITION BY batch, bin)),
hit AS (SELECT *, z IS NOT NULL AND row_number() OVER (PARTITION BY batch ORDER BY z DESC NULLS LAST, gene_id) <= 200 AS hit FROM z)"""


@query("variable_genes", S.with_(S.EXPR_BY_PART, S.CELLS, S.LOGNORM).rstrip() + _dispersion_sql(False) + """
SELECT gene_id, round(z, 6) AS dispersions_norm, hit AS highly_variable FROM hit""")
def variable_genes(spark, sf):
    expr = normalize.normalize_and_log(store(t.expr_by_part(spark, sf)))
    genes = t.table(spark, sf, "part").select(F.col("p_partkey").alias("gene_id"))
    out = normalize.variable_genes(expr, t.cells(spark, sf), genes, 200)
    return out.select("gene_id", r6("dispersions_norm"), "highly_variable")


@query("variable_genes_by_batch", S.with_(S.EXPR_BY_PART, S.CELLS, S.LOGNORM).rstrip() + _dispersion_sql(True) + """
, per AS (SELECT gene_id, sum(hit::BIGINT)::BIGINT AS nb, sum(z) / nullif((SELECT count(*) FROM nb) - count(*) FILTER (z IS NULL), 0) AS z
  FROM hit GROUP BY 1),
full_ AS (SELECT gene_id, coalesce(nb, 0) AS nb, z FROM pg LEFT JOIN per USING (gene_id))
SELECT gene_id, nb AS n_batches, round(z, 6) AS dispersions_norm,
  nb > 0 AND row_number() OVER (ORDER BY (nb > 0) DESC, nb DESC, z DESC NULLS LAST, gene_id) <= 200 AS highly_variable FROM full_""")
def variable_genes_by_batch(spark, sf):
    expr = normalize.normalize_and_log(store(t.expr_by_part(spark, sf)))
    genes = t.table(spark, sf, "part").select(F.col("p_partkey").alias("gene_id"))
    out = normalize.variable_genes(expr, t.cells(spark, sf), genes, 200, batch="sample")
    return out.select("gene_id", "n_batches", r6("dispersions_norm"), "highly_variable")


# -- scores and labels -------------------------------------------------------------------------

@query("ulm_scores", S.with_(*LOGNORM, S.NET, S.ULM) + "SELECT cell_id, source, round(score, 6) AS score FROM scores")
def ulm_scores(spark, sf):
    return ulm(spark, sf).select("cell_id", "source", r6("score"))


@query("ulm_several_resources", S.with_(*LOGNORM) + """,
net AS (SELECT 'first/' || split_part(gene_id, ' ', 1) AS source, gene_id AS target, 1.0::DOUBLE AS weight FROM genes
        UNION ALL SELECT 'last/' || split_part(gene_id, ' ', 2), gene_id, 1.0 FROM genes),""" + S.ULM + """
SELECT cell_id, split_part(source, '/', 1) AS net_name, split_part(source, '/', 2) AS source, round(score, 6) AS score FROM scores""")
def ulm_several_resources(spark, sf):
    out = enrich.ulm_scores(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), t.two_nets(spark, sf))
    return out.select("cell_id", "net_name", "source", r6("score"))


MLM = """
g AS (SELECT count(*)::DOUBLE AS g FROM genes),
src AS (SELECT source, sum(weight) AS b, sum(weight * weight) AS d FROM net GROUP BY 1 HAVING count(*) >= 2),
k AS (SELECT g, g - sum(b * b / d) AS s, g - count(*) - 1 AS dof FROM src, g GROUP BY g),
cs AS (SELECT c.cell_id, coalesce(sum(y), 0) AS sy, coalesce(sum(y * y), 0) AS syy FROM cells c LEFT JOIN ln USING (cell_id) GROUP BY 1),
xy AS (SELECT cell_id, source, sum(y * weight) AS v FROM ln JOIN net ON gene_id = target GROUP BY 1, 2),
full_ AS (SELECT cs.cell_id, sy, syy, src.source, b, d, coalesce(v, 0) AS v FROM cs CROSS JOIN src LEFT JOIN xy ON xy.cell_id = cs.cell_id AND xy.source = src.source),
b0 AS (SELECT cell_id, any_value(sy) AS sy, any_value(syy) AS syy, (any_value(sy) - sum(b * v / d)) / (SELECT s FROM k) AS b0 FROM full_ GROUP BY 1),
beta AS (SELECT f.cell_id, f.source, b, d, v, (v - b * b0) / d AS beta FROM full_ f JOIN b0 USING (cell_id)),
rss AS (SELECT b0.cell_id, greatest(any_value(syy) - any_value(b0 * sy) - sum(beta * v), 0) AS rss FROM beta JOIN b0 USING (cell_id) GROUP BY 1),
scores AS (SELECT cell_id, source, beta / nullif(sqrt((1 / d + b * b / (d * d * (SELECT s FROM k))) * rss / (SELECT dof FROM k)), 0) AS score FROM beta JOIN rss USING (cell_id))"""


def mlm(spark, sf):
    return enrich.mlm_scores(lognorm(spark, sf), t.cells(spark, sf), t.genes(spark, sf), t.weighted_net(spark, sf))


@query("mlm_scores", S.with_(*LOGNORM, S.WEIGHTED_NET, MLM) + "SELECT cell_id, source, round(score, 6) AS score FROM scores")
def mlm_scores(spark, sf):
    return mlm(spark, sf).select("cell_id", "source", r6("score"))


@query("masked_scores", S.with_(*LOGNORM, S.NET, S.ULM) + """
SELECT cell_id, source, CASE WHEN status = 'ASIA' THEN round(score, 6) END AS score FROM scores JOIN cells USING (cell_id)""")
def masked_scores(spark, sf):
    cells = t.cells(spark, sf)
    mask = qc.filter_by_equality(cells, "status==ASIA")
    out = enrich.enrichment_scores(lognorm(spark, sf), cells, t.genes(spark, sf), t.net(spark, sf), "ulm", mask=mask)
    return out.select("cell_id", "source", r6("score"))


@query("minimum_targets", S.with_(S.GENES, S.NET) + """
SELECT source, target FROM net WHERE source IN (SELECT source FROM net GROUP BY 1 HAVING count(*) >= 8)""")
def minimum_targets(spark, sf):
    return enrich.usable_net(t.net(spark, sf), t.genes(spark, sf), 8).select("source", "target")


@query("rank_sources", S.with_(*LOGNORM, S.NET, S.ULM, S.LABELS) + """
SELECT cluster, source, round(difference, 6) AS difference, round(stat, 6) AS stat FROM stats""")
def rank_sources(spark, sf):
    clusters = labels.cluster_columns(t.cells(spark, sf), ["cluster"])
    return labels.rank_sources(ulm(spark, sf), clusters).select("cluster", "source", r6("difference"), r6("stat"))


@query("label_many_clusterings", S.with_(*LOGNORM, S.NET, S.ULM, S.LABELS) + """,
b2 AS (SELECT sample, source, count(*)::DOUBLE AS n, sum(score) AS s1, sum(score * score) AS s2 FROM tagged GROUP BY 1, 2),
st2 AS (SELECT i.sample, i.source, i.s1 / i.n - (w.s1 - i.s1) / (w.n - i.n) AS gap,
  sqrt((i.s2 - i.s1 * i.s1 / i.n) / (i.n - 1) / i.n + ((w.s2 - i.s2) - (w.s1 - i.s1) * (w.s1 - i.s1) / (w.n - i.n)) / (w.n - i.n - 1) / i.n) AS err
  FROM b2 i JOIN wh w USING (source)),
best2 AS (SELECT sample, source FROM st2 WHERE gap / err > 0 QUALIFY row_number() OVER (PARTITION BY sample ORDER BY gap / err DESC, source) = 1)
SELECT 'cluster' AS cluster_key, cluster, label FROM labels
UNION ALL SELECT 'sample', c.sample, coalesce(b.source, 'Unknown') FROM (SELECT DISTINCT sample FROM cells) c LEFT JOIN best2 b USING (sample)""")
def label_many(spark, sf):
    return labels.label_clusters(ulm(spark, sf), t.cells(spark, sf), ["cluster", "sample"])


@query("annotate_with_markers", S.with_(*LOGNORM, S.WEIGHTED_NET, MLM, S.LABELS) + """
SELECT cell_id, cluster, label AS cell_type FROM cells JOIN labels USING (cluster)""")
def annotate_with_markers(spark, sf):
    cells = t.cells(spark, sf)
    assigned = labels.label_clusters(mlm(spark, sf), cells, ["cluster"])
    return labels.attach_labels(cells, assigned, "cluster", "cell_type").select("cell_id", "cluster", "cell_type")


@query("label_sizes", S.with_(*LOGNORM, S.NET, S.ULM, S.LABELS) + """
SELECT label, count(*) AS n_cells FROM cells JOIN labels USING (cluster) GROUP BY 1""")
def label_sizes(spark, sf):
    cells = t.cells(spark, sf)
    assigned = labels.label_clusters(ulm(spark, sf), cells, ["cluster"])
    return labels.label_sizes(labels.attach_labels(cells, assigned, "cluster", "label"), "label")


@query("mean_scores", S.with_(*LOGNORM, S.NET, S.ULM) + """
SELECT cluster AS "group", source, round(avg(score), 6) AS mean_score FROM scores JOIN cells USING (cell_id) GROUP BY 1, 2
HAVING count(*) > 0""")
def mean_scores(spark, sf):
    return summaries.mean_scores(ulm(spark, sf), t.cells(spark, sf), "cluster").select("group", "source", r6("mean_score"))


@query("mean_scores_wide", S.with_(*LOGNORM, S.NET, S.ULM) + """
SELECT cluster AS "group", round(avg(score) FILTER (source = 'blue'), 6) AS blue, round(avg(score) FILTER (source = 'red'), 6) AS red
FROM scores JOIN cells USING (cell_id) GROUP BY 1""")
def mean_scores_wide(spark, sf):
    means = summaries.mean_scores(ulm(spark, sf), t.cells(spark, sf), "cluster")
    return summaries.widen(means, ["blue", "red"]).select("group", r6("blue"), r6("red"))
