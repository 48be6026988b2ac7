"""Depth scaling, log transform and variable genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normalize_and_log(expr: DataFrame) -> DataFrame:
    """Scale each cell to the median of positive cell totals, then ``log1p``.

    Adds ``counts`` (a copy of ``value``), ``norm`` and ``lognorm``. The median is a scalar subquery over
    distinct totals with their frequency, so its state is bounded by the number of distinct totals.
    """
    totals = expr.groupBy("cell_id").agg(F.sum("value").alias("_total"))
    spread = totals.where(F.col("_total") > 0).groupBy("_total").agg(F.count("*").alias("_n"))
    target = spread.agg(F.percentile("_total", F.lit(0.5), F.col("_n"))).scalar()
    scaled = F.when(F.col("_total") > 0, F.col("value") * target / F.col("_total")).otherwise(F.col("value"))
    return (
        expr.join(totals, "cell_id")
        .withColumn("counts", F.col("value"))
        .withColumn("norm", scaled)
        .withColumn("lognorm", F.log1p("norm"))
        .drop("_total")
    )


def gene_dispersion(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, batch: str | None = None, n_bins: int = 20
) -> DataFrame:
    """Normalised dispersion of each gene (per batch): ln(var/mean), standardised within mean bins.

    Moments include implicit zeros: sums over non-zeros divided by the number of cells of the batch.
    All windows run over the gene table, never over cells.
    """
    tagged = cells.select("cell_id", (F.col(batch) if batch else F.lit("all")).alias("batch"))
    lin = F.expm1("lognorm")
    source = expr.join(tagged, "cell_id") if batch else expr.withColumn("batch", F.lit("all"))
    sums = source.groupBy("batch", "gene_id").agg(F.sum(lin).alias("_s1"), F.sum(lin * lin).alias("_s2"))
    if not batch:
        sums = genes.select("gene_id", F.lit("all").alias("batch")).join(sums, ["gene_id", "batch"], "left")
    mean = F.coalesce("_s1", F.lit(0.0)) / F.col("_n")
    var = (F.coalesce("_s2", F.lit(0.0)) - F.col("_n") * mean * mean) / (F.col("_n") - 1)
    ratio = F.greatest(var, F.lit(0.0)) / F.when(mean == 0, F.lit(1e-12)).otherwise(mean)
    if batch:
        sized = sums.join(tagged.groupBy("batch").agg(F.count("*").alias("_n")), "batch")
    else:
        sized = sums.withColumn("_n", cells.agg(F.count("*")).scalar())
    base = sized.select(
        "batch", "gene_id",
        F.log1p(F.when(mean == 0, F.lit(1e-12)).otherwise(mean)).alias("means"),
        F.when(ratio > 0, F.log(ratio)).alias("dispersions"),
    )
    span = Window.partitionBy("batch")
    low, high = F.min("means").over(span), F.max("means").over(span)
    slot = F.when(high > low, F.greatest(F.ceil((F.col("means") - low) / ((high - low) / n_bins)), F.lit(1))).otherwise(1)
    binned = base.withColumn("bin", F.least(slot, F.lit(n_bins)).cast("int"))
    same = Window.partitionBy("batch", "bin")
    spread = F.stddev_samp("dispersions").over(same)
    centre = F.avg("dispersions").over(same)
    lone = F.count("dispersions").over(same) == 1
    # A bin with a single gene scores 1 by convention.
    z = F.when(lone & F.col("dispersions").isNotNull(), F.lit(1.0)).when(
        spread > 0, (F.col("dispersions") - centre) / spread
    )
    return binned.withColumn("dispersions_norm", z)


def variable_genes(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, n_top: int = 2000, batch: str | None = None
) -> DataFrame:
    """Gene table with ``highly_variable``; at most ``n_top`` genes, ties broken by gene_id.

    With ``batch``, genes are ranked by the number of batches that select them, then by mean dispersion.
    """
    scored = gene_dispersion(expr, cells, genes, batch)
    best = Window.partitionBy("batch").orderBy(F.desc_nulls_last("dispersions_norm"), "gene_id")
    picked = scored.withColumn(
        "_hit", (F.row_number().over(best) <= n_top) & F.col("dispersions_norm").isNotNull()
    )
    if batch:
        n_batches = cells.select(batch).distinct().agg(F.count("*")).scalar()
        per_gene = picked.groupBy("gene_id").agg(
            F.sum(F.col("_hit").cast("long")).alias("n_batches"),
            F.sum("dispersions_norm").alias("_sum"),
            F.count_if(F.col("dispersions_norm").isNull()).alias("_undefined"),
        ).withColumn(
            # A batch without the gene counts as zero; an undefined dispersion is skipped.
            "dispersions_norm", F.col("_sum") / F.nullif(n_batches - F.col("_undefined"), F.lit(0))
        )
        ranked = genes.select("gene_id").join(per_gene, "gene_id", "left").select(
            "gene_id", F.coalesce("n_batches", F.lit(0)).alias("n_batches"), "dispersions_norm"
        )
        order = [F.desc("n_batches"), F.desc_nulls_last("dispersions_norm"), F.asc("gene_id")]
        eligible = F.col("n_batches") > 0
    else:
        ranked = picked.select("gene_id", F.col("_hit").cast("long").alias("n_batches"), "dispersions_norm")
        order = [F.desc_nulls_last("dispersions_norm"), F.asc("gene_id")]
        eligible = F.col("n_batches") > 0
    top = ranked.where(eligible).orderBy(*order).limit(n_top).select("gene_id", F.lit(True).alias("highly_variable"))
    return ranked.join(top, "gene_id", "left").withColumn(
        "highly_variable", F.coalesce("highly_variable", F.lit(False))
    )
