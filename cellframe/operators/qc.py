"""Quality control and filters over ``expr(cell_id, gene_id, value)``, non-zeros only."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe.functions.exprs import GENE_CLASSES, gene_class, lookup
from cellframe.functions.params import parse_equality
from cellframe.operators.ranks import median_by

# The k of "share of counts in the top k genes".
TOP_SHARES = (20, 50, 100)


def flag_genes(genes: DataFrame) -> DataFrame:
    """Add the boolean class columns ``mt``, ``ribo``, ``hb``."""
    return genes.select("*", *[gene_class(F.col("gene_id"), c).alias(c) for c in GENE_CLASSES])


def top_share_sizes(n_genes: int) -> list[int]:
    return [k for k in TOP_SHARES if k < n_genes] or [min(TOP_SHARES[0], n_genes)]


def cell_qc(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Per-cell counts, detected genes and class shares; cells without counts get zeros.

    One partial aggregate over ``expr``: the gene classes are functions of the gene name.
    """
    gene, value = F.col("gene_id"), F.col("value")
    sums = [F.sum(F.when(gene_class(gene, c), value)).alias(f"total_counts_{c}") for c in GENE_CLASSES]
    per_cell = expr.groupBy("cell_id").agg(
        F.count_if(value > 0).alias("n_genes_by_counts"), F.sum(value).alias("total_counts"), *sums
    )
    names = ["total_counts"] + [f"total_counts_{c}" for c in GENE_CLASSES]
    out = cells.select("cell_id").join(per_cell, "cell_id", "left")
    out = out.select(
        "cell_id",
        F.coalesce("n_genes_by_counts", F.lit(0)).alias("n_genes_by_counts"),
        *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names],
    )
    shares = [
        F.when(F.col("total_counts") > 0, 100 * F.col(f"total_counts_{c}") / F.col("total_counts"))
        .alias(f"pct_counts_{c}")
        for c in GENE_CLASSES
    ]
    logs = [F.log1p(n).alias(f"log1p_{n}") for n in ["n_genes_by_counts", *names]]
    return out.select("*", *shares, *logs)


def top_gene_share(expr: DataFrame, sizes: list[int]) -> DataFrame:
    """Percentage of a cell's counts held by its k largest genes, for every k in ``sizes``.

    The rows of one cell are bounded by the number of genes; the rank filter is applied before the
    shuffle (window group limit), the totals by a partial aggregate.
    """
    biggest = Window.partitionBy("cell_id").orderBy(F.desc("value"), "gene_id")
    top = expr.withColumn("_r", F.row_number().over(biggest)).where(F.col("_r") <= max(sizes))
    held = top.groupBy("cell_id").agg(
        *[F.sum(F.when(F.col("_r") <= k, F.col("value"))).alias(f"_top{k}") for k in sizes]
    )
    totals = expr.groupBy("cell_id").agg(F.sum("value").alias("_total"))
    return totals.join(held, "cell_id").select(
        "cell_id",
        *[(100 * F.col(f"_top{k}") / F.col("_total")).alias(f"pct_counts_in_top_{k}_genes") for k in sizes],
    )


def gene_qc(expr: DataFrame, genes: DataFrame, n_cells: int) -> DataFrame:
    """Per-gene counts; the mean is over all cells, implicit zeros included."""
    value = F.col("value")
    per_gene = expr.groupBy("gene_id").agg(
        F.count_if(value > 0).alias("n_cells_by_counts"), F.sum(value).alias("total_counts")
    )
    out = genes.select("gene_id").join(per_gene, "gene_id", "left").select(
        "gene_id",
        F.coalesce("n_cells_by_counts", F.lit(0)).alias("n_cells_by_counts"),
        F.coalesce("total_counts", F.lit(0.0)).alias("total_counts"),
    )
    mean = F.col("total_counts") / F.lit(n_cells)
    return out.select(
        "*",
        mean.alias("mean_counts"),
        (100 * (1 - F.col("n_cells_by_counts") / F.lit(n_cells))).alias("pct_dropout_by_counts"),
        F.log1p(mean).alias("log1p_mean_counts"),
        F.log1p("total_counts").alias("log1p_total_counts"),
    )


def filter_cells(expr: DataFrame, min_genes: int = 100) -> DataFrame:
    """Keep the rows of cells with at least ``min_genes`` detected genes."""
    enough = expr.groupBy("cell_id").agg(F.count_if(F.col("value") > 0).alias("_n")).where(F.col("_n") >= min_genes)
    return expr.join(enough.select("cell_id"), "cell_id", "left_semi")


def filter_genes(expr: DataFrame, min_cells: int = 3) -> DataFrame:
    """Keep the rows of genes detected in at least ``min_cells`` of the cells present."""
    enough = expr.groupBy("gene_id").agg(F.count_if(F.col("value") > 0).alias("_n")).where(F.col("_n") >= min_cells)
    return expr.join(enough.select("gene_id"), "gene_id", "left_semi")


def filter_cells_and_genes(expr: DataFrame, min_genes: int = 100, min_cells: int = 3) -> DataFrame:
    """Cells first, then genes among the surviving cells; the order matters."""
    return filter_genes(filter_cells(expr, min_genes), min_cells)


def filter_by_equality(cells: DataFrame, text: str) -> DataFrame:
    """Cells that match ``"column==value"``. Values are compared as strings: other types never match."""
    column, value = parse_equality(text)
    if column not in cells.columns:
        raise KeyError(f"no cell attribute {column!r}; available: {cells.columns}")
    if not isinstance(cells.schema[column].dataType, T.StringType):
        warnings.warn(f"{column!r} is not a string attribute, so {text!r} matches no cell", stacklevel=2)
        return cells.where(F.lit(False))
    return cells.where(F.col(column) == F.lit(value))


def in_box(cells: DataFrame, x_min: float, x_max: float, y_min: float, y_max: float) -> DataFrame:
    """Cells within a rectangle, bounds included."""
    return cells.where(F.col("x").between(x_min, x_max) & F.col("y").between(y_min, y_max))


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact medians (nulls skipped) of several columns as rows ``(metric, median)``."""
    return median_by(_as_metrics(df, columns), "metric", "_v")


def _as_metrics(df: DataFrame, columns: list[str]) -> DataFrame:
    values = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("_v")) for c in columns])
    return df.select(F.inline(values)).where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def qc_medians(qc: DataFrame) -> DataFrame:
    return medians(qc, ["n_genes_by_counts", "total_counts", "pct_counts_mt"])


def qc_distribution(qc: DataFrame, columns: list[str], n_bins: int = 50) -> DataFrame:
    """Equal-width histogram of QC columns: the table behind violin and histogram plots."""
    spread = _as_metrics(qc, columns)
    ranges = lookup(spread.groupBy("metric").agg(F.min("_v").alias("low"), F.max("_v").alias("high")), "metric", "low", "high")
    width = (F.col("high") - F.col("low")) / n_bins
    slot = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("low")) / width), F.lit(n_bins - 1))).otherwise(0)
    ranged = spread.withColumn("_r", F.try_element_at(ranges, F.col("metric"))).select("metric", "_v", "_r.low", "_r.high")
    binned = ranged.groupBy("metric", slot.cast("int").alias("bin")).agg(
        F.count("*").alias("n_cells"), F.any_value("low").alias("_low"), F.any_value(width).alias("_width")
    )
    return binned.select(
        "metric", "bin", "n_cells",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
    )


def unique_names(df: DataFrame, name: str, ordinal: str) -> DataFrame:
    """Make ``name`` unique: the first keeps it, later repeats get ``-1``, ``-2``, ... in ``ordinal`` order.

    Repeats are numbered per (name, ordinal bin) with running totals over bins, so one name may repeat
    any number of times. A suffixed name that already exists as an original is skipped over.
    """
    stride = 1 << 20
    slotted = df.withColumn("_bin", F.floor(F.col(ordinal) / stride))
    bins = slotted.groupBy(name, "_bin").agg(F.count("*").alias("_n"))
    upward = Window.partitionBy(name).orderBy("_bin")
    bins = bins.select(name, "_bin", (F.sum("_n").over(upward) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(name, "_bin").orderBy(ordinal)
    repeat = F.col("_before") + F.row_number().over(inside) - 1
    numbered = slotted.join(bins, [name, "_bin"]).withColumn("_k", repeat)
    originals = df.select(name).distinct()
    return _skip_taken(numbered, originals, name).drop("_bin", "_before", "_k")


def _skip_taken(numbered: DataFrame, originals: DataFrame, name: str) -> DataFrame:
    """Turn repeat numbers into suffixes, stepping over the suffixes that occur as original names."""
    taken = originals.select(
        F.regexp_extract(name, r"^(.*)-([0-9]{1,9})$", 1).alias("_base"),
        F.regexp_extract(name, r"^(.*)-([1-9][0-9]{0,8})$", 2).alias("_digits"),
    ).where(F.col("_digits") != "").join(
        originals.select(F.col(name).alias("_base")), "_base", "left_semi"
    ).groupBy("_base").agg(F.sort_array(F.collect_set(F.col("_digits").cast("long"))).alias("_taken"))
    joined = numbered.join(taken, numbered[name] == taken["_base"], "left")
    suffix = F.aggregate(
        F.coalesce("_taken", F.array().cast("array<bigint>")), F.col("_k").cast("long"),
        lambda at, used: F.when((F.col("_k") > 0) & (used <= at), at + 1).otherwise(at),
    )
    renamed = F.when(F.col("_k") == 0, F.col(name)).otherwise(F.concat_ws("-", F.col(name), suffix))
    return joined.withColumn(name, renamed).drop("_base", "_taken")
