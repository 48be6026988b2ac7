"""Rank sums and false-discovery correction that no single hot key can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.exprs import value_bin


def rank_sums(df: DataFrame, by: list[str], group: str, value: str, per_octave: int = 64) -> DataFrame:
    """Average ranks (ties shared) of ``value`` within ``by``, summed per ``group``.

    Returns ``by, group, n, n_pos, n_neg, rank_sum, s1, s2``. Equal values are counted before the shuffle,
    so copies collapse; the distinct values of one key are ordered bin by bin, in separate tasks, and the
    bins are put in order by running totals over their sizes.
    """
    v = F.col(value).cast("double")
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*by, group, v.alias("_v"))
        .agg(F.count("*").cast("double").alias("_c"))
        .withColumn("_bin", value_bin(F.col("_v"), per_octave))
    )
    upward = Window.partitionBy(*by, "_bin").orderBy("_v")
    tied = Window.partitionBy(*by, "_bin", "_v")
    ranked = counts.select(
        *by, group, "_bin", "_v", "_c",
        F.sum("_c").over(upward).alias("_upto"), F.sum("_c").over(tied).alias("_tie"),
    )
    average = F.col("_upto") - F.col("_tie") + (F.col("_tie") + 1) / 2
    c = F.col("_c")
    per_bin = ranked.groupBy(*by, "_bin", group).agg(
        F.sum(c * average).alias("_r"), F.sum(c).alias("_n"),
        F.sum(F.when(F.col("_v") > 0, c).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(F.col("_v") < 0, c).otherwise(0.0)).alias("_neg"),
        F.sum(c * F.col("_v")).alias("_s1"), F.sum(c * F.col("_v") * F.col("_v")).alias("_s2"),
    )
    below = Window.partitionBy(*by).orderBy("_bin").rangeBetween(Window.unboundedPreceding, -1)
    placed = per_bin.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0.0)))
    return placed.groupBy(*by, group).agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"),
        F.sum(F.col("_r") + F.col("_n") * F.col("_below")).alias("rank_sum"),
        F.sum("_s1").alias("s1"), F.sum("_s2").alias("s2"),
    )


def rank_sum_z(rank_sum: Column, n1: Column, n2: Column) -> Column:
    """Normal statistic of a rank sum, without tie or continuity correction."""
    n = n1 + n2
    spread = F.sqrt(n1 * n2 * (n + 1) / 12)
    return F.when(spread > 0, (rank_sum - n1 * (n + 1) / 2) / spread)


def adjust_bounded(df: DataFrame, p: str, by: list[str], out: str = "pval_adj") -> DataFrame:
    """Benjamini-Hochberg within groups whose size is bounded by the number of genes."""
    upward = Window.partitionBy(*by).orderBy(p)
    raw = F.col(p) * F.count(p).over(Window.partitionBy(*by)) / F.count(p).over(upward)
    downward = Window.partitionBy(*by).orderBy(F.desc(p))
    ranked = df.withColumn("_raw", F.when(F.col(p).isNotNull(), raw))
    # Nulls sort last in descending order, so they do not reach the running minimum of the others.
    return ranked.withColumn(
        out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("_raw").over(downward)))
    ).drop("_raw")


def adjust(df: DataFrame, p: str, by: list[str] | None = None, out: str = "pval_adj") -> DataFrame:
    """Benjamini-Hochberg over groups of any size: order inside p bins, running values over bins."""
    by = by or []
    work = df if by else df.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    bin_of = F.when(F.col("_p") > 0, F.floor(F.log2("_p") * 64)).otherwise(-100_000).cast("int")
    counts = (
        work.where(F.col(p).isNotNull()).groupBy(*keys, F.col(p).alias("_p")).agg(F.count("*").alias("_c"))
        .withColumn("_bin", bin_of)
    )
    sizes = counts.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_n"))
    upward = Window.partitionBy(*keys).orderBy("_bin")
    sizes = sizes.select(
        *keys, "_bin", (F.sum("_n").over(upward) - F.col("_n")).alias("_below"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_m"),
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy("_p")
    raw = F.col("_p") * F.col("_m") / (F.col("_below") + F.sum("_c").over(inside))
    ranked = counts.join(sizes, [*keys, "_bin"]).select(*keys, "_bin", "_p", raw.alias("_raw"))
    later = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(1, Window.unboundedFollowing)
    floors = ranked.groupBy(*keys, "_bin").agg(F.min("_raw").alias("_low")).select(
        *keys, "_bin", F.min("_low").over(later).alias("_later")
    )
    downward = Window.partitionBy(*keys, "_bin").orderBy(F.desc("_p"))
    adjusted = ranked.join(floors, [*keys, "_bin"]).select(
        *keys, "_p", F.least(F.lit(1.0), F.min("_raw").over(downward), F.col("_later")).alias(out)
    )
    joined = work.withColumn("_p", F.col(p)).join(adjusted, [*keys, "_p"], "left").drop("_p")
    return joined if by else joined.drop("_all")


def median_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, median), exact; only the value bins at the middle positions are ordered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_n")
    ).withColumn("_bin", value_bin(F.col("_v")))
    bins = counts.groupBy(key, "_bin").agg(F.sum("_n").alias("_n"))
    upward = Window.partitionBy(key).orderBy("_bin")
    bins = bins.select(
        key, "_bin", (F.sum("_n").over(upward) - F.col("_n")).alias("_below"), F.sum("_n").over(upward).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(key)).alias("_all"),
    )
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    holds = ((F.col("_below") <= low) & (low < F.col("_upto"))) | ((F.col("_below") <= high) & (high < F.col("_upto")))
    inside = Window.partitionBy(key, "_bin").orderBy("_v")
    near = counts.join(bins.where(holds).drop("_upto"), [key, "_bin"]).withColumn(
        "_upto", F.col("_below") + F.sum("_n").over(inside)
    )
    first, second = F.min(F.when(F.col("_upto") > low, F.col("_v"))), F.min(F.when(F.col("_upto") > high, F.col("_v")))
    return near.groupBy(key).agg(((first + second) / 2).alias("median"))
