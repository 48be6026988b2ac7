"""Cluster labels from scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def cluster_moments(scores: DataFrame, clusters: DataFrame) -> DataFrame:
    """(cluster_key, cluster, source) -> n, mean, variance inside and outside the cluster.

    One aggregate: "outside" is the total over clusters minus the cluster itself. Null scores are skipped.
    """
    tagged = scores.where(F.col("score").isNotNull()).join(clusters, "cell_id")
    s = F.col("score")
    inside = tagged.groupBy("cluster_key", "cluster", "source").agg(
        F.count("*").alias("n"), F.sum(s).alias("s1"), F.sum(s * s).alias("s2")
    )
    whole = Window.partitionBy("cluster_key", "source")
    rest = {c: F.sum(c).over(whole) - F.col(c) for c in ("n", "s1", "s2")}

    def var(n, s1, s2):
        return F.when(n > 1, F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0)))

    sums = inside.select(
        "cluster_key", "cluster", "source", "n", "s1", "s2", *[rest[c].alias(f"r_{c}") for c in rest]
    )
    return sums.select(
        "cluster_key", "cluster", "source", "n", F.col("r_n").alias("n_rest"),
        (F.col("s1") / F.col("n")).alias("mean"),
        F.when(F.col("r_n") > 0, F.col("r_s1") / F.col("r_n")).alias("mean_rest"),
        var(F.col("n"), F.col("s1"), F.col("s2")).alias("var"),
        var(F.col("r_n"), F.col("r_s1"), F.col("r_s2")).alias("var_rest"),
    )


def rank_sources(scores: DataFrame, clusters: DataFrame) -> DataFrame:
    """One-vs-rest t statistic per (cluster, source), the variance over-estimated by n_rest = n."""
    m = cluster_moments(scores, clusters)
    error = F.sqrt(F.col("var") / F.col("n") + F.col("var_rest") / F.col("n"))
    gap = F.col("mean") - F.col("mean_rest")
    return m.select("cluster_key", "cluster", "source", gap.alias("difference"), F.when(error > 0, gap / error).alias("stat"))


def top_positive(scores: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per cluster the source with the highest positive statistic (ties: first name), else ``Unknown``."""
    positive = rank_sources(scores, clusters).where(F.col("stat") > 0)
    first = Window.partitionBy("cluster_key", "cluster").orderBy(F.desc("stat"), "source")
    best = positive.withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1)
    every = clusters.select("cluster_key", "cluster").distinct()
    return every.join(best, ["cluster_key", "cluster"], "left").select(
        "cluster_key", "cluster", F.coalesce("source", F.lit(UNKNOWN)).alias("label")
    )


Strategy = Callable[[DataFrame, DataFrame], DataFrame]

STRATEGIES: dict[str, Strategy] = {"top_positive": top_positive}


def cluster_columns(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cluster columns as long rows ``(cell_id, cluster_key, cluster)``, null clusters left out."""
    missing = [k for k in keys if k not in cells.columns]
    if missing:
        raise ValueError(f"no cluster columns {missing}; available: {cells.columns}")
    pairs = F.array(*[F.struct(F.lit(k).alias("cluster_key"), F.col(k).cast("string").alias("cluster")) for k in keys])
    return cells.select("cell_id", F.inline(pairs)).where(F.col("cluster").isNotNull())


def label_clusters(scores: DataFrame, cells: DataFrame, keys: list[str], strategy: str = "top_positive") -> DataFrame:
    """``(cluster_key, cluster, label)`` for one or many clusterings in a single pass over the scores."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; available: {sorted(STRATEGIES)}")
    return STRATEGIES[strategy](scores, cluster_columns(cells, keys))


def attach_labels(cells: DataFrame, labels: DataFrame, key: str, column: str) -> DataFrame:
    """Give every cell the label of its cluster."""
    lookup = labels.where(F.col("cluster_key") == key).select(
        F.col("cluster").alias("_cluster"), F.col("label").alias(column)
    )
    return cells.join(lookup, F.col(key).cast("string") == F.col("_cluster"), "left").drop("_cluster")


def label_sizes(cells: DataFrame, column: str) -> DataFrame:
    return cells.groupBy(column).agg(F.count("*").alias("n_cells"))
