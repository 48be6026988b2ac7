"""Exact down-sampling by a reproducible hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.exprs import hash_order, lookup

_PREFIX = 4  # hex digits of the hash: 65,536 slots per group


def _keep_first(cells: DataFrame, by: str, keep: Column, seed: int) -> DataFrame:
    """Per group the first ``keep`` rows in hash order, no group passing through one task.

    Rows are counted per hash slot; running totals over the slots find the slot where the quota ends.
    Earlier slots are kept by a filter, and only that one slot of each group is ordered.
    ``keep`` may refer to ``_size``, the number of rows of the group.
    """
    hashed = cells.withColumn("_h", hash_order(seed, F.col("cell_id")))
    hashed = hashed.withColumn("_slot", F.conv(F.substring("_h", 1, _PREFIX), 16, 10).cast("int"))
    slots = hashed.groupBy(by, "_slot").agg(F.count("*").alias("_n"))
    upward = Window.partitionBy(by).orderBy("_slot")
    slots = slots.select(
        by, "_slot", "_n",
        F.sum("_n").over(upward).alias("_upto"), F.sum("_n").over(Window.partitionBy(by)).alias("_size"),
    )
    last = slots.withColumn("_keep", keep).where(
        (F.col("_upto") - F.col("_n") < F.col("_keep")) & (F.col("_upto") >= F.col("_keep"))
    ).select(by, F.col("_slot").alias("_last"), (F.col("_keep") - F.col("_upto") + F.col("_n")).alias("_need"))
    short = slots.groupBy(by).agg(F.max("_slot").alias("_max"), F.any_value("_size").alias("_size")).withColumn(
        "_keep", keep
    ).where((F.col("_size") < F.col("_keep"))).select(
        by, F.col("_max").alias("_last"), F.lit(None).cast("bigint").alias("_need")
    )
    limits = lookup(last.unionByName(short), by, "_last", "_need")
    joined = hashed.withColumn("_end", F.try_element_at(limits, F.col(by))).select(
        "*", F.col("_end._last").alias("_last"), F.col("_end._need").alias("_need")
    ).where(F.col("_slot") <= F.col("_last"))
    whole = joined.where((F.col("_slot") < F.col("_last")) | F.col("_need").isNull())
    order = Window.partitionBy(by).orderBy("_h", "cell_id")
    part = joined.where((F.col("_slot") == F.col("_last")) & F.col("_need").isNotNull())
    part = part.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= F.col("_need")).drop("_r")
    return whole.unionByName(part).select(*cells.columns)


def downsample_fraction(cells: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """``int(n * fraction)`` cells without replacement; 1 keeps everything."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must lie in (0, 1]")
    if fraction == 1:
        return cells
    quota = F.floor(F.col("_size") * F.lit(float(fraction)))
    return _keep_first(cells.withColumn("_all", F.lit(0)), "_all", quota, seed).drop("_all")


def downsample_per_sample(cells: DataFrame, n: int, seed: int = 0, sample: str = "sample") -> DataFrame:
    """At most ``n`` cells of every sample; smaller samples stay whole. Cells without a sample are a sample of their own."""
    if n < 1:
        raise ValueError("n must be positive")
    named = cells.withColumn("_sample", F.to_json(F.struct(F.col(sample).alias("s"))))  # a null has a name, too
    return _keep_first(named, "_sample", F.lit(n).cast("bigint"), seed).drop("_sample")
