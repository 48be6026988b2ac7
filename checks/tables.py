"""The driver's tables seen as cell x gene data.

cell = customer, gene = part name (or part key), value = quantity bought; sample = market segment,
cluster = nation, status = region. Orders serve as cells with coordinates: x = price, y = order day,
library = priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def expr(spark: SparkSession, sf: str) -> DataFrame:
    """(cell_id, gene_id, value) with part names as genes."""
    rows = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return rows.groupBy(F.col("o_custkey").alias("cell_id"), F.col("p_name").alias("gene_id")).agg(
        F.sum("l_quantity").alias("value")
    )


def expr_by_part(spark: SparkSession, sf: str) -> DataFrame:
    """(cell_id, gene_id, value) with part keys as genes."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rows.groupBy(F.col("o_custkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(
        F.sum("l_quantity").alias("value")
    )


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("sample"),
            F.col("c_nationkey").cast("string").alias("cluster"), F.col("r_name").alias("status"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def genes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_name").alias("gene_id")).distinct()


def net(spark: SparkSession, sf: str) -> DataFrame:
    """First word of the part name -> part name, weight 1."""
    names = genes(spark, sf)
    return names.select(
        F.substring_index("gene_id", " ", 1).alias("source"), F.col("gene_id").alias("target"), F.lit(1.0).alias("weight")
    )


def weighted_net(spark: SparkSession, sf: str) -> DataFrame:
    """First word -> part name, weighted by the mean part size, so that sources do not add up to a constant."""
    return table(spark, sf, "part").groupBy(F.col("p_name").alias("target")).agg(F.avg("p_size").alias("weight")).select(
        F.substring_index("target", " ", 1).alias("source"), "target", "weight"
    )


def two_nets(spark: SparkSession, sf: str) -> DataFrame:
    """Two resources at once: first word and second word of the part name."""
    names = genes(spark, sf)
    return names.select(
        F.inline(F.array(
            F.struct(F.lit("first").alias("net_name"), F.substring_index("gene_id", " ", 1).alias("source")),
            F.struct(F.lit("last").alias("net_name"), F.substring_index("gene_id", " ", -1).alias("source")),
        )),
        F.col("gene_id").alias("target"), F.lit(1.0).alias("weight"),
    )


def event_cells(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(scores, cells) from events: one score per event, cluster = event type, condition = odd user."""
    e = table(spark, sf, "events")
    scores = e.select(F.col("event_id").alias("cell_id"), F.col("event_type").alias("source"), F.col("value").alias("score"))
    tagged = e.select(
        F.col("event_id").alias("cell_id"), (F.col("user_id") % 2).cast("string").alias("parity"),
        (F.col("user_id") % 2 == 1).alias("odd"), F.hour("ts").cast("string").alias("hour"),
    )
    return scores, tagged


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as cells with coordinates."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_totalprice").alias("x"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("double").alias("y"),
        F.col("o_orderpriority").alias("library"), F.col("o_orderstatus").alias("cell_type"),
    )


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def order_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as vectors of what was bought, in comparable units; unlike the embeddings they grow with the tables."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id")).agg(
        F.count("*").cast("double").alias("n"), F.avg("l_quantity").alias("q"), (F.avg("l_extendedprice") / 2000).alias("p"),
        (F.avg("l_discount") * 400).alias("d"), (F.avg("l_tax") * 500).alias("t"), (F.max("l_quantity") / 2).alias("m"),
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("cell_id"), (F.col("o_totalprice") / 20000).alias("total"))
    joined = orders.join(lines, "cell_id")
    return joined.select("cell_id", F.array(*(F.col(c).cast("double") for c in ("n", "q", "p", "d", "t", "m", "total"))).alias("vector"))
