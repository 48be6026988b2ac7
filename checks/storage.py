"""Stored datasets, raw sample folders and manifests, made from orders and lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.plans import pipeline
from cellframe.session import scratch_root
from cellframe.sources import dataset as ds
from checks import sql as S
from checks import tables as t
from checks.registry import query


def folder(spark, name: str) -> str:
    """A new folder in the shared scratch folder."""
    return f"{scratch_root(spark)}/cellframe-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def study(spark, sf) -> dict:
    cells = t.cells(spark, sf).select("cell_id", "sample", "cluster")
    return {"cells": cells, "genes": t.genes(spark, sf), "expr": t.expr(spark, sf)}


def summary(parts: dict) -> DataFrame:
    """Cells and counted values per sample."""
    tagged = parts["expr"].join(parts["cells"].select("cell_id", "sample"), "cell_id")
    return tagged.groupBy("sample").agg(
        F.count_distinct("cell_id").alias("n_cells"), F.count("*").alias("n_values"), F.sum("value").cast("bigint").alias("total")
    )


SUMMARY = """
SELECT sample, count(DISTINCT cell_id) AS n_cells, count(*) AS n_values, sum(value)::BIGINT AS total
FROM expr JOIN cells USING (cell_id) {where} GROUP BY 1"""


@query("dataset_round_trip", S.with_(S.EXPR, S.CELLS) + SUMMARY.format(where=""))
def dataset_round_trip(spark, sf):
    root = folder(spark, "study")
    ds.write_dataset(study(spark, sf), root)
    return summary(ds.open_dataset(spark, root))


@query("table_replace", S.with_(S.CELLS) + """
SELECT cell_id, sample, cluster, length(cluster)::BIGINT AS extra FROM cells WHERE cluster <> '3'""")
def table_replace(spark, sf):
    """A table derived from the one it replaces; its siblings stay."""
    root = folder(spark, "study")
    ds.write_dataset({"cells": study(spark, sf)["cells"], "genes": t.genes(spark, sf)}, root)
    old = ds.read_table(spark, root, "cells")
    ds.write_table(old.where("cluster <> '3'").withColumn("extra", F.length("cluster").cast("bigint")), root, "cells")
    return ds.open_dataset(spark, root, ["genes", "cells"])["cells"]


@query("partition_update", S.with_(S.CELLS) + """
SELECT sample, count(*) AS n_cells, count(*) FILTER (changed) AS n_changed
FROM (SELECT sample, sample LIKE 'B%' AS changed FROM cells) GROUP BY 1""")
def partition_update(spark, sf):
    """Samples that begin with B are written anew, the others stay as they were."""
    root = folder(spark, "study")
    cells = study(spark, sf)["cells"].withColumn("changed", F.lit(False))
    ds.write_table(cells, root, "cells", ["sample"])
    ds.update_partitions(cells.where("sample like 'B%'").withColumn("changed", F.lit(True)), root, "cells", ["sample"])
    out = ds.read_table(spark, root, "cells")
    return out.groupBy("sample").agg(F.count("*").alias("n_cells"), F.count_if("changed").alias("n_changed"))


def write_raw_folder(spark, sf, root: str, status: str) -> None:
    """An instrument's folder: orders of one status are cells, their lines transcripts."""
    orders = t.table(spark, sf, "orders").where(F.col("o_orderstatus") == status)
    orders.select(
        F.col("o_orderkey").alias("cell_id"), F.col("o_totalprice").alias("x_centroid"), F.col("o_custkey").cast("double").alias("y_centroid")
    ).write.parquet(f"{root}/cells.parquet")
    lines = t.table(spark, sf, "lineitem").join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    number = F.col("l_partkey")
    name = F.when(number % 50 == 0, F.concat(F.lit("NegControlProbe_"), number)).otherwise(F.concat(F.lit("gene_"), number % 97))
    cell = F.when(number % 31 == 0, F.lit("UNASSIGNED")).otherwise(F.col("l_orderkey").cast("string"))
    lines.select(cell.alias("cell_id"), name.alias("feature_name"), F.col("l_quantity").alias("qv")).write.parquet(f"{root}/transcripts.parquet")


TRANSCRIPTS = """
tx AS (SELECT l_orderkey::VARCHAR AS cell_id, o_orderstatus AS sample, 'gene_' || (l_partkey % 97) AS gene_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 50 <> 0 AND l_partkey % 31 <> 0 AND l_quantity >= 20)"""


@query("instrument_folder", "WITH" + TRANSCRIPTS + """
SELECT cell_id, gene_id, count(*)::DOUBLE AS value FROM tx WHERE sample = 'F' GROUP BY 1, 2""")
def instrument_folder(spark, sf):
    root = folder(spark, "raw")
    write_raw_folder(spark, sf, root, "F")
    return ds.read_instrument_folder(spark, root)["expr"]


@query("multi_sample_load", "WITH" + TRANSCRIPTS + """
SELECT sample, 'site ' || sample AS site, count(DISTINCT cell_id) AS n_cells, count(*) AS total FROM tx GROUP BY 1""")
def multi_sample_load(spark, sf):
    """Two raw folders and a stored dataset, named by a manifest."""
    root = folder(spark, "samples")
    for status in "FO":
        write_raw_folder(spark, sf, f"{root}/{status}", status)
    write_raw_folder(spark, sf, f"{root}/P", "P")
    ds.write_dataset(ds.read_instrument_folder(spark, f"{root}/P"), f"{root}/P.dataset")
    rows = [("F", f"{root}/F", "site F", 0), ("O", f"{root}/O", "site O", 1), ("P", f"{root}/P.dataset", "site P", 2)]
    manifest = spark.createDataFrame(rows, "sample string, path string, site string, ordinal long")
    parts = ds.load_samples(spark, manifest)
    return parts["expr"].join(parts["cells"], "cell_id").groupBy("sample", "site").agg(
        F.count_distinct("cell_id").alias("n_cells"), F.sum("value").cast("bigint").alias("total")
    )


@query("resume_output", S.with_(S.EXPR, S.CELLS, """
big AS (SELECT cell_id FROM expr WHERE value > 0 GROUP BY 1 HAVING count(*) >= 10),
wide AS (SELECT gene_id FROM expr JOIN big USING (cell_id) WHERE value > 0 GROUP BY 1 HAVING count(*) >= 3)""") + """
SELECT sample, count(DISTINCT cell_id) AS n_cells, count(*) AS n_values, sum(value)::BIGINT AS total
FROM expr JOIN big USING (cell_id) JOIN wide USING (gene_id) JOIN cells USING (cell_id) GROUP BY 1""")
def resume_output(spark, sf):
    """A stage that writes to a new folder, run twice: the second call finds its result there."""
    first, second = folder(spark, "study"), folder(spark, "normalised")
    ds.write_dataset(study(spark, sf), first)
    for again in (False, True):
        pipeline.normalize(spark, first, output=second, min_genes=10, min_cells=3, resume=again)
    return summary(ds.open_dataset(spark, second))
