"""Marker lists and gene-set networks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The named resources.
RESOURCES = ("panglao", "hallmark", "collectri", "dorothea", "progeny")


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``cell_type`` and ``gene`` in any order -> (cell_type, gene)."""
    raw = spark.read.csv(path, header=True)
    if not {"cell_type", "gene"} <= set(raw.columns):
        raise ValueError("marker list needs columns cell_type and gene")
    return raw.select("cell_type", "gene")


def marker_map(markers: DataFrame) -> DataFrame:
    """(cell_type, genes) with all genes of a type in one list."""
    return markers.groupBy("cell_type").agg(F.sort_array(F.collect_list("gene")).alias("genes"))


def markers_to_net(markers: DataFrame) -> DataFrame:
    """Marker rows as network edges of weight 1, repeats kept."""
    return markers.select(F.col("cell_type").alias("source"), F.col("gene").alias("target"), F.lit(1.0).alias("weight"))


def first_markers(markers: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of every ``by`` combination in ``order``."""
    first = Window.partitionBy(*by).orderBy(*order)
    return markers.withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1).drop("_r")


def curated_markers(
    table: DataFrame, organism: str = "human", min_sensitivity: float = 0.5, canonical_only: bool = True,
    order: list[str] | None = None,
) -> DataFrame:
    """Edges of a curated marker table: organism flag, canonical flag, sensitivity strictly above the bound."""
    keep = F.col(organism).cast("boolean") & (F.col(f"{organism}_sensitivity").cast("double") > min_sensitivity)
    if canonical_only:
        keep = keep & F.col("canonical_marker").cast("boolean")
    kept = first_markers(table.where(keep), ["cell_type", "genesymbol"], order or ["cell_type", "genesymbol"])
    return kept.select(F.col("cell_type").alias("source"), F.col("genesymbol").alias("target"))


def read_resource(spark: SparkSession, catalog: dict[str, str], name: str, **options) -> DataFrame:
    """A named network from a catalog ``name -> Parquet or CSV path`` that the user keeps."""
    key = name.lower()
    if key not in RESOURCES:
        raise ValueError(f"unknown resource {name!r}; supported: {RESOURCES}")
    if key not in catalog:
        raise ValueError(f"no file given for resource {key!r}")
    path = catalog[key]
    raw = spark.read.csv(path, header=True, inferSchema=True) if path.endswith(".csv") else spark.read.parquet(path)
    if key == "panglao":
        return curated_markers(raw, **options)
    return raw.select("source", "target", *[c for c in ("weight",) if c in raw.columns])


def read_resources(spark: SparkSession, catalog: dict[str, str], names: list[str], **options) -> DataFrame:
    """Several resources as one network with a ``net_name`` column, scored in one pass."""
    out = None
    for name in names:
        extra = options if name.lower() == "panglao" else {}
        net = read_resource(spark, catalog, name, **extra)
        if "weight" not in net.columns:
            net = net.withColumn("weight", F.lit(1.0))
        net = net.select(F.lit(name.lower()).alias("net_name"), "source", "target", F.col("weight").cast("double").alias("weight"))
        out = net if out is None else out.unionByName(net)
    if out is None:
        raise ValueError("no resource named")
    return out
