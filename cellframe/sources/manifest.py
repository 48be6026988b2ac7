"""Sample manifests and multi-sample loading."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("sample", "path")
MAX_SAMPLES = 100_000


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """CSV with ``sample``, ``path`` and any metadata columns, plus ``ordinal`` (row order)."""
    raw = spark.read.csv(path, header=True, inferSchema=True)
    missing = [c for c in REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"manifest is missing required columns: {missing}")
    return raw.withColumn("ordinal", F.monotonically_increasing_id())


def metadata_columns(manifest: DataFrame) -> list[str]:
    return [c for c in manifest.columns if c not in (*REQUIRED, "ordinal")]


def attach_metadata(cells: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add the manifest's metadata to cells by sample; unknown samples get nulls."""
    extra = metadata_columns(manifest)
    kept = [c for c in cells.columns if c not in extra]
    return cells.select(*kept).join(manifest.select("sample", *extra), "sample", "left")


def sample_of_region(regions: DataFrame, manifest: DataFrame) -> DataFrame:
    """(region, sample): first manifest sample that ends the region name, else the region itself.

    Works on distinct regions. The suffix test becomes an equi join: every region is matched by its
    suffixes of the lengths that sample names have.
    """
    names = manifest.select(F.col("sample").cast("string").alias("_name"), "ordinal")
    lengths = names.agg(F.collect_set(F.length("_name"))).scalar()
    suffixes = regions.select("region").where(F.col("region").isNotNull()).distinct().select(
        "region", F.explode_outer(lengths).alias("_len")
    ).where(F.col("_len").isNull() | (F.col("_len") <= F.length("region")))
    tail = F.expr("right(region, _len)")
    hits = suffixes.select("region", tail.alias("_name")).join(names, "_name")
    first = hits.groupBy("region").agg(F.min_by("_name", "ordinal").alias("sample"))
    return regions.select("region").distinct().join(first, "region", "left").select(
        "region", F.coalesce("sample", "region").alias("sample")
    )


def assign_samples(cells: DataFrame, manifest: DataFrame) -> DataFrame:
    """Fill ``sample`` of cells from their region names."""
    return cells.drop("sample").join(sample_of_region(cells, manifest), "region", "left")


def concat_samples(parts: list[DataFrame]) -> DataFrame:
    """Union of samples; columns missing in one are null there. Genes need no alignment in long form."""
    if not parts:
        raise ValueError("no samples to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def list_samples(manifest: DataFrame) -> list[tuple[str, str]]:
    """(sample, path) in manifest order; the manifest is a bounded control table."""
    rows = manifest.orderBy("ordinal").select("sample", "path").limit(MAX_SAMPLES + 1).collect()
    if len(rows) > MAX_SAMPLES:
        raise ValueError(f"manifest lists more than {MAX_SAMPLES} samples")
    return [(str(r[0]), r[1]) for r in rows]


def repoint(manifest: DataFrame, produced: DataFrame) -> DataFrame:
    """Manifest rows whose sample was produced, with ``path`` replaced by the produced one."""
    new = produced.select("sample", F.col("path").alias("_new"))
    return manifest.join(new, "sample").withColumn("path", F.col("_new")).drop("_new").select(*manifest.columns)

