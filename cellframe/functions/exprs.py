"""Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The gene classes of quality control.
MITO_PREFIX = "MT-"
RIBO_PREFIXES = ("RPS", "RPL")
HEMO_PATTERN = "^HB[^(P)]"
GENE_CLASSES = ("mt", "ribo", "hb")


def gene_class(gene: Column, name: str) -> Column:
    """Boolean flag of a gene class; a function of the name, so no join with a gene table is needed."""
    if name == "mt":
        return gene.startswith(MITO_PREFIX)
    if name == "ribo":
        return gene.startswith(RIBO_PREFIXES[0]) | gene.startswith(RIBO_PREFIXES[1])
    if name == "hb":
        return gene.rlike(HEMO_PATTERN)
    raise ValueError(f"unknown gene class {name!r}")


def value_bin(value: Column, per_octave: int = 64) -> Column:
    """Monotone integer bin of a value: ``per_octave`` bins for each doubling of its size, however small it is; 0 for 0.

    Ordered work on one hot key is split over these bins: order inside a bin, running totals over bins.
    """
    size = F.floor((F.log2(F.abs(value)) + 1100) * per_octave) + 1  # doubles go down to 2^-1074
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0).cast("int")


def hash_order(seed: int, *ids: Column) -> Column:
    """Reproducible pseudo-random order of rows."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[c.cast("string") for c in ids]))


def first_scalar(value: Column) -> Column:
    """First element of a list column; empty list -> empty string; null stays null."""
    return F.when(value.isNotNull(), F.coalesce(F.get(value, F.lit(0)), F.lit("")))


def box_iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two boxes with ``x_min x_max y_min y_max``."""
    w = F.least(a["x_max"], b["x_max"]) - F.greatest(a["x_min"], b["x_min"])
    h = F.least(a["y_max"], b["y_max"]) - F.greatest(a["y_min"], b["y_min"])

    def area(r):
        return (r["x_max"] - r["x_min"]) * (r["y_max"] - r["y_min"])

    inter = w * h
    return F.when((w <= 0) | (h <= 0), F.lit(0.0)).otherwise(inter / (area(a) + area(b) - inter))


def box(prefix: str = "") -> dict[str, Column]:
    return {k: F.col(prefix + k) for k in ("x_min", "x_max", "y_min", "y_max")}


def lookup(small: DataFrame, key: str, *columns: str) -> Column:
    """Rows of a few-group summary as one map, key -> struct, in a scalar subquery.

    Reading it with ``try_element_at`` spares a join on a key with few, hot values.
    """
    return small.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct(*columns))))).scalar()
