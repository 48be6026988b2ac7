"""Regions of interest: sliding windows, counts, overlap and a greedy pick."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.exprs import box, box_iou
from cellframe.session import store
from cellframe.sources.dataset import exists, tables, update_partitions

MAX_RANKED = 10_000
WINDOW_FRACTIONS = (0.15, 0.2, 0.25, 0.3, 0.35, 0.4)
STEP_FRACTION = 0.35


def sliding_windows(
    points: DataFrame, fractions: tuple[float, ...] = WINDOW_FRACTIONS, step_fraction: float = STEP_FRACTION
) -> DataFrame:
    """``(window_id, window_frac, x_min, x_max, y_min, y_max)`` in scan order over the extent of the points.

    The last window of a row may reach past the extent. The number of windows depends on the parameters
    only, not on the data.
    """
    extent = points.agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    fracs = F.array(*[F.struct(F.lit(i).alias("f"), F.lit(float(v)).alias("window_frac")) for i, v in enumerate(fractions)])
    sized = extent.select("*", F.inline(fracs)).select(
        "*", ((F.col("x1") - F.col("x0")) * F.col("window_frac")).alias("w"),
        ((F.col("y1") - F.col("y0")) * F.col("window_frac")).alias("h"),
    ).where((F.col("w") > 0) & (F.col("h") > 0)).select(
        "*", F.greatest(F.col("w") * step_fraction, F.lit(1e-6)).alias("dx"),
        F.greatest(F.col("h") * step_fraction, F.lit(1e-6)).alias("dy"),
    )

    def places(low: str, high: str, size: str, step: str):
        n = F.ceil((F.col(high) - F.col(size) + F.col(step) - F.col(low)) / F.col(step)).cast("int")
        return F.explode(F.sequence(F.lit(0), n - 1))

    grid = sized.select("*", places("x0", "x1", "w", "dx").alias("i")).select("*", places("y0", "y1", "h", "dy").alias("j"))
    xs, ys = F.col("x0") + F.col("i") * F.col("dx"), F.col("y0") + F.col("j") * F.col("dy")
    order = F.row_number().over(Window.orderBy("f", "i", "j"))
    return grid.select(
        order.alias("window_id"), "window_frac", xs.alias("x_min"), (xs + F.col("w")).alias("x_max"),
        ys.alias("y_min"), (ys + F.col("h")).alias("y_max"),
    )


def _tiles(boxes: DataFrame, key: str) -> DataFrame:
    """Boxes cut into tiles: about 16 per average side, at most 65 per longest side."""
    sides = {
        a: boxes.agg(F.greatest(F.avg(F.col(f"{a}_max") - F.col(f"{a}_min")) / 16, F.max(F.col(f"{a}_max") - F.col(f"{a}_min")) / 64))
        .scalar() for a in ("x", "y")
    }
    sized = boxes.select(key, "x_min", "x_max", "y_min", "y_max", sides["x"].alias("sx"), sides["y"].alias("sy"))

    def span(axis: str):
        return F.sequence(*[F.floor(F.col(f"{axis}_{e}") / F.col(f"s{axis}")).cast("long") for e in ("min", "max")])

    spread = sized.select("*", F.explode(span("x")).alias("tx")).select("*", F.explode(span("y")).alias("ty"))
    inner = F.lit(True)
    for axis in ("x", "y"):
        low, high = (F.floor(F.col(f"{axis}_{e}") / F.col(f"s{axis}")) for e in ("min", "max"))
        inner = inner & (F.col(f"t{axis}") > low) & (F.col(f"t{axis}") < high)
    return spread.withColumn("inner", inner)


def _with_tile(points: DataFrame, boxes: DataFrame) -> DataFrame:
    def side(a):
        size = F.col(f"{a}_max") - F.col(f"{a}_min")
        return boxes.agg(F.greatest(F.avg(size) / 16, F.max(size) / 64)).scalar()

    return points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("_sx", side("x")).withColumn(
        "_sy", side("y")
    ).withColumn("tx", F.floor(F.col("x") / F.col("_sx")).cast("long")).withColumn(
        "ty", F.floor(F.col("y") / F.col("_sy")).cast("long")
    ).drop("_sx", "_sy")


def _inside():
    return F.col("x").between(F.col("x_min"), F.col("x_max")) & F.col("y").between(F.col("y_min"), F.col("y_max"))


def count_in_boxes(points: DataFrame, boxes: DataFrame, key: str = "window_id") -> DataFrame:
    """``(key, n_cells)``: cells in each box, bounds included.

    A range join on tiles. Tiles strictly inside a box contribute their total, so single cells meet only
    the boxes whose border crosses their tile.
    """
    placed = _with_tile(points.select("x", "y"), boxes)
    tiles = _tiles(boxes, key)
    totals = placed.groupBy("tx", "ty").agg(F.count("*").alias("n"))
    inner = tiles.where("inner").join(totals, ["tx", "ty"]).select(key, "n")
    edge = tiles.where(~F.col("inner")).join(placed, ["tx", "ty"]).where(_inside()).groupBy(key).agg(F.count("*").alias("n"))
    sums = inner.unionByName(edge).groupBy(key).agg(F.sum("n").alias("n_cells"))
    return boxes.select(key).join(sums, key, "left").select(key, F.coalesce("n_cells", F.lit(0)).alias("n_cells"))


def cells_in_boxes(points: DataFrame, boxes: DataFrame, key: str = "roi_id") -> DataFrame:
    """All columns of the cells of every box, tagged with the box key; a cell may lie in several boxes."""
    placed = _with_tile(points, boxes)
    tiles = _tiles(boxes, key).drop("inner", "sx", "sy")
    return placed.join(tiles, ["tx", "ty"]).where(_inside()).select(key, *points.columns)


def candidate_windows(
    points: DataFrame, sample: str = "sample", min_cells: int = 1000, max_cells: int = 5000, target_cells: int = 2500,
    fractions: tuple[float, ...] = WINDOW_FRACTIONS, step_fraction: float = STEP_FRACTION, max_candidates: int = 300,
) -> DataFrame:
    """Ranked windows whose cell count lies in [min, max]; score = -|n - target| + 100 * fraction."""
    if max_candidates > MAX_RANKED:
        raise ValueError(f"max_candidates is at most {MAX_RANKED}")
    windows = sliding_windows(points, fractions, step_fraction)
    counted = windows.join(count_in_boxes(points, windows), "window_id").where(
        F.col("n_cells").between(min_cells, max_cells)
    )
    numbered = counted.withColumn("candidate", F.row_number().over(Window.orderBy("window_id")))
    scored = numbered.select(
        F.concat(F.lit(f"{sample}_cand_"), F.lpad(F.col("candidate").cast("string"), 4, "0")).alias("candidate_id"),
        "candidate", "x_min", "x_max", "y_min", "y_max",
        ((F.col("x_min") + F.col("x_max")) / 2).alias("x_center"), ((F.col("y_min") + F.col("y_max")) / 2).alias("y_center"),
        "window_frac", "n_cells",
        (F.col("window_frac") * 100 - F.abs(F.col("n_cells") - target_cells)).alias("score"),
    )
    return scored.orderBy(F.desc("score"), F.desc("n_cells"), "candidate").limit(max_candidates)


def conflicts(ranked: DataFrame, min_distance: float = 250.0, max_iou: float = 0.4) -> DataFrame:
    """Pairs of candidates that may not both be accepted, from at most ``max_candidates`` ranked rows."""
    sides = ["candidate", "x_min", "x_max", "y_min", "y_max", "x_center", "y_center"]
    listed = ranked.agg(F.collect_list(F.struct(*[F.col(c).alias(f"b_{c}") for c in sides]))).scalar()
    pairs = ranked.select(*[F.col(c).alias(f"a_{c}") for c in sides], F.inline_outer(listed))
    near = F.hypot(F.col("a_x_center") - F.col("b_x_center"), F.col("a_y_center") - F.col("b_y_center")) < min_distance
    overlap = box_iou(box("a_"), box("b_"))
    return pairs.where((F.col("a_candidate") < F.col("b_candidate")) & (near | (overlap > max_iou))).select(
        "a_candidate", "b_candidate", overlap.alias("iou")
    )


def pick_regions(
    ranked: DataFrame, n_rois: int = 5, max_attempts: int = 120, min_distance: float = 250.0, max_iou: float = 0.4,
    sample: str = "sample",
) -> DataFrame:
    """Greedy choice in rank order; a window too close to, or overlapping, an accepted one is passed over.

    Passed-over windows count as attempts. Runs over the ranked list, whose length is a checked parameter.
    """
    rows = ranked.collect()
    chosen: list = []
    for row in rows[:max_attempts]:
        if len(chosen) >= n_rois:
            break
        if all(_far_apart(row, other, min_distance, max_iou) for other in chosen):
            chosen.append(row)
    spark = ranked.sparkSession
    keep = [(f"{sample}_roi_{i:02d}", *row) for i, row in enumerate(chosen, 1)]
    return spark.createDataFrame(keep, "roi_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema))


def _far_apart(a, b, min_distance: float, max_iou: float) -> bool:
    if math.hypot(a["x_center"] - b["x_center"], a["y_center"] - b["y_center"]) < min_distance:
        return False
    w = min(a["x_max"], b["x_max"]) - max(a["x_min"], b["x_min"])
    h = min(a["y_max"], b["y_max"]) - max(a["y_min"], b["y_min"])
    if w <= 0 or h <= 0:
        return True
    areas = [(r["x_max"] - r["x_min"]) * (r["y_max"] - r["y_min"]) for r in (a, b)]
    return w * h / (sum(areas) - w * h) <= max_iou


def export_regions(
    points: DataFrame, rois: DataFrame, folder: str, metadata: dict[str, str] | None = None, min_cells: int = 1,
    max_cells: int | None = None, overwrite: bool = False,
) -> DataFrame:
    """Write the cells of all regions in one pass, one partition folder per region; return the manifest of those written.

    A region is passed over if it has fewer than ``min_cells`` or more than ``max_cells`` cells, or if its folder exists and
    ``overwrite`` is off. The table ``attempts`` has every region with ``export_ok``, ``export_message`` and ``export_n_cells``. Metadata is
    added to the cells only where they lack the column.
    """
    spark = points.sparkSession
    cells = cells_in_boxes(points, rois)
    for name, value in (metadata or {}).items():
        if name not in cells.columns:
            cells = cells.withColumn(name, F.lit(value))
    path = f"{folder}/rois"
    there = [f.removeprefix("roi_id=") for f in tables(spark, path)] if exists(spark, path) else []
    n = F.coalesce("_n", F.lit(0))
    in_range = n >= min_cells if max_cells is None else n.between(min_cells, max_cells)
    blocked = F.lit(False) if overwrite or not there else F.col("roi_id").isin(there)
    place = F.concat(F.lit(f"{path}/roi_id="), "roi_id")
    message = F.when(~in_range, F.concat(F.lit("ROI cell count out of range: "), n.cast("string"))).when(
        blocked, F.concat(F.lit("Output exists: "), place)
    ).otherwise("ok")
    counts = cells.groupBy("roi_id").agg(F.count("*").alias("_n"))
    extra = {k: F.lit(v) for k, v in (metadata or {}).items() if k not in rois.columns}
    attempts = store(rois.join(counts, "roi_id", "left").select(
        *rois.columns, place.alias("roi_path"), (message == "ok").alias("export_ok"), message.alias("export_message"),
        n.alias("export_n_cells"), *(v.alias(k) for k, v in extra.items()),
    ))
    accepted = attempts.where("export_ok")
    update_partitions(cells.join(accepted.select("roi_id"), "roi_id", "left_semi"), folder, "rois", ["roi_id"])
    manifest = accepted.select(
        F.col("roi_id").alias("sample"), F.col("roi_path").alias("path"),
        *[F.lit(v).alias(k) for k, v in (metadata or {}).items()], "roi_id", F.col("export_n_cells").alias("n_cells"),
    )
    attempts.write.mode("overwrite").csv(f"{folder}/attempts", header=True)
    manifest.write.mode("overwrite").csv(f"{folder}/manifest", header=True)
    return manifest
