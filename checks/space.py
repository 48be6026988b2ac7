"""Spatial graphs, neighbourhood composition and regions of interest."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellframe.operators import neighborhood, qc, roi, spatial
from cellframe.session import scratch_root
from checks import tables as t
from checks.registry import i64, query, r6

POINTS = """
pts AS (SELECT o_orderkey AS cell_id, o_totalprice AS x, datediff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS y,
  o_orderpriority AS library, o_orderstatus AS cell_type FROM orders)"""

KNN = """
pairs AS (SELECT a.cell_id AS src, b.cell_id AS dst, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d
  FROM pts a JOIN pts b ON a.library = b.library AND a.cell_id <> b.cell_id),
knn AS (SELECT src, dst, d FROM pairs QUALIFY row_number() OVER (PARTITION BY src ORDER BY d, dst) <= 6)"""


@query("spatial_knn", "WITH" + POINTS + "," + KNN + "SELECT src, dst, round(d, 6) AS distance, 1.0::DOUBLE AS weight FROM knn")
def spatial_knn(spark, sf):
    return spatial.knn_graph(t.points(spark, sf), 6, "library").select("src", "dst", r6("distance"), "weight")


@query("spatial_radius", "WITH" + POINTS + """
SELECT a.cell_id AS src, b.cell_id AS dst, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance
FROM pts a JOIN pts b ON a.cell_id <> b.cell_id AND abs(a.x - b.x) <= 400 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 400""")
def spatial_radius(spark, sf):
    packed = spatial.packed_radius_graph(t.points(spark, sf), 400.0)
    return spatial.unpack_edges(packed.select("src", "dst", r6("distance")))


@query("spatial_radius_interval", "WITH" + POINTS + """
SELECT a.cell_id AS src, b.cell_id AS dst, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS distance
FROM pts a JOIN pts b ON a.library = b.library AND a.cell_id <> b.cell_id AND abs(a.x - b.x) <= 900
WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) BETWEEN 300 AND 900""")
def spatial_radius_interval(spark, sf):
    packed = spatial.packed_radius_graph(t.points(spark, sf), (300.0, 900.0), "library")
    return spatial.unpack_edges(packed.select("src", "dst", r6("distance")))


LINE = """
pts AS (SELECT o_orderkey AS cell_id, (o_orderkey % 100)::DOUBLE AS x, (o_orderkey // 100)::DOUBLE AS y, 'all' AS library FROM orders)"""


@query("spatial_lattice", "WITH" + LINE + """,
pairs AS (SELECT a.cell_id AS src, b.cell_id AS dst, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d
  FROM pts a JOIN pts b ON b.cell_id <> a.cell_id AND abs(a.x - b.x) <= 4 AND abs(a.y - b.y) <= 4),
knn AS (SELECT src, dst, d FROM pairs QUALIFY row_number() OVER (PARTITION BY src ORDER BY d, dst) <= 6)
SELECT src, dst, round(d, 6) AS distance FROM knn WHERE d < 1.3 * (SELECT median(d) FROM knn)""")
def spatial_lattice(spark, sf):
    grid = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell_id"), (F.col("o_orderkey") % 100).cast("double").alias("x"),
        F.floor(F.col("o_orderkey") / 100).cast("double").alias("y"),
    )
    return spatial.neighbor_graph(grid, 6, coord_type="grid").select("src", "dst", r6("distance"))


RADIUS = """
edges AS (SELECT a.cell_id AS src, b.cell_id AS dst, 1.0::DOUBLE AS w FROM pts a JOIN pts b ON a.library = b.library AND a.cell_id <> b.cell_id
  AND abs(a.x - b.x) <= 900 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 900)"""


@query("graph_spectral", "WITH" + POINTS + "," + RADIUS + """,
deg AS (SELECT dst AS c, sum(w) AS d FROM edges GROUP BY 1)
SELECT src, dst, round(w / sqrt(a.d * b.d), 6) AS weight FROM edges JOIN deg a ON src = a.c JOIN deg b ON dst = b.c""")
def graph_spectral(spark, sf):
    return spatial.neighbor_graph(t.points(spark, sf), radius=900.0, library="library", transform="spectral").select("src", "dst", r6("weight"))


@query("graph_cosine", "WITH" + POINTS + "," + RADIUS + """,
nrm AS (SELECT src, sqrt(sum(w * w)) AS n FROM edges GROUP BY 1),
s AS (SELECT src, dst, w / n AS w FROM edges JOIN nrm USING (src))
SELECT a.src, b.src AS dst, round(sum(a.w * b.w), 6) AS weight FROM s a JOIN s b ON a.dst = b.dst GROUP BY 1, 2""")
def graph_cosine(spark, sf):
    packed = spatial.packed_cosine_graph(t.points(spark, sf), 900.0, "library")
    return spatial.unpack_cosine(packed.select("src", "dst", r6("weight")))


@query("polygon_centroids", """
WITH v AS (SELECT o_custkey AS cell_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n,
  o_totalprice / 1000 AS r, o_custkey::DOUBLE AS c FROM orders),
p AS (SELECT cell_id, i, c + r * cos(6.283185307179586 * i / n) AS x, c + r * sin(6.283185307179586 * i / n) AS y FROM v),
q AS (SELECT *, first(x) OVER w AS x0, first(y) OVER w AS y0 FROM p WINDOW w AS (PARTITION BY cell_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
z AS (SELECT cell_id, i, x0, y0, x - x0 AS x, y - y0 AS y, coalesce(lead(x - x0) OVER (PARTITION BY cell_id ORDER BY i), 0) AS nx,
  coalesce(lead(y - y0) OVER (PARTITION BY cell_id ORDER BY i), 0) AS ny FROM q),
s AS (SELECT cell_id, any_value(x0) AS x0, any_value(y0) AS y0, sum(x * ny - nx * y) AS a, sum((x + nx) * (x * ny - nx * y)) AS cx,
  sum((y + ny) * (x * ny - nx * y)) AS cy, count(*) AS n FROM z GROUP BY 1)
SELECT cell_id, round(x0 + cx / (3 * a), 4) AS x, round(y0 + cy / (3 * a), 4) AS y FROM s WHERE n >= 3 AND abs(a) > 1""")
def polygon_centroids(spark, sf):
    """Polygons with one vertex per order of a customer, on a circle of varying radius."""
    from pyspark.sql import Window

    rank = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    v = t.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("cell_id"), F.row_number().over(rank).alias("i"),
        F.count("*").over(Window.partitionBy("o_custkey")).alias("n"), (F.col("o_totalprice") / 1000).alias("r"),
    )
    angle = F.lit(6.283185307179586) * F.col("i") / F.col("n")
    vertices = v.select(
        "cell_id", F.col("i").alias("vertex_ord"), (F.col("cell_id") + F.col("r") * F.cos(angle)).alias("x"),
        (F.col("cell_id") + F.col("r") * F.sin(angle)).alias("y"),
    )
    nxt = Window.partitionBy("cell_id").orderBy("vertex_ord")
    whole = nxt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rel = vertices.select("cell_id", "vertex_ord", *[(F.col(c) - F.first(c).over(whole)).alias(c) for c in "xy"])
    lead = {c: F.coalesce(F.lead(c).over(nxt), F.lit(0.0)) for c in "xy"}
    area = rel.withColumn("a", F.col("x") * lead["y"] - lead["x"] * F.col("y")).groupBy("cell_id").agg(
        F.sum("a").alias("a"), F.count("*").alias("n")
    ).where("n >= 3 and abs(a) > 1")
    out = spatial.centroids(vertices).join(area, "cell_id", "left_semi")
    return out.select("cell_id", r6("x", digits=4), r6("y", digits=4))


@query("coordinate_fallback", """
SELECT o_orderkey AS cell_id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_orderstatus = 'O' THEN -o_totalprice END AS x,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN o_custkey::DOUBLE END AS y FROM orders""")
def coordinate_fallback(spark, sf):
    status = F.col("o_orderstatus")
    cells = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("cell_id"), F.when(status == "F", F.col("o_totalprice")).alias("x"),
        F.when(status == "F", F.col("o_custkey").cast("double")).alias("y"),
        F.when(status == "O", -F.col("o_totalprice")).alias("x_spatial"),
        F.when(status == "O", F.col("o_custkey").cast("double")).alias("y_spatial"),
    )
    return spatial.with_coordinates(cells)


# -- neighbourhoods ------------------------------------------------------------------------------

COMPOSED = """
both_ AS (SELECT src, dst FROM edges UNION SELECT cell_id, cell_id FROM pts),
cnt AS (SELECT src AS cell_id, cell_type, count(*)::DOUBLE AS n FROM both_ JOIN pts ON dst = cell_id GROUP BY 1, 2),
comp AS (SELECT cell_id, cell_type, n / sum(n) OVER (PARTITION BY cell_id) AS share, sum(n) OVER (PARTITION BY cell_id) AS neighbor_count FROM cnt)"""


def composed(spark, sf):
    return neighborhood.radius_composition(t.points(spark, sf), 900.0, "library")


@query("neighborhood_composition", "WITH" + POINTS + "," + RADIUS + "," + COMPOSED + """
SELECT cell_id, cell_type, round(share, 6) AS share, neighbor_count FROM comp""")
def neighborhood_composition(spark, sf):
    return composed(spark, sf).select("cell_id", "cell_type", r6("share"), "neighbor_count")


@query("neighborhood_counts_without_self", "WITH" + POINTS + "," + RADIUS + """
SELECT src AS cell_id, cell_type, count(*)::DOUBLE AS share, (sum(count(*)) OVER (PARTITION BY src))::DOUBLE AS neighbor_count
FROM edges JOIN pts ON dst = cell_id WHERE cell_type <> 'P' GROUP BY 1, 2""")
def neighborhood_counts_without_self(spark, sf):
    """Cells with status P are untyped here."""
    cells = t.points(spark, sf).withColumn("cell_type", F.when(F.col("cell_type") != "P", F.col("cell_type")))
    return neighborhood.radius_composition(cells, 900.0, "library", include_self=False, normalize=False)


@query("neighborhood_vectors", "WITH" + POINTS + "," + RADIUS + "," + COMPOSED + """
SELECT p.cell_id, coalesce(max(share) FILTER (c.cell_type = 'F'), 0) AS f, coalesce(max(share) FILTER (c.cell_type = 'O'), 0) AS o,
  coalesce(max(share) FILTER (c.cell_type = 'P'), 0) AS p FROM pts p LEFT JOIN comp c USING (cell_id) GROUP BY 1""")
def neighborhood_vectors(spark, sf):
    points = t.points(spark, sf)
    names = neighborhood.categories(points)
    out = neighborhood.radius_vectors(points, 900.0, names, "library")
    return out.select("cell_id", *[F.col("vector")[i].alias(n.lower()) for i, n in enumerate(names)])


@query("cluster_composition", "WITH" + POINTS + "," + RADIUS + "," + COMPOSED + """,
n AS (SELECT library AS cluster, count(*) AS n FROM pts GROUP BY 1)
SELECT n.cluster, ty.cell_type, round(coalesce(sum(share), 0) / any_value(n.n), 9) AS mean_share
FROM n CROSS JOIN (SELECT DISTINCT cell_type FROM comp) ty LEFT JOIN pts p ON n.cluster = p.library
  LEFT JOIN comp c ON c.cell_id = p.cell_id AND c.cell_type = ty.cell_type GROUP BY 1, 2""")
def cluster_composition(spark, sf):
    clusters = t.points(spark, sf).select("cell_id", F.col("library").alias("cluster"))
    return neighborhood.cluster_composition(composed(spark, sf), clusters).select("cluster", "cell_type", r6("mean_share", digits=9))


# -- regions of interest -------------------------------------------------------------------------

@query("bounding_box", "WITH" + POINTS + """
SELECT cell_id, x, y FROM pts WHERE x BETWEEN 100000 AND 200000 AND y BETWEEN 9500 AND 10200""")
def bounding_box(spark, sf):
    return qc.in_box(t.points(spark, sf), 100000, 200000, 9500, 10200).select("cell_id", "x", "y")


WINDOWS = """
ext AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pts),
fr AS (SELECT * FROM (VALUES (0, 0.15::DOUBLE), (1, 0.2), (2, 0.25), (3, 0.3), (4, 0.35), (5, 0.4)) v(f, frac)),
sz AS (SELECT *, (x1 - x0) * frac AS w, (y1 - y0) * frac AS h, (x1 - x0) * frac * 0.35::DOUBLE AS dx, (y1 - y0) * frac * 0.35::DOUBLE AS dy FROM ext, fr),
ii AS (SELECT *, unnest(range(0, ceil((x1 - w + dx - x0) / dx)::BIGINT)) AS i FROM sz),
jj AS (SELECT *, unnest(range(0, ceil((y1 - h + dy - y0) / dy)::BIGINT)) AS j FROM ii),
win AS (SELECT row_number() OVER (ORDER BY f, i, j) AS window_id, frac, x0 + i * dx AS x_min, x0 + i * dx + w AS x_max,
  y0 + j * dy AS y_min, y0 + j * dy + h AS y_max FROM jj)"""

CANDIDATES = """
cn AS (SELECT window_id, count(*) AS n FROM win JOIN pts ON x BETWEEN x_min AND x_max AND y BETWEEN y_min AND y_max GROUP BY 1),
ok AS (SELECT *, row_number() OVER (ORDER BY window_id) AS k, (x_min + x_max) / 2 AS xc, (y_min + y_max) / 2 AS yc,
  frac * 100 - abs(n - (SELECT count(*) * 0.06::DOUBLE FROM pts)) AS score
  FROM win JOIN cn USING (window_id) WHERE n BETWEEN (SELECT floor(count(*) * 0.02::DOUBLE) FROM pts) AND (SELECT floor(count(*) * 0.1::DOUBLE) FROM pts)),
top AS (SELECT * FROM ok ORDER BY score DESC, n DESC, k LIMIT 300)"""


@query("sliding_windows", "WITH" + POINTS + "," + WINDOWS + """
SELECT window_id, frac AS window_frac, round(x_min, 8) AS x_min, round(x_max, 8) AS x_max, round(y_min, 8) AS y_min, round(y_max, 8) AS y_max FROM win""")
def sliding_windows(spark, sf):
    out = roi.sliding_windows(t.points(spark, sf))
    return out.select(i64("window_id"), "window_frac", *[r6(c, digits=8) for c in ("x_min", "x_max", "y_min", "y_max")])


@query("cells_per_window", "WITH" + POINTS + "," + WINDOWS + """
SELECT window_id, count(cell_id) AS n_cells FROM win LEFT JOIN pts ON x BETWEEN x_min AND x_max AND y BETWEEN y_min AND y_max GROUP BY 1""")
def cells_per_window(spark, sf):
    points = t.points(spark, sf)
    return roi.count_in_boxes(points, roi.sliding_windows(points)).select(i64("window_id"), "n_cells")


def candidates(spark, sf):
    """Counts scale with the data: windows hold 2 to 10 percent of the cells, ideally 6."""
    points = t.points(spark, sf)
    n = points.count()
    return roi.candidate_windows(points, "orders", int(n * 0.02), int(n * 0.1), n * 0.06)


@query("candidate_windows", "WITH" + POINTS + "," + WINDOWS + "," + CANDIDATES + """
SELECT 'orders_cand_' || lpad(k::VARCHAR, 4, '0') AS candidate_id, round(xc, 8) AS x_center, round(yc, 8) AS y_center, frac AS window_frac,
  n AS n_cells, round(score, 6) AS score FROM top""")
def candidate_windows(spark, sf):
    return candidates(spark, sf).select(
        "candidate_id", r6("x_center", digits=8), r6("y_center", digits=8), "window_frac", "n_cells", r6("score")
    )


@query("window_conflicts", "WITH" + POINTS + "," + WINDOWS + "," + CANDIDATES + """,
ov AS (SELECT a.k AS a_candidate, b.k AS b_candidate, a.xc - b.xc AS dx, a.yc - b.yc AS dy,
  least(a.x_max, b.x_max) - greatest(a.x_min, b.x_min) AS w, least(a.y_max, b.y_max) - greatest(a.y_min, b.y_min) AS h,
  (a.x_max - a.x_min) * (a.y_max - a.y_min) + (b.x_max - b.x_min) * (b.y_max - b.y_min) AS area FROM top a JOIN top b ON a.k < b.k),
io AS (SELECT *, CASE WHEN w <= 0 OR h <= 0 THEN 0 ELSE w * h / (area - w * h) END AS iou FROM ov)
SELECT a_candidate, b_candidate, round(iou, 6) AS iou FROM io WHERE sqrt(dx * dx + dy * dy) < 250 OR iou > 0.4""")
def window_conflicts(spark, sf):
    return roi.conflicts(candidates(spark, sf)).select(i64("a_candidate"), i64("b_candidate"), r6("iou"))


@query("picked_regions")
def picked_regions(spark, sf):
    """The greedy pick is sequential; tests check it against brute force."""
    return roi.pick_regions(candidates(spark, sf), sample="orders").drop("candidate")


@query("region_export", "WITH" + POINTS + """,
box AS (SELECT n_nationkey AS k, n_nationkey * 10000.0 AS x_min, n_nationkey * 10000.0 + 60000 AS x_max, 9000.0 + n_nationkey * 20 AS y_min,
  9600.0 + n_nationkey * 20 AS y_max FROM nation)
SELECT 'roi_' || k AS sample, 'roi_' || k AS roi_id, 'all' AS status, count(*) AS n_cells
FROM box JOIN pts ON x BETWEEN x_min AND x_max AND y BETWEEN y_min AND y_max GROUP BY k""")
def region_export(spark, sf):
    k = F.col("n_nationkey")
    boxes = t.table(spark, sf, "nation").select(
        F.concat(F.lit("roi_"), k.cast("string")).alias("roi_id"), (k * 10000.0).alias("x_min"), (k * 10000.0 + 60000).alias("x_max"),
        (9000.0 + k * 20).alias("y_min"), (9600.0 + k * 20).alias("y_max"),
    )
    folder = f"{scratch_root(spark)}/cellframe-{spark.sparkContext.applicationId}/regions"
    return roi.export_regions(t.points(spark, sf), boxes, folder, {"status": "all"}, overwrite=True).drop("path")
