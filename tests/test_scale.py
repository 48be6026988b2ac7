"""Hot keys, many labels and wide models: forms that a plain join or a driver-held list could not take, against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.operators import communities, embed, enrich, nearest, neighborhood, spatial, vectors
from cellframe.sources import dataset as ds


def test_radius_graph_of_a_crowded_tile(spark):
    rng = np.random.default_rng(1)
    xy = np.concatenate([rng.normal(0, 0.4, (700, 2)), rng.uniform(-6, 6, (150, 2)), [[0.0, 0.0]] * 3, [[3.0, 4.0], [0.0, 5.0]]])
    lib = ["a" if i % 5 else "b" for i in range(len(xy))]
    points = spark.createDataFrame([(f"c{i}", float(x), float(y), l) for i, ((x, y), l) in enumerate(zip(xy, lib))], "cell_id string, x double, y double, lib string")
    d = np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1))
    same = np.array(lib)[:, None] == np.array(lib)[None]
    near = same & (d >= 0.5) & (d <= 1.5)
    np.fill_diagonal(near, False)
    got = spatial.radius_graph(points, (0.5, 1.5), "lib").select("src", "dst").collect()
    assert sorted((int(r["src"][1:]), int(r["dst"][1:])) for r in got) == sorted(map(tuple, np.argwhere(near).tolist()))


def test_a_crowded_tile_is_cut_into_chunks(spark):
    tiled = spark.range(500).selectExpr("id AS cell_id", "'' AS lib", "0.0 AS x", "0.0 AS y", "0L AS tx", "0L AS ty")
    pairs = spatial._tile_pairs(tiled, crowd=50).select("src", "dst")
    assert pairs.count() == pairs.distinct().count() == 500 * 499 // 2


def test_cosine_of_a_hub(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 1000, float(rng.uniform(0.5, 2))) for i in range(300)] + [(i, int(j), 1.0) for i in range(300) for j in rng.choice(40, 2, replace=False)]
    edges = spark.createDataFrame([(s, d, w, 1.0) for s, d, w in rows], "src int, dst int, weight double, distance double")
    a = np.zeros((300, 1001))
    for s, d, w in rows:
        a[s, d] = w
    a /= np.linalg.norm(a, axis=1)[:, None]
    want = a @ a.T
    got = {(r["src"], r["dst"]): r["weight"] for r in spatial.transform_graph(edges, "cosine").collect()}
    assert len(got) == int((want > 0).sum())
    assert all(w == pytest.approx(want[k], abs=1e-12) for k, w in got.items())


def test_a_hub_is_spread_over_its_chunks(spark):
    rows = spark.range(100_000).selectExpr("id AS src", "7 AS dst", "1.0D AS w")
    left, right = spatial._row_pairs(rows, crowd=5000)
    sizes = left.groupBy("dst", "lo", "hi").count().join(right.groupBy("dst", "lo", "hi").agg(F.count("*").alias("m")), ["dst", "lo", "hi"])
    rows = sizes.collect()
    assert len(rows) == 20 * 21 // 2 and max(max(r["count"], r["m"]) for r in rows) < 6000
    small, other = spatial._row_pairs(spark.range(60).selectExpr("id AS src", "7 AS dst", "1.0D AS w"), crowd=9)
    met = small.join(other, ["dst", "lo", "hi"]).where("lo < hi OR src <= other").selectExpr("least(src, other) a", "greatest(src, other) b")
    assert met.count() == met.distinct().count() == 60 * 61 // 2


def brute_silhouette(x, labels, weight=None):
    d = vectors.exact_distances(x, x)
    out = []
    for i in range(len(x)):
        own = (labels == labels[i]) & (np.arange(len(x)) != i)
        others = [d[i, labels == c].mean() for c in set(labels.tolist()) - {labels[i]}]
        a, b = (d[i, own].mean() if own.any() else None), min(others)
        out.append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("block", [2048, 40])
def test_silhouette_of_many_labels(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(rng.normal(0, 5, 3), 0.5, (int(n), 3)) for n in rng.integers(1, 6, 120)] + [rng.normal(9, 0.3, (90, 3))])
    x[5] = x[6]
    labels = np.array([f"L{i}" for i in np.repeat(np.arange(121), [*rng.integers(0, 1, 0), *np.diff(np.linspace(0, len(x), 122).astype(int))])])
    table = spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, labels.tolist()))], "cell_id int, vector array<double>, label string")
    assert vectors.silhouette(table).first()[0] == pytest.approx(brute_silhouette(x, labels))


def test_silhouette_of_ten_thousand_labels(spark):
    n = 10_000
    x = np.stack([np.repeat(np.arange(n) * 10.0, 2) + np.tile([0.0, 1.0], n), np.zeros(2 * n)], 1)
    table = spark.createDataFrame([(i, v.tolist(), i // 2) for i, v in enumerate(x)], "cell_id int, vector array<double>, label int")
    # the mean distance to a neighbouring pair is 10; the first and last pair have a neighbour on one side only
    got = vectors.silhouette(table).first()[0]
    first, last = (9.5 - 1) / 9.5, (10.5 - 1) / 10.5  # a pair's outer and inner point see a neighbour at 10.5 and 9.5
    assert got == pytest.approx(((2 * n - 2) * first + 2 * last) / (2 * n), rel=1e-6)


def test_mlm_of_a_thousand_sources(spark):
    rng = np.random.default_rng(4)
    n_genes, n_sources = 2500, 1000
    net = [(f"s{j:04d}", f"g{g}", float(rng.uniform(0.5, 2))) for j in range(n_sources) for g in rng.choice(n_genes, 4, replace=False)]
    y = (rng.random((3, n_genes)) < 0.3) * rng.uniform(0.1, 3, (3, n_genes))
    expr = spark.createDataFrame([(f"c{i}", f"g{g}", float(y[i, g])) for i in range(3) for g in np.flatnonzero(y[i])], "cell_id string, gene_id string, lognorm double")
    cells = spark.createDataFrame([(f"c{i}",) for i in range(4)], "cell_id string")
    genes = spark.createDataFrame([(f"g{g}",) for g in range(n_genes)], "gene_id string")
    table = spark.createDataFrame(net, "source string, target string, weight double")
    got = {(r["cell_id"], r["source"]): r["score"] for r in enrich.mlm_scores(expr, cells, genes, table).collect()}
    a = np.zeros((n_genes, n_sources + 1))
    a[:, 0] = 1
    for s, t, w in net:
        a[int(t[1:]), int(s[1:]) + 1] = w
    inverse = np.linalg.inv(a.T @ a)
    for i in range(3):
        beta = inverse @ (a.T @ y[i])
        rss = ((y[i] - a @ beta) ** 2).sum()
        want = beta / np.sqrt(np.diag(inverse) * rss / (n_genes - n_sources - 1))
        assert [got[f"c{i}", f"s{j:04d}"] for j in range(n_sources)] == pytest.approx(want[1:].tolist(), rel=1e-6)
    assert len(got) == 4 * n_sources and got["c3", "s0000"] is None
    with pytest.raises(ValueError, match="sources take"):
        enrich.mlm_scores(expr, cells, genes, table, max_bytes=1000)


def test_randomized_components_match_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 5)) @ np.diag([9, 6, 4, 2.5, 1.5]) @ rng.normal(size=(5, 300)) + rng.normal(0, 0.01, (150, 300))
    x[:, 250:] = 0
    x[7] = 0
    expr = spark.createDataFrame([(i, f"g{j:03d}", float(x[i, j])) for i in range(150) for j in np.flatnonzero(x[i])], "cell_id int, gene_id string, lognorm double").repartition(5)
    cells = spark.range(150).select(F.col("id").cast("int").alias("cell_id"))
    genes = spark.createDataFrame([(f"g{j:03d}",) for j in range(300)], "gene_id string")
    out = embed.pca(expr, cells, genes, 5, solver="randomized", tol=1e-12)
    u, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    got = np.array([r["vector"] for r in out["embedding"].orderBy("cell_id").collect()])
    sign = np.sign(vt[np.arange(5), np.abs(vt[:5]).argmax(axis=1)])
    assert np.allclose(got, u[:, :5] * s[:5] * sign, atol=1e-4)
    assert [r["ratio"] for r in out["variance"].orderBy("component").collect()] == pytest.approx((s**2 / (s**2).sum())[:5].tolist(), rel=1e-8)
    loadings = {(r["gene_id"], r["component"]): r["loading"] for r in out["loadings"].collect()}
    assert len(loadings) == 300 * 5 and loadings["g003", 2] == pytest.approx(vt[1, 3] * sign[1], abs=1e-5)
    whole = embed.pca(expr, cells, genes, 300, solver="randomized")
    assert sum(r["ratio"] for r in whole["variance"].collect()) == pytest.approx(1.0)


def test_components_of_fifty_thousand_genes(spark):
    n = 50_000
    expr = spark.range(40).select((F.col("id") % 8).cast("int").alias("_kind"), F.col("id").cast("int").alias("cell_id")).select(
        "cell_id", F.explode(F.sequence(F.col("_kind") * 6250, F.col("_kind") * 6250 + 499)).alias("gene_id"), F.lit(1.0).alias("lognorm"))
    genes = spark.range(n).select(F.col("id").cast("int").alias("gene_id"))
    cells = spark.range(40).select(F.col("id").cast("int").alias("cell_id"))
    out = embed.pca(expr, cells, genes, 7)
    # eight kinds of cells with disjoint genes: seven equal components hold all the variance
    assert [r["ratio"] for r in out["variance"].collect()] == pytest.approx([1 / 7] * 7)
    assert out["loadings"].count() == 7 * n
    with pytest.raises(ValueError):
        embed.pca(expr, cells, genes, 7, solver="covariance")


def test_parts_of_a_community_are_taken_apart(spark):
    """Two cliques and a bridge that greedy moves alone may leave in one community; every community is connected."""
    rng = np.random.default_rng(8)
    pairs = {(a, b) for base in (0, 20, 40) for a in range(base, base + 12) for b in range(base, a) if rng.random() < 0.8}
    pairs |= {(20, 0), (40, 21), (1, 41), (32, 3), (33, 22), (34, 44), (32, 33), (33, 34)}
    edges = [(a, b, 1.0) for a, b in pairs] + [(b, a, 1.0) for a, b in pairs]
    graph = spark.createDataFrame(edges, "src int, dst int, weight double")
    nodes = graph.select(F.col("src").alias("cell_id")).distinct()
    one = communities.communities(graph, nodes, [1.0], n_iterations=1)
    got = {r["cell_id"]: r["label"] for r in one.collect()}
    for label in set(got.values()):
        own = {c for c, v in got.items() if v == label}
        seen, todo = set(), [min(own)]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += [b for a, b, _ in edges if a == at and b in own]
        assert seen == own
    best = np.array([got.get(base + k) == got[base] for base in (0, 20, 40) for k in range(12)])
    assert best.all() and len({got[0], got[20], got[40]}) == 3
    again = {r["cell_id"]: r["label"] for r in communities.communities(graph.repartition(7), nodes.repartition(3), [1.0], n_iterations=1).collect()}
    assert again == got


def rows_of(spark, root):
    return sorted(tuple(r) for r in ds.read_table(spark, root, "t").select("k", "v").collect())


def test_partitions_are_replaced_together_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "data")
    make = lambda rows: spark.createDataFrame(rows, "k string, v int")
    ds.update_partitions(make([("a", 1), ("b", 2), ("c d", 3)]), root, "t", ["k"])
    assert rows_of(spark, root) == [("a", 1), ("b", 2), ("c d", 3)]
    broken = make([("a", 10), ("b", 20)]).withColumn("v", F.when(F.col("k") == "b", F.raise_error("no")).otherwise(F.col("v")))
    with pytest.raises(Exception):
        ds.update_partitions(broken, root, "t", ["k"])
    assert rows_of(spark, root) == [("a", 1), ("b", 2), ("c d", 3)]
    ds.update_partitions(make([("b", 20), ("c d", 30), ("e", 5)]), root, "t", ["k"])
    assert rows_of(spark, root) == [("a", 1), ("b", 20), ("c d", 30), ("e", 5)]


def test_a_committed_replacement_is_completed_by_the_next_reader(spark, tmp_path):
    root = str(tmp_path / "data")
    make = lambda rows: spark.createDataFrame(rows, "k string, v int")
    ds.update_partitions(make([("a", 1), ("b", 2)]), root, "t", ["k"])
    # the writer died after the record was written, and after it had moved one of two partitions
    make([("a", 10), ("b", 20)]).write.partitionBy("k").parquet(f"{root}/_staged_t_x")
    (tmp_path / "data/t/k=a").rename(tmp_path / "data/gone")
    (tmp_path / "data/_staged_t_x/k=a").rename(tmp_path / "data/t/k=a")
    plan = {"staged": "_staged_t_x", "aside": "_replaced_t_x", "partitions": ["k=a", "k=b"]}
    (tmp_path / "data/_commit_t.json").write_text(json.dumps(plan))
    assert rows_of(spark, root) == [("a", 10), ("b", 20)]
    assert not (tmp_path / "data/_commit_t.json").exists() and not (tmp_path / "data/_staged_t_x").exists()


def test_many_samples_are_one_read(spark, tmp_path):
    rows = []
    for i in range(40):
        root = str(tmp_path / f"s {i}.dataset")
        cells = spark.createDataFrame([(k, float(i)) for k in range(2)], "cell_id int, x double")
        if i % 2:
            cells = cells.withColumn("extra", F.lit(i))
        if i < 4:
            ds.write_dataset({
                "cells": cells, "genes": spark.createDataFrame([(f"g{i % 3}",)], "gene_id string"),
                "expr": spark.createDataFrame([(0, f"g{i % 3}", float(i))], "cell_id int, gene_id string, value double"),
            }, root)
        rows.append((f"n{i}", str(tmp_path / f"s {i % 4}.dataset"), i))
    manifest = spark.createDataFrame(rows, "sample string, path string, ordinal long").withColumn("site", F.col("ordinal") % 2)
    parts = ds.load_samples(spark, manifest)
    got = sorted((r["sample"], r["cell_id"], r["x"], r["extra"], r["site"]) for r in parts["cells"].collect() if r["extra"] is not None)
    assert got == sorted((f"n{i}", f"n{i}-{k}", float(i % 4), i % 4, i % 2) for i in range(1, 40, 2) for k in range(2))
    assert parts["cells"].count() == 80 and parts["expr"].count() == 40 and parts["genes"].count() == 3
    text = parts["cells"]._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") <= 3  # one read of the cells, whatever the number of samples


@pytest.mark.parametrize("radius,include_self,normalize", [(1.5, True, True), (1.5, False, False), ((0.5, 1.5), True, False), ((0.5, 1.5), False, True)])
def test_radius_composition_is_that_of_the_radius_graph(spark, monkeypatch, radius, include_self, normalize):
    monkeypatch.setattr(spatial, "_BLOCK", 40)
    rng = np.random.default_rng(3)
    xy = [tuple(map(float, p)) for p in np.concatenate([rng.normal(0, 0.4, (250, 2)), rng.uniform(-40, 40, (150, 2))])]
    xy += [(0.0, 0.0)] * 60 + [(-0.0, 1.5), (20.0, 20.0), (20.0, 21.5), (None, 1.0), (float("nan"), 0.0)]
    rows = [(i, x, y, None if i == 7 else "ab"[i % 5 == 0], [None, "A", "B", "C"][i % 4]) for i, (x, y) in enumerate(xy)]
    cells = spark.createDataFrame(rows, "cell_id int, x double, y double, lib string, cell_type string")
    edges = spatial.radius_graph(cells, radius, "lib")
    want = neighborhood.composition(edges, cells, include_self=include_self, normalize=normalize)
    got = neighborhood.radius_composition(cells, radius, "lib", include_self=include_self, normalize=normalize)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_radius_counts_send_points_and_not_pairs(spark):
    """Every point at one place: a graph would have a million edges; counts have a row per point and kind."""
    cells = spark.range(1000).selectExpr("id AS cell_id", "1.0D AS x", "2.0D AS y", "id % 2 AS kind")
    counts = spatial.radius_counts(cells, 3.0, kind="kind")
    assert counts.count() == 2000
    assert {tuple(r) for r in counts.groupBy("kind").agg(F.sum("n")).collect()} == {(0, 500_000.0), (1, 500_000.0)}


def test_radius_counts_of_many_kinds(spark):
    cells = spark.range(300).selectExpr("id AS cell_id", "double(id % 10) AS x", "0.0D AS y", "string(id % 100) AS kind")
    got = {(r["src"], r["kind"]): r["n"] for r in spatial.radius_counts(cells, 1.0, kind="kind").collect()}
    assert got == {(i, str(k)): 3.0 for i in range(300) for k in range(100) if abs(i % 10 - k % 10) <= 1}


@pytest.mark.parametrize("low", [0.0, 0.6])
def test_spectral_radius_graph_is_the_transformed_graph(spark, monkeypatch, low):
    monkeypatch.setattr(spatial, "_BLOCK", 40)
    rng = np.random.default_rng(4)
    rows = [(f"c{i}", float(x), float(y), "ab"[i % 3 == 0]) for i, (x, y) in enumerate(np.concatenate([rng.normal(0, 0.5, (200, 2)), rng.uniform(-30, 30, (100, 2)), np.zeros((50, 2))]))]
    cells = spark.createDataFrame(rows, "cell_id string, x double, y double, lib string")
    want = spatial.transform_graph(spatial.radius_graph(cells, (low, 1.5), "lib"), "spectral").collect()
    got = spatial.neighbor_graph(cells, radius=(low, 1.5), library="lib", transform="spectral").collect()
    assert len(got) == len(want) and {(r["src"], r["dst"]) for r in got} == {(r["src"], r["dst"]) for r in want}
    weight = {(r["src"], r["dst"]): (r["weight"], r["distance"]) for r in want}
    assert all((r["weight"], r["distance"]) == pytest.approx(weight[r["src"], r["dst"]], rel=1e-12) for r in got)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_nearest_by_products_is_exact(spark, monkeypatch, kind):
    """Copies, ties and an offset that cancels in products: the same neighbours as brute force, in the order of distance and id."""
    monkeypatch.setattr(nearest, "_SEARCHES", 100)
    monkeypatch.setattr(nearest, "_CHUNK", 150)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, (300, 20)), 1e4 + 1e-3 * rng.normal(0, 1, (60, 20)), rng.integers(0, 2, (120, 20)).astype(float), np.zeros((25, 20))])
    ids = [f"c{i}" if kind == "string" else i for i in range(len(x))]
    points = spark.createDataFrame(list(zip(ids, x.tolist())), f"cell_id {kind}, vector array<double>")
    d = vectors.exact_distances(x, x)
    want = {}
    for i in range(len(x)):
        order = sorted((d[i, j], ids[j]) for j in range(len(x)) if j != i)[:9]
        want |= {(ids[i], j): w for w, j in order}
    assert {(r["src"], r["dst"]): r["distance"] for r in nearest.knn_vectors(points, 10).collect()} == want


def test_distances_by_products_do_not_cancel():
    rng = np.random.default_rng(6)
    a, b = rng.normal(0, 1, (80, 32)), rng.normal(0, 1, (70, 32))
    b[:9] = a[:9]
    b[9:20] = a[9:20] + 1e-9
    got, want = vectors.near_exact_distances(a, b), vectors.exact_distances(a, b)
    assert np.allclose(got, want, rtol=1e-10, atol=0) and (got[range(9), range(9)] == 0).all()


def test_radius_graph_of_copies_does_not_grow_with_their_pairs(spark):
    """2000 cells at one place and 2000 at another: the packed graph has a few rows of lists, and unpacks to all eight million pairs but for each cell with itself."""
    cells = spark.range(4000).selectExpr("id AS cell_id", "double(id % 2) AS x", "0.0D AS y")
    packed = spatial.packed_radius_graph(cells, 1.0)
    assert packed.count() <= 64 and packed.agg(F.max(F.size("src"))).first()[0] < 2000
    edges = spatial.radius_graph(cells, 1.0)
    assert edges.groupBy("distance").count().orderBy("distance").collect() == [(0.0, 2 * 2000 * 1999), (1.0, 2 * 2000 * 2000)]


@pytest.mark.parametrize("low", [0.0, 0.6])
def test_cosine_radius_graph_is_the_transformed_graph(spark, monkeypatch, low):
    monkeypatch.setattr(spatial, "_BLOCK", 40)
    monkeypatch.setattr(spatial, "_COPIES", 20)
    monkeypatch.setattr(spatial, "_CELLS", 500)
    rng = np.random.default_rng(7)
    xy = np.concatenate([rng.normal(0, 0.8, (120, 2)), rng.uniform(-30, 30, (150, 2)), np.zeros((50, 2)), np.full((2, 2), 90.0), np.full((1, 2), 95.0)])
    rows = [(f"c{i}", float(x), float(y), "ab"[i % 3 == 0]) for i, (x, y) in enumerate(xy)]
    cells = spark.createDataFrame(rows, "cell_id string, x double, y double, lib string")
    want = {(r["src"], r["dst"]): r["weight"] for r in spatial.transform_graph(spatial.radius_graph(cells, (low, 1.5), "lib"), "cosine").collect()}
    got = spatial.neighbor_graph(cells, radius=(low, 1.5), library="lib", transform="cosine").collect()
    assert len(got) == len(want) and {(r["src"], r["dst"]) for r in got} == set(want)
    assert all(r["weight"] == pytest.approx(want[r["src"], r["dst"]], rel=1e-12) for r in got)


def test_cosine_of_copies_sends_no_pairs(spark):
    cells = spark.range(3000).selectExpr("id AS cell_id", "0.0D AS x", "0.0D AS y")
    packed = spatial.packed_cosine_graph(cells, 1.0)
    assert packed.count() <= 16
    found = spatial.unpack_cosine(packed).groupBy(F.round("weight", 12).alias("weight")).count().orderBy("weight").collect()
    assert found == [(round(2998 / 2999, 12), 3000 * 2999), (1.0, 3000)]


def test_radius_vectors_are_those_of_the_composition(spark, monkeypatch):
    """One vector a position and type, unpacked to all cells, those without a place included."""
    monkeypatch.setattr(spatial, "_COPIES", 20)
    rng = np.random.default_rng(8)
    xy = [tuple(map(float, p)) for p in np.round(rng.normal(0, 2, (300, 2)), 0)] + [(0.0, 0.0)] * 60 + [(-0.0, 0.0), (None, 1.0), (float("nan"), 0.0)]
    rows = [(i, x, y, None if i % 50 == 7 else "ab"[i % 5 == 0], [None, "A", "B", "C"][i % 4]) for i, (x, y) in enumerate(xy)]
    cells = spark.createDataFrame(rows, "cell_id int, x double, y double, lib string, cell_type string")
    composed = neighborhood.composition(spatial.radius_graph(cells, 1.5, "lib"), cells)
    want = neighborhood.composition_vectors(composed, cells, ["A", "B", "C"])
    got = neighborhood.radius_vectors(cells, 1.5, ["A", "B", "C"], "lib")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    packs, counts = spatial.pack_counts(spark.range(5000).selectExpr("id AS cell_id", "1.0D AS x", "2.0D AS y", "'A' AS t"), 3.0, None, "t")
    assert packs.count() < 2000 and counts.count() < 2000  # a thousand cells or so are a row, not each


def test_hdbscan_reads_the_cells_once(spark):
    """Copies are counted before the first search; statistics and silhouette come from the weights."""
    from cellframe.operators import density

    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, 0.1, (30, 2)), rng.normal(5, 0.1, (30, 2)), [[20.0, 20.0]]]).round(2)
    rows = [(i * 40 + k, x[i].tolist()) for i in range(len(x)) for k in range(1 if i == 60 else 40)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "cell_id bigint, vector array<double>")
    out = density.hdbscan(df.mapInArrow(count, df.schema), 60)["stats"].first()
    labels = np.array([r["label"] for r in density.hdbscan(df, 60)["labels"].orderBy("cell_id").collect()])
    assert seen.value == len(rows)
    inside = labels != "-1"
    assert (out["n_clusters"], out["n_noise"]) == (len(set(labels[inside])), (~inside).sum()) and out["n_clusters"] > 1
    assert out["silhouette"] == pytest.approx(brute_silhouette(np.array([v for _, v in rows])[inside], labels[inside]), rel=1e-9)


def test_forced_labels_compare_no_pairs(spark, monkeypatch):
    from cellframe.operators import kmeans

    rng = np.random.default_rng(10)
    df = spark.createDataFrame([(i, rng.normal(9 * (i % 3), 1, 4).tolist()) for i in range(300)], "cell_id bigint, vector array<double>")
    want = kmeans.kmeans_sweep(df, 2, 4, force_n_clusters=3, n_init=2)
    monkeypatch.setattr(kmeans, "silhouettes", None)
    got = kmeans.kmeans_sweep(df, 2, 4, force_n_clusters=3, n_init=2, scored=False)
    assert sorted(map(tuple, got["labels"].collect())) == sorted(map(tuple, want["labels"].collect()))
    assert [r["selected"] for r in got["sweep"].orderBy("n_clusters").collect()] == [False, True, False]
    with pytest.raises(ValueError, match="forced"):
        kmeans.kmeans_sweep(df, 2, 4, scored=False)


def test_samples_are_no_shuffle_keys(spark, tmp_path):
    """Rows find their sample and its metadata where they are read; a shuffle by sample would make one task of each."""
    from checks.storage import write_raw_folder
    from cellframe.sources import dataset

    for status in "FO":
        write_raw_folder(spark, "/root/testdata/sf0.001", f"{tmp_path}/{status}", status)
    manifest = spark.createDataFrame([(s, f"{tmp_path}/{s}", "x", i) for i, s in enumerate("FO")], "sample string, path string, site string, ordinal long")
    parts = dataset.load_samples(spark, manifest)
    assert parts["cells"].select("sample").distinct().count() == 2
    for name in ("cells", "expr"):
        assert "SortMergeJoin" not in parts[name]._jdf.queryExecution().executedPlan().toString()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_modularity_reads_a_stored_graph(spark):
    from checks.clusters import modularity

    assert "lineitem" not in plan_of(modularity(spark, "/root/testdata/sf0.001"))


def test_ranking_of_a_dot_table_is_stored(spark):
    from checks.statistics import top_de_dot_table

    assert "Window" not in plan_of(top_de_dot_table(spark, "/root/testdata/sf0.001"))


def test_genes_are_no_shuffle_keys(spark):
    expr = spark.createDataFrame([(i, i % 3, 1.0 + i) for i in range(30)], "cell_id long, gene_id long, lognorm double")
    indexed, names = embed.index_genes(expr.select("gene_id"))
    rows = embed._entries(expr, expr.select("cell_id"), indexed, "lognorm")
    assert "SortMergeJoin [gene_id" not in plan_of(rows) and rows.count() == 30


def test_genes_of_a_network_are_no_shuffle_keys_and_scores_are_made_once(spark, monkeypatch):
    """A filter on the score is not a copy of its formula, and a network over the limit gives the same scores without being sent."""
    rows = [(c, f"g{(c * 7 + i * 5) % 12}", float(1 + (c + i) % 4)) for c in range(40) for i in range(5)]
    expr = spark.createDataFrame(rows, "cell_id int, gene_id string, lognorm double").groupBy("cell_id", "gene_id").agg(F.sum("lognorm").alias("lognorm"))
    genes = spark.createDataFrame([(f"g{i}",) for i in range(12)], "gene_id string")
    net = spark.createDataFrame([(f"s{i % 3}", f"g{i}", 1.0 + i % 2) for i in range(9)], "source string, target string, weight double")
    cells = spark.range(42).select(F.col("id").cast("int").alias("cell_id"))
    out = {}
    for most in (9, 8):
        monkeypatch.setattr(enrich, "MAX_SENT_EDGES", most)
        kept = enrich.ulm_scores(expr, cells, genes, net).where("score is not null and not isnan(score)")
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("SQRT") == 2 and ("strategy=broadcast" in plan) == (most == 9)
        out[most] = {(r["cell_id"], r["source"]): round(r["score"], 9) for r in kept.collect()}
    assert out[9] == out[8] and len(out[9]) == 40 * 3


def test_blocks_meet_in_passes(spark, monkeypatch):
    """Blocks are broadcast a few at a time and states wait in between: as many passes as bundles, no row sent to every block by shuffle."""
    monkeypatch.setattr(vectors, "BLOCK", 40)
    monkeypatch.setattr(vectors, "SENT", 2000)
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 1, (70, 17)) for c in (0, 1, 4)])
    labels = np.repeat(["a", "b", "c"], 70)
    table = spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, labels.tolist()))], "cell_id int, vector array<double>, label string")
    passes = []
    bundles = vectors.bundles

    def counted(*args):
        for rows, last in bundles(*args):
            passes.append(len(rows))
            yield rows, last

    monkeypatch.setattr(vectors, "bundles", counted)
    assert vectors.silhouette(table).first()[0] == pytest.approx(brute_silhouette(x, labels))
    assert len(passes) > 3 and sum(passes) >= 6  # each label in pieces of 40 vectors
    codes = table.selectExpr("cell_id AS vid", "vector", "1.0D AS w", "array(ascii(label) - 97, cell_id % 2) AS labels")
    got = {r["run"]: r["silhouette"] for r in vectors.silhouettes(codes, [3, 2]).collect()}
    assert got == pytest.approx({0: brute_silhouette(x, labels), 1: brute_silhouette(x, np.arange(len(x)) % 2)})


def test_held_rounds_are_those_of_the_joins(spark, monkeypatch):
    """The communities of a graph are the same whether rounds run over held states or over joins; the hash is Spark's own."""
    ids = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 200)
    rows = spark.createDataFrame([(int(i),) for i in ids], "node bigint")
    for turn in (0, 7):
        want = {r[0]: r[1] for r in rows.select("node", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0).collect()}
        assert dict(zip(ids.tolist(), communities.awake(ids, turn).tolist())) == want
    rng = np.random.default_rng(2)
    group = np.arange(60) // 15
    pairs = [(i, j, float(rng.integers(1, 9))) for i in range(60) for j in range(i) if rng.random() < (0.5 if group[i] == group[j] else 0.04)]
    graph = spark.createDataFrame([p for i, j, w in pairs for p in ((i, j, w), (j, i, w))], "src int, dst int, weight double")
    nodes = spark.range(61).selectExpr("cast(id AS int) AS cell_id")  # the last has no edge
    monkeypatch.setattr(communities, "_move_round", None)
    held = sorted(map(tuple, communities.communities(graph, nodes, [0.4, 1.0]).collect()))
    monkeypatch.undo()
    monkeypatch.setattr(communities, "HELD", 0)
    assert sorted(map(tuple, communities.communities(graph, nodes, [0.4, 1.0]).collect())) == held
