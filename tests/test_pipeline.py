"""Sources, sinks and the stages end to end on a small synthetic study."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.plans import pipeline
from cellframe.sources import dataset as ds
from cellframe.sources import manifest as mf
from cellframe.sources import markers as mk

TYPES = {"T": ["CD3", "CD8"], "B": ["CD19", "CD20"]}
OTHERS = [f"gene_{i}" for i in range(16)]


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    """Two raw sample folders: cells of two kinds side by side, transcripts in Parquet and CSV."""
    root = tmp_path_factory.mktemp("study")
    rng = np.random.default_rng(0)
    rows = []
    for sample, fmt in (("one", "parquet"), ("two", "csv")):
        cells, spots = [], []
        for i in range(24):
            kind = "T" if i < 12 else "B"
            cells.append((f"c{i}", float(rng.uniform(0, 50) + (0 if kind == "T" else 200)), float(rng.uniform(0, 50))))
            for g in TYPES[kind]:
                spots += [(f"c{i}", g)] * int(rng.integers(6, 12))
            for g in OTHERS:
                spots += [(f"c{i}", g)] * int(rng.integers(0, 4))
        spots += [("UNASSIGNED", "CD3")] * 5
        c = spark.createDataFrame(cells, "cell_id string, x_centroid double, y_centroid double").coalesce(1)
        s = spark.createDataFrame(spots, "cell_id string, feature_name string").coalesce(1)
        for name, df in (("cells", c), ("transcripts", s)):
            path = f"{root}/{sample}/{name}.{fmt}"
            df.write.csv(path, header=True) if fmt == "csv" else df.write.parquet(path)
        rows.append((sample, f"{root}/{sample}", "POS" if sample == "one" else "NEG"))
    spark.createDataFrame(rows, "sample string, path string, status string").coalesce(1).write.csv(f"{root}/manifest", header=True)
    spark.createDataFrame([(g, t) for t, gs in TYPES.items() for g in gs], "gene string, cell_type string").coalesce(1).write.csv(f"{root}/markers", header=True)
    return root


def test_stages(spark, study):
    root = f"{study}/all.dataset"
    pipeline.concat(spark, f"{study}/manifest", root)
    cells = ds.read_table(spark, root, "cells")
    assert cells.count() == 48 and cells.where("status = 'POS'").count() == 24
    assert ds.read_table(spark, root, "expr").where("cell_id like '%UNASSIGNED%'").count() == 0
    with pytest.raises(FileExistsError):
        pipeline.concat(spark, f"{study}/manifest", root)

    done = pipeline.normalize(spark, root, output=f"{study}/done.dataset", min_genes=5, min_cells=2, n_top_genes=10)
    genes = ds.read_table(spark, done, "genes")
    assert 0 < genes.where("highly_variable").count() <= 10
    assert {"counts", "norm", "lognorm"} <= set(ds.read_table(spark, done, "expr").columns)
    assert "lognorm" not in ds.read_table(spark, root, "expr").columns
    assert pipeline.normalize(spark, done, inplace=True, resume=True) == done

    pipeline.cluster(spark, done, inplace=True, resolutions="0.3", n_comps=4, n_neighbors=6, n_epochs=3)
    cells = ds.read_table(spark, done, "cells")
    assert 1 <= cells.select("leiden_res0p3").distinct().count() <= 48 and cells.where("leiden_res0p3 is null").isEmpty()
    assert ds.read_table(spark, done, "umap").count() == 48

    pipeline.quantitate(spark, done, inplace=True, markers=f"{study}/markers", method="ulm")
    with pytest.raises(ValueError, match="no scores"):
        pipeline.assign(spark, done, "score_mlm_custom", inplace=True)
    pipeline.assign(spark, done, "score_ulm_custom", inplace=True, rank=True)
    cells = ds.read_table(spark, done, "cells").withColumn(
        "truth", F.when(F.substring_index("cell_id", "-c", -1).cast("int") < 12, "T").otherwise("B")
    )
    if cells.select("leiden_res0p3").distinct().count() > 1:
        assert cells.where("cell_type_res0p3 = truth").count() > 40
    ranked = ds.read_table(spark, done, "de")
    assert {"group", "gene_id", "score", "logfc", "pval", "pval_adj"} <= set(ranked.columns)

    paths = pipeline.differential_tests(spark, done, "status", f"{study}/de", ["POS", "NEG"], score_keys=["score_ulm_custom"], n_genes=3)
    assert spark.read.csv(paths["top"], header=True).count() == 3
    assert spark.read.csv(paths["score_ulm_custom"], header=True).count() == 2

    pipeline.spatial_neighbors(spark, done, inplace=True, n_neighs=4, library="sample")
    edges = ds.read_table(spark, done, "edges").where("graph_key = 'spatial'")
    assert edges.count() == 48 * 4
    assert edges.where(F.substring_index("src", "-", 1) != F.substring_index("dst", "-", 1)).isEmpty()
    typed = store_truth(spark, done, cells)
    pipeline.spatial_cluster(spark, typed, "truth", inplace=True, max_clusters=3, n_init=2)
    out = ds.read_table(spark, typed, "cells")
    assert out.groupBy("truth", "spatial_cluster").count().count() == 2
    with pytest.raises(ValueError, match="no spatial graph"):
        pipeline.spatial_cluster(spark, typed, "truth", inplace=True, graph_key="none")
    with pytest.raises(KeyError):
        pipeline.spatial_cluster(spark, typed, "nope", inplace=True)
    with pytest.raises(ValueError):
        pipeline.normalize(spark, root)


def store_truth(spark, root, cells):
    ds.write_table(cells, root, "cells")
    return root


def test_manifest_errors(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "sample string, n int").write.csv(str(tmp_path / "m"), header=True)
    with pytest.raises(ValueError, match="missing required columns"):
        mf.read_manifest(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="cell_type and gene"):
        mk.read_markers(spark, str(tmp_path / "m"))
    with pytest.raises(FileNotFoundError):
        ds.read_instrument_folder(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        ds.open_dataset(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="unknown resource"):
        mk.read_resource(spark, {}, "kegg")
    with pytest.raises(ValueError, match="no file"):
        mk.read_resource(spark, {}, "Hallmark")


def test_table_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "d")
    ds.write_dataset({"cells": spark.range(3), "genes": spark.range(2)}, root)
    ds.write_table(ds.read_table(spark, root, "cells").withColumn("x", F.lit(1)), root, "cells")
    assert ds.read_table(spark, root, "cells").columns == ["id", "x"] and ds.tables(spark, root) == ["cells", "genes"]
    ds.update_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, sample string"), root, "parts", ["sample"])
    ds.update_partitions(spark.createDataFrame([(9, "b")], "v int, sample string"), root, "parts", ["sample"])
    assert {(r["v"], r["sample"]) for r in ds.read_table(spark, root, "parts").collect()} == {(1, "a"), (9, "b")}
    ds.write_dataset({"genes": spark.range(1)}, str(tmp_path / "no_cells"))
    with pytest.raises(ValueError, match="cells"):
        ds.open_dataset(spark, str(tmp_path / "no_cells"))


def _vectors(spark, partitions):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 4)) * 8
    rows = [(i, [float(v) for v in centres[i % 6] + rng.normal(size=4)]) for i in range(900)]
    return spark.createDataFrame(rows, "cell_id long, vector array<double>").repartition(partitions, "cell_id")


def test_kmeans_does_not_depend_on_partitions(spark):
    from cellframe.operators.kmeans import kmeans_sweep

    runs = []
    for n in (4, 7):
        out = kmeans_sweep(_vectors(spark, n), 2, 8, n_init=3, seed=3)
        sweep = [(r["n_clusters"], round(r["inertia"], 6), round(r["silhouette"], 9), r["selected"]) for r in out["sweep"].orderBy("n_clusters").collect()]
        runs.append((sweep, sorted(map(tuple, out["labels"].collect()))))
    assert runs[0] == runs[1]
    assert [k for k, *_, chosen in runs[0][0] if chosen] == [6]


def test_resume_with_output_and_clean_overwrite(spark, tmp_path):
    from cellframe.plans import pipeline as p
    from cellframe.sources import dataset as ds

    rng = np.random.default_rng(2)
    expr = spark.createDataFrame(
        [(f"c{i}", f"g{j}", float(v)) for i in range(20) for j in range(30) if (v := rng.poisson(2))],
        "cell_id string, gene_id string, value double",
    )
    cells = spark.createDataFrame([(f"c{i}", "s") for i in range(20)], "cell_id string, sample string")
    genes = spark.createDataFrame([(f"g{j}",) for j in range(30)], "gene_id string")
    parts = {"cells": cells, "genes": genes, "expr": expr}
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    ds.write_dataset({**parts, "umap": cells, "notes": cells}, first)
    p.normalize(spark, first, output=second, min_genes=1, min_cells=1)
    assert ds.tables(spark, second) == ["cells", "expr", "genes", "notes", "qc_medians"]  # results on the old cells stay behind
    p.normalize(spark, first, output=second, min_genes=1, min_cells=1, resume=True)
    with pytest.raises(FileExistsError):
        p.normalize(spark, first, output=second, min_genes=1, min_cells=1)
    ds.write_dataset(parts, first, overwrite=True)
    assert ds.tables(spark, first) == ["cells", "expr", "genes"]


def test_markers_without_expression_keep_their_rows(spark):
    from cellframe.operators import neighborhood, sampling, summaries

    expr = spark.createDataFrame([("c0", "g0", 1.0), ("c1", "g0", 3.0)], "cell_id string, gene_id string, lognorm double")
    cells = spark.createDataFrame([("c0", "x"), ("c1", "y"), ("c2", None)], "cell_id string, kind string")
    genes = spark.createDataFrame([("g0",), ("g2",)], "gene_id string")
    net = spark.createDataFrame([("T", "g0"), ("T", "g2"), ("T", "absent")], "source string, target string")
    got = {tuple(r) for r in summaries.dot_table(expr, cells, net, "kind", genes=genes).collect()}
    assert got == {("T", "g0", "x", 1.0, 1.0), ("T", "g0", "y", 3.0, 1.0), ("T", "g2", "x", 0.0, 0.0), ("T", "g2", "y", 0.0, 0.0)}
    assert sampling.downsample_per_sample(cells, 5, sample="kind").count() == 3
    composed = spark.createDataFrame([("c0", "A", 1.0), ("c1", "B", 1.0)], "cell_id string, cell_type string, share double")
    clusters = spark.createDataFrame([("c0", "1"), ("c1", "2"), ("c2", "3")], "cell_id string, cluster string")
    means = {tuple(r) for r in neighborhood.cluster_composition(composed, clusters).collect()}
    assert means == {("1", "A", 1.0), ("1", "B", 0.0), ("2", "A", 0.0), ("2", "B", 1.0), ("3", "A", 0.0), ("3", "B", 0.0)}
