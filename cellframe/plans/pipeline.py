"""The stages of an analysis, each reading and writing tables of a stored dataset.

Every stage takes the dataset folder and exactly one of ``output`` (a new folder; unchanged tables are
copied) and ``inplace``. With ``resume`` a stage whose result is already there does nothing.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.functions import params
from cellframe.operators import (
    communities, density, differential, embed, enrich, kmeans, labels, layout, nearest, neighborhood, normalize as norm,
    qc, sampling, spatial,
)
from cellframe.operators.summaries import mean_scores
from cellframe.session import store
from cellframe.sources import dataset as ds
from cellframe.sources import manifest as mf
from cellframe.sources import markers as mk


#: Tables that hold results on the cells and genes of a normalised dataset.
_DERIVED = ("pca", "pca_loadings", "pca_variance", "umap", "edges", "scores", "de")


def _target(spark: SparkSession, root: str, output: str | None, inplace: bool, resume: bool = False, skip: tuple = ()) -> str:
    """Where a stage writes. A new folder first gets the tables of ``root`` but for those in ``skip``, which the stage writes itself.

    An existing folder is an error unless ``resume`` is on: then it is gone on with, and tables not yet copied are.
    """
    target = params.output_target(root, output, inplace)
    if target != root:
        there = ds.tables(spark, target) if ds.exists(spark, target) else []
        if there and not resume:
            raise FileExistsError(f"{target} exists")
        for name, df in ds.open_dataset(spark, root).items():
            if name not in there and name not in skip:
                ds.write_table(df, target, name)
    return target


def _has(spark: SparkSession, root: str, table: str, column: str | None = None) -> bool:
    if not ds.exists(spark, f"{root}/{table}"):
        return False
    return column is None or column in ds.read_table(spark, root, table).columns


def _add_keyed(rows: DataFrame, root: str, table: str, key: str, value: str) -> None:
    """Write rows of one key (score key, graph key) as a partition, leaving the other keys alone."""
    ds.update_partitions(rows.withColumn(key, F.lit(value)), root, table, [key])


def _with_columns(cells: DataFrame, extra: DataFrame) -> DataFrame:
    """Join per-cell columns, replacing those of the same name."""
    new = [c for c in extra.columns if c != "cell_id"]
    return cells.drop(*new).join(extra, "cell_id", "left")


def concat(spark: SparkSession, manifest: str, output: str, fraction: float = 1.0, seed: int = 0, overwrite: bool = False) -> None:
    """Union the samples of a manifest, tagged with its metadata, optionally keeping a share of the cells."""
    parts = ds.load_samples(spark, mf.read_manifest(spark, manifest))
    if fraction != 1.0:
        cells = store(sampling.downsample_fraction(parts["cells"], fraction, seed))
        parts = {**parts, "cells": cells, "expr": parts["expr"].join(cells.select("cell_id"), "cell_id", "left_semi")}
    ds.write_dataset(parts, output, overwrite)


def normalize(
    spark: SparkSession, root: str, output: str | None = None, inplace: bool = False, min_genes: int = 100,
    min_cells: int = 3, n_top_genes: int = 2000, resume: bool = False,
) -> str:
    """QC columns and top-gene shares, cell and gene filters, depth scaling with log1p, variable genes.

    The medians of the QC columns over all cells go to the table ``qc_medians``. If genes and counts carry a column ``feature``, genes of
    one name but different features are told apart by suffixes; without it, rows of one name are one gene. Results of later stages on
    the old cells are dropped.
    """
    own = ("cells", "genes", "expr", "qc_medians")
    target = _target(spark, root, output, inplace, resume, skip=(*own, *_DERIVED))
    if resume and _has(spark, target, "expr", "lognorm"):
        return target
    parts = ds.open_dataset(spark, root, ["cells", "genes", "expr"])
    names, raw = _named_apart(parts["genes"], parts["expr"])
    flagged = qc.flag_genes(names)
    per_cell = store(qc.cell_qc(raw, parts["cells"]))
    shares = qc.top_gene_share(raw, qc.top_share_sizes(names.count()))
    cells = _with_columns(_with_columns(parts["cells"], per_cell), shares)
    ds.write_table(qc.qc_medians(per_cell), target, "qc_medians")
    genes = flagged.join(qc.gene_qc(raw, flagged, parts["cells"].count()), "gene_id")
    kept = store(qc.filter_cells_and_genes(raw, min_genes, min_cells))
    cells = store(cells.where(F.col("n_genes_by_counts") >= min_genes))
    genes = store(genes.join(kept.select("gene_id").distinct(), "gene_id", "left_semi"))
    expr = store(norm.normalize_and_log(kept))
    batch = "sample" if "sample" in cells.columns else None
    flags = norm.variable_genes(expr, cells, genes, n_top_genes, batch)
    ds.write_table(genes.join(flags.select("gene_id", "dispersions_norm", "highly_variable"), "gene_id"), target, "genes")
    ds.write_table(cells, target, "cells")
    ds.write_table(expr, target, "expr")
    ds.drop_tables(spark, target, list(_DERIVED))
    return target


def _named_apart(genes: DataFrame, expr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gene_id) and (cell_id, gene_id, value) in which a gene's name is its own."""
    if "feature" not in genes.columns or "feature" not in expr.columns:
        return genes.select("gene_id").distinct(), expr.select("cell_id", "gene_id", "value")
    known = genes.select("feature", "gene_id").distinct()
    order = Window.orderBy("feature")  # of the genes, a bounded table
    named = store(qc.unique_names(known.withColumn("_at", F.row_number().over(order)), "gene_id", "_at").select("feature", "gene_id"))
    return named.select("gene_id"), expr.drop("gene_id").join(named, "feature").select("cell_id", "gene_id", "value")


def cluster(
    spark: SparkSession, root: str, output: str | None = None, inplace: bool = False, resolutions: str = "0.2,0.5,1.0",
    n_comps: int = 50, n_neighbors: int = 15, n_epochs: int = 200, resume: bool = False, knn_method: str = "exact",
    solver: str | None = None,
) -> str:
    """PCA of the variable genes, neighbour graph, 2-D layout and communities at several resolutions.

    ``knn_method`` and ``solver`` as in ``nearest.knn_vectors`` and ``embed.pca``.
    """
    wanted = params.parse_resolutions(resolutions)
    target = _target(spark, root, output, inplace, resume)
    parts = ds.open_dataset(spark, target, ["cells", "genes", "expr"])
    if not (resume and _has(spark, target, "pca")):
        chosen = parts["genes"].where("highly_variable") if "highly_variable" in parts["genes"].columns else parts["genes"]
        out = embed.pca(parts["expr"], parts["cells"], chosen, n_comps, solver=solver)
        for name, table in (("pca", out["embedding"]), ("pca_loadings", out["loadings"]), ("pca_variance", out["variance"])):
            ds.write_table(table, target, name)
    vectors = ds.read_table(spark, target, "pca")
    if not (resume and _has(spark, target, "umap")):
        knn = store(nearest.knn_vectors(vectors, n_neighbors, knn_method))
        graph = nearest.fuzzy_graph(knn, n_neighbors)
        distances = knn.select("src", F.col("dst"), F.lit(None).cast("double").alias("weight"), "distance")
        rows = graph.withColumn("distance", F.lit(None).cast("double"))
        _add_keyed(rows, target, "edges", "graph_key", "connectivities")
        _add_keyed(distances, target, "edges", "graph_key", "distances")
        graph = ds.read_table(spark, target, "edges").where("graph_key = 'connectivities'")
        ds.write_table(layout.umap_layout(graph, vectors, n_epochs), target, "umap")
    todo = [r for r in wanted if not (resume and params.resolution_column(r) in parts["cells"].columns)]
    if todo:
        graph = ds.read_table(spark, target, "edges").where("graph_key = 'connectivities'").select("src", "dst", "weight")
        found = communities.communities(graph, vectors, todo)
        wide = found.groupBy("cell_id").agg(*[
            F.max(F.when(F.col("resolution") == r, F.col("label"))).alias(params.resolution_column(r)) for r in todo
        ])
        ds.write_table(_with_columns(parts["cells"], wide), target, "cells")
    return target


def quantitate(
    spark: SparkSession, root: str, output: str | None = None, inplace: bool = False, markers: str | None = None,
    resources: dict[str, str] | None = None, names: list[str] | None = None, method: str = "mlm", tmin: int = 2,
    score_name: str = "custom", cell_filter: str | None = None, resume: bool = False, **panglao,
) -> str:
    """Scores of a marker list and/or named resources, stored under ``score_<method>_<name>``."""
    if not markers and not names:
        raise ValueError("give a marker list, resource names, or both")
    target = _target(spark, root, output, inplace, resume)
    parts = ds.open_dataset(spark, target, ["cells", "genes", "expr"])
    mask = qc.filter_by_equality(parts["cells"], cell_filter) if cell_filter else None
    nets = {}
    if markers:
        nets[score_name] = mk.markers_to_net(mk.read_markers(spark, markers))
        lost = enrich.missing_targets(nets[score_name], parts["genes"]).count()
        if lost:
            warnings.warn(f"{lost} marker genes are not in the data", stacklevel=2)
    if names:
        several = mk.read_resources(spark, resources or {}, names, **panglao)
        for name in names:
            nets[name.lower()] = several.where(F.col("net_name") == name.lower()).drop("net_name")
    todo = {n: f"score_{method}_{n}" for n in nets if not (resume and _has(spark, target, f"scores/score_key=score_{method}_{n}"))}
    if todo:  # all resources in one pass over the counts
        weight = lambda net: F.col("weight").cast("double") if "weight" in net.columns else F.lit(1.0)
        together = [nets[n].select(F.lit(n).alias("net_name"), "source", "target", weight(nets[n]).alias("weight")) for n in todo]
        scores = enrich.enrichment_scores(parts["expr"], parts["cells"], parts["genes"], reduce(DataFrame.unionByName, together), method, tmin, mask=mask)
        keys = F.concat(F.lit(f"score_{method}_"), "net_name")
        ds.update_partitions(scores.withColumn("score_key", keys).drop("net_name"), target, "scores", ["score_key"])
    return target


def read_scores(spark: SparkSession, root: str, score_key: str) -> DataFrame:
    scores = ds.read_table(spark, root, "scores").where(F.col("score_key") == score_key).drop("score_key")
    if scores.isEmpty():
        known = [r[0] for r in ds.read_table(spark, root, "scores").select("score_key").distinct().orderBy("score_key").collect()]
        raise ValueError(f"no scores under {score_key!r}; available: {known}")
    return scores


def assign(
    spark: SparkSession, root: str, score_key: str, output: str | None = None, inplace: bool = False,
    cluster_keys: list[str] | None = None, annotation_key: str | None = None, strategy: str = "top_positive",
    rank: bool = True, method: str = "wilcoxon", resume: bool = False,
) -> str:
    """Label every cluster column (default: all resolutions) by scores, and rank their marker genes unless told not to."""
    target = _target(spark, root, output, inplace, resume)
    cells = ds.read_table(spark, target, "cells")
    keys = cluster_keys or [c for c in cells.columns if params.resolution_of(c) is not None]
    if not keys:
        warnings.warn("no cluster columns to label", stacklevel=2)
        return target
    if annotation_key and len(keys) > 1:
        raise ValueError("one annotation_key cannot serve several cluster columns")
    columns = {k: params.annotation_column(k, annotation_key) for k in keys}
    keys = [k for k in keys if not (resume and columns[k] in cells.columns)]
    if keys:
        named = store(labels.label_clusters(read_scores(spark, target, score_key), cells, keys, strategy))
        for k in keys:
            cells = labels.attach_labels(cells.drop(columns[k]), named, k, columns[k])
        ds.write_table(cells, target, "cells")
    if rank:
        parts = ds.open_dataset(spark, target, ["cells", "genes", "expr"])
        for k in columns:
            ranked = store(differential.rank_genes(parts["expr"], parts["cells"], parts["genes"], k, method))
            _add_keyed(ranked, target, "de", "de_key", f"rank_genes_{k}")
            ds.write_ranked(ranked, f"{target}/_differential_expression", f"res{k.removeprefix('leiden_res')}")
    return target


def differential_tests(
    spark: SparkSession, root: str, group: str, folder: str, compare: list[str] | None = None, method: str = "wilcoxon",
    value: str = "lognorm", score_keys: list[str] | None = None, n_genes: int = 100, n_scores: int = 50,
) -> dict[str, str]:
    """Tests on genes, and on the given scores, between two groups or of each group against the rest, as CSV."""
    parts = ds.open_dataset(spark, root, ["cells", "genes", "expr"])
    tag = f"{compare[0]}_vs_{compare[1]}" if compare else f"groups_{group}"
    ranked = store(differential.rank_genes(parts["expr"], parts["cells"], parts["genes"], group, method, value, compare))
    paths = ds.write_ranked(ranked, folder, tag, n_genes)
    for key in score_keys or []:
        scores = read_scores(spark, root, key)
        if compare:
            out = store(differential.score_ttest(scores, parts["cells"], group, compare))
            paths[f"{key}_top"] = f"{folder}/de_{key}_top{n_scores}_{tag}"
            differential.by_absolute(out, "mean_difference", "feature").limit(n_scores).write.mode("overwrite").csv(paths[f"{key}_top"], header=True)
        else:
            out = mean_scores(scores, parts["cells"], group)
        paths[key] = f"{folder}/{'de' if compare else 'mean'}_{key}_{tag}"
        out.write.mode("overwrite").csv(paths[key], header=True)
    return paths


def spatial_neighbors(
    spark: SparkSession, root: str, output: str | None = None, inplace: bool = False, n_neighs: int = 6,
    radius: str | None = None, library: str | None = None, coord_type: str | None = None, transform: str | None = None,
    key: str = "spatial", resume: bool = False, library_id: str | None = None,
) -> str:
    """Spatial graph over the cell coordinates, stored under ``key``.

    ``library`` names the column of the cells' libraries; without it, ``library_id`` is the one library of all cells.
    """
    target = _target(spark, root, output, inplace, resume)
    if resume and _has(spark, target, f"edges/graph_key={key}"):
        return target
    cells = ds.read_table(spark, target, "cells")
    if library is not None and library not in cells.columns:
        raise ValueError(f"no cell attribute {library!r}; available: {cells.columns}")
    if library is None and library_id is not None:
        library = "_library"
        cells = cells.withColumn(library, F.lit(library_id))
    vertices = ds.read_table(spark, target, "boundaries") if _has(spark, target, "boundaries") else None
    points = spatial.with_coordinates(cells, vertices)
    edges = spatial.neighbor_graph(points, n_neighs, params.parse_radius(radius), library, coord_type, transform)
    _add_keyed(edges, target, "edges", "graph_key", key)
    return target


def spatial_cluster(
    spark: SparkSession, root: str, cell_type: str, output: str | None = None, inplace: bool = False, graph_key: str = "spatial",
    neighbor_k: int = 0, method: str = "kmeans", include_self: bool = True, min_clusters: int = 2, max_clusters: int = 20,
    normalize: bool = True, library: str | None = None, force_n_clusters: int | None = None, n_init: int = 10, seed: int = 0, column: str = "spatial_cluster",
    resume: bool = False, **hdbscan_options,
) -> str:
    """Cluster cells by the cell types around them; k-means sweep or density clustering.

    Without a stored graph, one with ``neighbor_k`` neighbours (within each ``library``) is built if that is positive. Without
    ``normalize`` cells are clustered by counts instead of shares. Next to the result stand the run's parameters (``<column>_params``)
    and the types in the order of the vectors (``<column>_categories``).
    """
    if method not in ("kmeans", "hdbscan"):
        raise ValueError("method is 'kmeans' or 'hdbscan'")
    if force_n_clusters is not None and method != "kmeans":
        raise ValueError("force_n_clusters applies to k-means only")
    target = _target(spark, root, output, inplace, resume)
    cells = ds.read_table(spark, target, "cells")
    if resume and column in cells.columns:
        return target
    if cell_type not in cells.columns:
        raise KeyError(f"no cell attribute {cell_type!r}; available: {cells.columns}")
    if not _has(spark, target, f"edges/graph_key={graph_key}"):
        if neighbor_k <= 0:
            raise ValueError(f"no spatial graph {graph_key!r}; run spatial_neighbors or pass neighbor_k")
        spatial_neighbors(spark, target, inplace=True, n_neighs=neighbor_k, library=library, key=graph_key, coord_type="generic")
    edges = ds.read_table(spark, target, "edges").where(F.col("graph_key") == graph_key)
    composed = store(neighborhood.composition(edges, cells, cell_type, include_self, normalize))
    types = neighborhood.categories(cells, cell_type)
    vectors = store(neighborhood.composition_vectors(composed, cells, types))
    run = {
        "cell_type": cell_type, "graph_key": graph_key, "neighbor_k": neighbor_k, "method": method, "include_self": include_self,
        "min_clusters": min_clusters, "max_clusters": max_clusters, "normalize": normalize, "library": library,
        "force_n_clusters": force_n_clusters, "n_init": n_init, "seed": seed, **hdbscan_options,
    }
    given = [(k, None if v is None else str(v)) for k, v in run.items()]
    ds.write_table(spark.createDataFrame(given, "name string, value string"), target, f"{column}_params")
    listed = spark.createDataFrame(list(enumerate(map(str, types))), "position int, cell_type string")
    ds.write_table(listed, target, f"{column}_categories")
    if method == "kmeans":
        out = kmeans.kmeans_sweep(vectors, min_clusters, max_clusters, force_n_clusters, n_init, seed)
        ds.write_table(out["sweep"], target, f"{column}_sweep")
        ds.write_table(out["labels_by_k"], target, f"{column}_labels_by_k")
    else:
        out = density.hdbscan(vectors, **hdbscan_options)
        ds.write_table(out["stats"], target, f"{column}_stats")
    found = store(out["labels"])
    means = neighborhood.cluster_composition(composed, found.withColumnRenamed("label", "cluster"))
    ds.write_table(means, target, f"{column}_composition")
    ds.write_table(vectors, target, f"{column}_vectors")
    ds.write_table(_with_columns(cells, found.withColumnRenamed("label", column)), target, "cells")
    return target
