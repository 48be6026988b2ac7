"""Worked examples with known values."""

import math

import pytest
from pyspark.sql import functions as F

from cellframe.functions import params
from cellframe.functions.exprs import box, box_iou, first_scalar
from cellframe.operators import differential as de
from cellframe.operators import enrich, labels, neighborhood, normalize, qc, ranks, roi, sampling, spatial, summaries, vectors
from cellframe.sources import manifest as mf


def values(df, key, value):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}


def test_normalise_and_log(micro):
    expr, *_ = micro
    got = values(normalize.normalize_and_log(expr), ("cell_id", "gene_id"), "lognorm")
    want = {("c0", "g0"): 1.609438, ("c0", "g2"): 1.94591, ("c1", "g1"): 1.609438, ("c1", "g5"): 1.098612,
            ("c2", "g0"): 0.405465, ("c2", "g5"): 2.140066, ("c3", "g2"): 1.386294, ("c3", "g4"): 2.079442}
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


@pytest.mark.parametrize("method,want", [
    ("ulm", {"c0": (17.255091, -1.144495), "c1": (-1.896618, 3.239929), "c2": (-0.666667, -0.666667), "c3": (0.19518, -1.111111)}),
    ("mlm", {"c0": (12.941318, 0.0), "c1": (-1.224745, 2.363693), "c2": (-1.224745, -1.224745), "c3": (-0.339683, -1.019049)}),
])
def test_scores(micro, method, want):
    expr, cells, genes, net = micro
    got = values(enrich.enrichment_scores(normalize.normalize_and_log(expr), cells, genes, net, method), ("cell_id", "source"), "score")
    for cell, (t, b) in want.items():
        assert got[(cell, "T")] == pytest.approx(t, abs=1e-5)
        assert got[(cell, "B")] == pytest.approx(b, abs=1e-5)


def test_cell_without_counts_has_null_score(spark, micro):
    expr, cells, genes, net = micro
    more = cells.unionByName(spark.createDataFrame([("empty",)], "cell_id string"))
    for method in ("ulm", "mlm"):
        out = enrich.enrichment_scores(normalize.normalize_and_log(expr), more, genes, net, method).where("cell_id = 'empty'").collect()
        assert len(out) == 2 and all(r["score"] is None for r in out)


def test_score_errors(spark, micro):
    expr, cells, genes, net = micro
    ln = normalize.normalize_and_log(expr)
    with pytest.raises(ValueError, match="method"):
        enrich.enrichment_scores(ln, cells, genes, net, "gsea")
    with pytest.raises(ValueError, match="repeated"):
        enrich.enrichment_scores(ln, cells, genes, net.unionByName(net))
    twin = net.unionByName(net.where("source = 'T'").withColumn("source", F.lit("T2")))
    with pytest.raises(ValueError, match="dependent"):
        enrich.mlm_scores(ln, cells, genes, twin)
    small = genes.where("gene_id in ('g0', 'g1', 'g2')")
    tiny = spark.createDataFrame([("A", "g0"), ("B", "g1")], "source string, target string")
    with pytest.raises(ValueError, match="degree of freedom"):
        enrich.mlm_scores(ln, cells, small, tiny, tmin=1)


def test_negative_scores_are_unknown(spark):
    cells = spark.createDataFrame([(i, str(i % 3)) for i in range(12)], "cell_id int, leiden_res0p5 string")
    scores = spark.createDataFrame([(i, s, -1.0) for i in range(12) for s in "AB"], "cell_id int, source string, score double")
    out = labels.label_clusters(scores, cells, ["leiden_res0p5"]).collect()
    assert {r["cluster"] for r in out} == {"0", "1", "2"} and {r["label"] for r in out} == {"Unknown"}
    with pytest.raises(ValueError, match="strategy"):
        labels.label_clusters(scores, cells, ["leiden_res0p5"], "threshold")
    with pytest.raises(ValueError, match="cluster columns"):
        labels.label_clusters(scores, cells, ["nope"])


def test_rank_sum_golden(spark):
    rows = [("g", c, v) for c, vs in (("a", [0, 0, 1, 2]), ("b", [0, 2, 3, 5])) for v in vs]
    expr = spark.createDataFrame([(i, "g", float(v)) for i, (_, _, v) in enumerate(rows) if v], "cell_id int, gene_id string, lognorm double")
    cells = spark.createDataFrame([(i, c) for i, (_, c, _) in enumerate(rows)], "cell_id int, grp string")
    genes = spark.createDataFrame([("g",)], "gene_id string")
    out = {r["group"]: r for r in de.rank_genes(expr, cells, genes, "grp").collect()}
    assert out["a"]["score"] == pytest.approx(-1.299038, abs=1e-6)
    assert out["a"]["pval"] == pytest.approx(0.193931, abs=1e-6)
    welch = {r["group"]: r for r in de.rank_genes(expr, cells, genes, "grp", "t-test").collect()}
    assert welch["a"]["score"] == pytest.approx(-1.527525, abs=1e-6)
    scores = spark.createDataFrame([(i, "g", float(v)) for i, (_, _, v) in enumerate(rows)], "cell_id int, source string, score double")
    pooled = de.score_ttest(scores, cells, "grp", ["a", "b"]).first()
    assert pooled["t_statistic"] == pytest.approx(-1.527525, abs=1e-6)


def test_rank_sums_with_negatives_and_zeros(spark):
    """Implicit zeros lie between negative and positive values."""
    a, b = [-2.0, 0.0, 0.0, 3.0, 1.5], [-1.0, -2.0, 0.0, 4.0]
    every = [("a", v) for v in a] + [("b", v) for v in b]
    order = sorted(v for _, v in every)
    rank = {v: sum(i + 1 for i, o in enumerate(order) if o == v) / order.count(v) for v in set(order)}
    n1, n2 = len(a), len(b)
    want = (sum(rank[v] for v in a) - n1 * (n1 + n2 + 1) / 2) / math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    expr = spark.createDataFrame([(i, "g", v) for i, (_, v) in enumerate(every) if v], "cell_id int, gene_id string, lognorm double")
    cells = spark.createDataFrame([(i, g) for i, (g, _) in enumerate(every)], "cell_id int, grp string")
    genes = spark.createDataFrame([("g",)], "gene_id string")
    out = values(de.wilcoxon_scores(expr, cells, genes, "grp"), ("group",), "score")
    assert out[("a",)] == pytest.approx(want)


def test_bh(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, 0.5, None])], "i int, p double")
    for out in (ranks.adjust(df, "p"), ranks.adjust_bounded(df.withColumn("g", F.lit(1)), "p", ["g"])):
        got = values(out, ("i",), "pval_adj")
        for i, v in enumerate([0.04, 0.16 / 3, 0.16 / 3, 0.5]):
            assert got[(i,)] == pytest.approx(v)
        assert got[(4,)] is None


def test_de_errors(spark, micro):
    expr, _, genes, _ = micro
    cells = spark.createDataFrame([("c0", "a"), ("c1", "b")], "cell_id string, grp string")
    for kwargs, text in (({"method": "x"}, "method"), ({"compare": ["a"]}, "two groups"), ({"compare": ["a", "z"]}, "not found")):
        with pytest.raises(ValueError, match=text):
            de.rank_genes(expr, cells, genes, "grp", **kwargs)
    with pytest.raises(ValueError, match="attribute"):
        de.rank_genes(expr, cells, genes, "nope")


def test_score_ttest_null_propagates(spark):
    scores = spark.createDataFrame([(0, "s", 1.0), (1, "s", None), (2, "s", 2.0), (3, "s", 4.0)], "cell_id int, source string, score double")
    cells = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "b")], "cell_id int, grp string")
    r = de.score_ttest(scores, cells, "grp", ["a", "b"]).first()
    assert r["t_statistic"] is None and r["mean_group1"] is None and r["mean_group2"] == 3.0


def test_chi_square(spark):
    rows = [("r0", "c0")] * 5 + [("r0", "c1")] * 5 + [("r1", "c1")] * 10
    df = spark.createDataFrame(rows, "r string, c string")
    assert de.chi_square(df, "r", "c", yates=False).first()["statistic"] == pytest.approx(20 / 3)
    corrected = de.chi_square(df, "r", "c").first()
    assert corrected["statistic"] == pytest.approx(4.266667, abs=1e-6)
    assert corrected["pvalue"] == pytest.approx(math.erfc(math.sqrt(corrected["statistic"] / 2)), abs=1e-12)


MICRO_EDGES = [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (3, 4), (4, 3), (5, 4)]


@pytest.mark.parametrize("include_self,want", [
    (True, [(2, 1, 0, 3), (2, 1, 0, 3), (1, 1, 0, 2), (0, 1, 1, 2), (0, 1, 1, 2), (0, 0, 2, 2)]),
    (False, [(1, 1, 0, 2), (1, 1, 0, 2), (1, 0, 0, 1), (0, 0, 1, 1), (0, 1, 0, 1), (0, 0, 1, 1)]),
])
def test_composition_golden(spark, include_self, want):
    edges = spark.createDataFrame(MICRO_EDGES, "src int, dst int")
    cells = spark.createDataFrame(list(enumerate("AABBCC")), "cell_id int, cell_type string")
    names = neighborhood.categories(cells)
    for normalize_ in (False, True):
        comp = neighborhood.composition(edges, cells, include_self=include_self, normalize=normalize_)
        for r in neighborhood.composition_vectors(comp, cells, names).collect():
            *counts, total = want[r["cell_id"]]
            assert r["neighbor_count"] == total
            assert r["vector"] == pytest.approx([c / total if normalize_ else c for c in counts])


def test_composition_untyped_and_isolated(spark):
    edges = spark.createDataFrame([(0, 1), (0, 0), (2, 1), (2, 1)], "src int, dst int")
    cells = spark.createDataFrame([(0, "A"), (1, None), (2, None), (3, "B")], "cell_id int, cell_type string")
    comp = neighborhood.composition(edges, cells, unique_edges=False)
    got = {r["cell_id"]: (r["vector"], r["neighbor_count"]) for r in neighborhood.composition_vectors(comp, cells, ["A", "B"]).collect()}
    assert got == {0: ([1.0, 0.0], 1.0), 1: ([0.0, 0.0], 0.0), 2: ([0.0, 0.0], 0.0), 3: ([0.0, 1.0], 1.0)}


def test_silhouette_golden(spark):
    pts = [((0.0, 0.0), 0), ((0.0, 1.0), 0), ((4.0, 0.0), 1), ((4.0, 1.0), 1), ((9.0, 9.0), 2)]
    df = spark.createDataFrame([(i, list(p), c) for i, (p, c) in enumerate(pts)], "cell_id int, vector array<double>, label int")
    assert vectors.silhouette(df).first()[0] == pytest.approx(0.603031, abs=1e-6)
    one = df.withColumn("label", F.lit(0))
    assert vectors.silhouette(one).first()[0] is None


def test_windows_and_iou(spark):
    pts = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 10.0)], "cell_id int, x double, y double")
    w = roi.sliding_windows(pts, (0.4,), 0.35)
    starts = sorted({round(r["x_min"], 9) for r in w.collect()})
    assert starts == pytest.approx([0, 1.4, 2.8, 4.2, 5.6, 7.0])
    assert w.agg(F.max("x_max")).first()[0] == pytest.approx(11.0)
    pair = spark.createDataFrame([(0.0, 4.0, 0.0, 4.0, 2.0, 6.0, 1.0, 5.0)], "a_x_min double, a_x_max double, a_y_min double, a_y_max double, b_x_min double, b_x_max double, b_y_min double, b_y_max double")
    assert pair.select(box_iou(box("a_"), box("b_"))).first()[0] == pytest.approx(6 / 26)


def test_gene_flags(spark):
    names = {"HBA1": "hb", "HBP1": None, "HB": None, "MT-CO1": "mt", "RPS3": "ribo", "RPL7": "ribo", "mt-Co1": None}
    df = qc.flag_genes(spark.createDataFrame([(n,) for n in names], "gene_id string"))
    for r in df.collect():
        assert [c for c in ("mt", "ribo", "hb") if r[c]] == ([names[r["gene_id"]]] if names[r["gene_id"]] else [])


def test_unique_names_skip_taken_suffixes(spark):
    df = spark.createDataFrame(list(enumerate(["a", "a", "a-1", "b", "a", "a-3"])), "ord int, name string")
    got = [r["name"] for r in qc.unique_names(df, "name", "ord").orderBy("ord").collect()]
    assert got == ["a", "a-2", "a-1", "b", "a-4", "a-3"] and len(set(got)) == 6


def test_qc_empty_cell(spark, micro):
    expr, cells, genes, _ = micro
    more = cells.unionByName(spark.createDataFrame([("empty",)], "cell_id string"))
    r = qc.cell_qc(expr, more).where("cell_id = 'empty'").first()
    assert (r["n_genes_by_counts"], r["total_counts"], r["pct_counts_mt"]) == (0, 0.0, None)
    assert qc.gene_qc(expr, genes, 5).where("gene_id = 'g0'").first()["mean_counts"] == 1.0
    assert qc.top_share_sizes(300) == [20, 50, 100] and qc.top_share_sizes(20) == [20] and qc.top_share_sizes(5) == [5]


def test_equality_filter(spark):
    cells = spark.createDataFrame([(1, "x==y", 3)], "cell_id int, kind string, n int")
    assert qc.filter_by_equality(cells, "kind==x==y").count() == 1
    with pytest.warns(UserWarning):
        assert qc.filter_by_equality(cells, "n==3").count() == 0
    with pytest.raises(ValueError):
        qc.filter_by_equality(cells, "kind=x")
    with pytest.raises(KeyError):
        qc.filter_by_equality(cells, "nope==1")


def test_medians(spark):
    for vals in ([3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 100.0], [-4.0, 0.0, 2.0, None]):
        df = spark.createDataFrame([("k", v) for v in vals], "k string, v double")
        real = sorted(v for v in vals if v is not None)
        n = len(real)
        assert ranks.median_by(df, "k", "v").first()["median"] == (real[(n - 1) // 2] + real[n // 2]) / 2


def test_downsample(spark):
    cells = spark.range(1000).select(F.col("id").alias("cell_id"), (F.col("id") % 3).cast("string").alias("sample"))
    kept = sampling.downsample_fraction(cells, 0.5, 1)
    assert kept.count() == 500 and kept.distinct().count() == 500
    assert sampling.downsample_fraction(cells, 1.0) is cells
    per = {r[0]: r[1] for r in sampling.downsample_per_sample(cells, 333, 1).groupBy("sample").count().collect()}
    assert per == {"0": 333, "1": 333, "2": 333}
    assert sampling.downsample_per_sample(cells, 5000, 1).count() == 1000
    for bad in (0.0, -1.0, 1.5):
        with pytest.raises(ValueError):
            sampling.downsample_fraction(cells, bad)


def test_centroids(spark):
    square = [("sq", i, x, y) for i, (x, y) in enumerate([(10.0, 10.0), (12.0, 10.0), (12.0, 12.0), (10.0, 12.0), (10.0, 10.0)])]
    tri = [("tri", i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (3.0, 0.0), (0.0, 3.0)])]
    line = [("line", 0, 1.0, 1.0), ("line", 1, 3.0, 1.0)]
    got = values(spatial.centroids(spark.createDataFrame(square + tri + line, "cell_id string, vertex_ord int, x double, y double")), ("cell_id",), "x")
    assert got == {("sq",): pytest.approx(11.0), ("tri",): pytest.approx(1.0), ("line",): pytest.approx(2.0)}


def test_parameters():
    assert params.parse_radius(None) is None and params.parse_radius("  ") is None
    assert params.parse_radius("100") == 100.0 and params.parse_radius("50, 200") == (50.0, 200.0)
    for bad in ("1,2,3", "5,2", ","):
        with pytest.raises(ValueError):
            params.parse_radius(bad)
    assert params.parse_transform("none") is None and params.parse_transform("cosine") == "cosine"
    assert params.parse_resolutions("0.2, 0.5") == [0.2, 0.5]
    with pytest.raises(ValueError):
        params.parse_resolutions("0.2,x")
    assert params.resolution_column(0.5) == "leiden_res0p5" and params.resolution_of("leiden_res0p5") == 0.5
    assert params.annotation_column("leiden_res0p5") == "cell_type_res0p5"
    assert params.output_target("in", None, True) == "in" and params.output_target("in", "out", False) == "out"
    for args in (("a", "b", True), ("a", None, False)):
        with pytest.raises(ValueError):
            params.output_target(*args)
    for args in ((1, 5), (4, 3), (2, 5, 6)):
        with pytest.raises(ValueError):
            params.check_cluster_range(*args)


def test_small_sources(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(first_scalar(F.col("v"))).collect()] == ["a", "", None]
    with pytest.raises(ValueError):
        mf.concat_samples([])
    noise = spark.createDataFrame([("-1",), ("0",), ("1",), ("-1",)], "label string")
    assert tuple(summaries.noise_statistics(noise).first()) == (2, 2, 0.5)
    assert tuple(summaries.noise_statistics(noise.limit(0)).first()) == (0, 0, 0.0)
