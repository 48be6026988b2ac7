"""Differential tests on genes and on scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.functions.pvalues import chi2_p, normal_p, student_p
from cellframe.operators.ranks import adjust, adjust_bounded, rank_sum_z, rank_sums
from cellframe.session import store

METHODS = ("wilcoxon", "t-test", "logreg")
_EPS = 1e-9  # fixed value: keeps the fold change finite


def check_groups(cells: DataFrame, group: str, compare: list[str] | None) -> None:
    """Group column must exist; a comparison names exactly two existing groups."""
    if group not in cells.columns:
        raise ValueError(f"no cell attribute {group!r}; available: {cells.columns}")
    if compare is None:
        return
    if len(compare) != 2:
        raise ValueError("a comparison needs exactly two groups")
    known = {r[0] for r in cells.where(F.col(group).isin(compare)).select(group).distinct().collect()}
    missing = [g for g in compare if g not in known]
    if missing:
        some = [r[0] for r in cells.select(group).distinct().orderBy(group).limit(50).collect()]
        raise ValueError(f"groups {missing} not found in {group!r}; available: {some}")


def keep_groups(cells: DataFrame, group: str, compare: list[str]) -> DataFrame:
    """Cells of the two groups of a comparison, which must both exist."""
    check_groups(cells, group, compare)
    return cells.where(F.col(group).isin(compare))


def _by_group(expr: DataFrame, cells: DataFrame, genes: DataFrame, group: str, value: str, ranks: bool) -> DataFrame:
    """(gene, group) rows for all combinations, with sums inside the group and over all cells.

    Sums run over non-zeros only. Implicit zeros come back through counts: per gene the few group entries
    are packed in a map and unpacked against the scalar list of group sizes, so gene x group is complete
    without a join.
    """
    tagged = cells.where(F.col(group).isNotNull()).select("cell_id", F.col(group).alias("group"))
    sizes = tagged.groupBy("group").agg(F.count("*").cast("double").alias("n_group"))
    listed = sizes.agg(F.collect_list(F.struct("group", "n_group"))).scalar()
    total = sizes.agg(F.sum("n_group")).scalar()
    v = F.col(value).cast("double")
    rows = expr.where(v != 0).join(tagged, "cell_id").select("gene_id", "group", v.alias("_y"))
    if ranks:
        sums = rank_sums(rows, ["gene_id"], "group", "_y")
    else:
        sums = rows.groupBy("gene_id", "group").agg(
            F.count("*").cast("double").alias("n"), F.sum("_y").alias("s1"), F.sum(F.col("_y") * F.col("_y")).alias("s2")
        )
    parts = [c for c in sums.columns if c not in ("gene_id", "group")]
    packed = sums.groupBy("gene_id").agg(
        F.map_from_entries(F.collect_list(F.struct("group", F.struct(*parts)))).alias("_in"),
        *[F.sum(c).alias(f"all_{c}") for c in parts],
    )
    full = genes.select("gene_id").join(packed, "gene_id", "left")
    spread = full.withColumn("n_all", total).select("*", F.inline_outer(listed)).where(F.col("group").isNotNull())
    own = F.try_element_at("_in", F.col("group"))
    return spread.select(
        "gene_id", "group", "n_group", (F.col("n_all") - F.col("n_group")).alias("n_rest"),
        *[F.coalesce(own[c], F.lit(0.0)).alias(c) for c in parts],
        *[F.coalesce(f"all_{c}", F.lit(0.0)).alias(f"all_{c}") for c in parts],
    )


def _fold_change() -> Column:
    mean1 = F.col("s1") / F.col("n_group")
    mean2 = (F.col("all_s1") - F.col("s1")) / F.col("n_rest")
    return F.log2((F.expm1(mean1) + _EPS) / (F.expm1(mean2) + _EPS))


def wilcoxon_scores(expr: DataFrame, cells: DataFrame, genes: DataFrame, group: str, value: str = "lognorm") -> DataFrame:
    """(group, gene_id, score, logfc): rank-sum z of each group against the rest.

    Ranks are computed once per gene for all groups. Implicit zeros form one tie between the negative
    and the positive values: positives move up by the number of zeros, zeros share their mean rank.
    """
    m = _by_group(expr, cells, genes, group, value, ranks=True)
    n1, n2 = F.col("n_group"), F.col("n_rest")
    zeros_all = n1 + n2 - F.col("all_n")
    zeros_in = n1 - F.col("n")
    rank_sum = (
        F.col("rank_sum") + F.col("n_pos") * zeros_all
        + zeros_in * (F.col("all_n_neg") + (zeros_all + 1) / 2)
    )
    return m.select("group", "gene_id", rank_sum_z(rank_sum, n1, n2).alias("score"), _fold_change().alias("logfc"))


def welch_scores(expr: DataFrame, cells: DataFrame, genes: DataFrame, group: str, value: str = "lognorm") -> DataFrame:
    """(group, gene_id, score, logfc, dof): Welch t of each group against the rest, from one aggregate."""
    m = _by_group(expr, cells, genes, group, value, ranks=False)

    def mean_var(n, s1, s2):
        return s1 / n, F.when(n > 1, F.greatest((s2 - s1 * s1 / n) / (n - 1), F.lit(0.0)))

    n1, n2 = F.col("n_group"), F.col("n_rest")
    m1, v1 = mean_var(n1, F.col("s1"), F.col("s2"))
    m2, v2 = mean_var(n2, F.col("all_s1") - F.col("s1"), F.col("all_s2") - F.col("s2"))
    e1, e2 = v1 / n1, v2 / n2
    error = e1 + e2
    dof = error * error / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1))
    return m.select(
        "group", "gene_id",
        F.coalesce(F.when(error > 0, (m1 - m2) / F.sqrt(error)), F.lit(0.0)).alias("score"),
        _fold_change().alias("logfc"), F.when(error > 0, dof).alias("dof"),
    )


def logreg_scores(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, group: str, value: str = "lognorm",
    c: float = 1.0, max_iter: int = 100,
) -> DataFrame:
    """(group, gene_id, score): coefficients of a multinomial logistic regression on all genes.

    The squared coefficients are penalised with weight ``1 / c`` against the sum of the cells' losses, on the values as they are.
    """
    from pyspark.ml.classification import LogisticRegression

    from cellframe.operators.embed import cell_vectors, index_genes

    tagged = cells.where(F.col(group).isNotNull()).select("cell_id", F.col(group).cast("string").alias("group"))
    names = [r[0] for r in tagged.select("group").distinct().orderBy("group").collect()]
    indexed, gene_list = index_genes(genes)
    data = cell_vectors(expr, tagged.select("cell_id"), indexed, len(gene_list), value)
    code = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("group")) - 1
    train = data.join(tagged.withColumn("label", code.cast("double")), "cell_id").select("features", "label")
    train = store(train)
    penalty = 1.0 / (c * max(train.count(), 1))  # Spark's loss is the cells' mean
    model = LogisticRegression(family="multinomial", regParam=penalty, standardization=False, maxIter=max_iter).fit(train)
    coef = model.coefficientMatrix.toArray()
    if len(names) == 2:  # two classes: the signed contrast, one row per class
        coef = [coef[0] - coef[1], coef[1] - coef[0]] if len(coef) == 2 else [-coef[0], coef[0]]
    rows = [(n, g, float(w)) for n, line in zip(names, coef) for g, w in zip(gene_list, line)]
    return expr.sparkSession.createDataFrame(rows, "group string, gene_id string, score double")


def rank_genes(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, group: str,
    method: str = "wilcoxon", value: str = "lognorm", compare: list[str] | None = None,
) -> DataFrame:
    """Marker genes: each group against the rest, or ``compare[0]`` against ``compare[1]``.

    Returns ``group, gene_id, score, logfc, pval, pval_adj`` (no p for ``logreg``), plus ``group1, group2``
    for a comparison. p-values are corrected within a group, whose size is the number of genes.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    check_groups(cells, group, compare)
    if compare:
        cells = cells.where(F.col(group).isin(compare))
    if method == "logreg":
        out = logreg_scores(expr, cells, genes, group, value)
    elif method == "wilcoxon":
        out = wilcoxon_scores(expr, cells, genes, group, value).withColumn("pval", normal_p("score"))
    else:
        raw = welch_scores(expr, cells, genes, group, value)
        out = raw.withColumn("pval", F.coalesce(student_p("score", "dof"), F.lit(1.0))).drop("dof")
    if compare:
        out = out.where(F.col("group") == compare[0])
    if method != "logreg":
        out = adjust_bounded(out, "pval", ["group"])
    if compare:
        out = out.withColumn("group1", F.lit(compare[0])).withColumn("group2", F.lit(compare[1]))
    return out


def score_ttest(scores: DataFrame, cells: DataFrame, group: str, compare: list[str]) -> DataFrame:
    """Pooled-variance t per source between two groups; a null score in a group makes its result null."""
    tagged = cells.where(F.col(group).isin(compare)).select("cell_id", F.col(group).alias("_g"))
    s = F.col("score")
    first = F.col("_g") == compare[0]

    def moments(cond, tag):
        x = F.when(cond, s)
        return [
            F.count_if(cond).cast("double").alias(f"n{tag}"), F.count(x).alias(f"k{tag}"),
            F.sum(x).alias(f"a{tag}"), F.sum(x * x).alias(f"b{tag}"),
        ]

    m = scores.join(tagged, "cell_id").groupBy("source").agg(*moments(first, 1), *moments(~first, 2))
    n1, n2 = F.col("n1"), F.col("n2")
    mean1 = F.when(F.col("k1") == n1, F.col("a1") / n1)
    mean2 = F.when(F.col("k2") == n2, F.col("a2") / n2)
    within = F.greatest(F.col("b1") - n1 * mean1 * mean1, F.lit(0.0)) + F.greatest(F.col("b2") - n2 * mean2 * mean2, F.lit(0.0))
    error = F.sqrt(within / (n1 + n2 - 2) * (1 / n1 + 1 / n2))
    t = F.when((n1 + n2 > 2) & (error > 0), (mean1 - mean2) / error)
    return m.where((n1 > 0) & (n2 > 0)).select(
        F.col("source").alias("feature"), mean1.alias("mean_group1"), mean2.alias("mean_group2"),
        (mean1 - mean2).alias("mean_difference"), t.alias("t_statistic"), (n1 + n2 - 2).alias("_dof"),
    ).withColumn("pvalue", student_p("t_statistic", "_dof")).drop("_dof").withColumn(
        "group1", F.lit(compare[0])
    ).withColumn("group2", F.lit(compare[1]))


def by_absolute(df: DataFrame, column: str, tie: str) -> DataFrame:
    """Largest absolute value first."""
    return df.orderBy(F.desc(F.abs(column)), tie)


def conditions_by_cluster(scores: DataFrame, cells: DataFrame, cluster: str, condition: str) -> DataFrame:
    """Rank-sum test of each source between a boolean condition, inside every cluster; nulls omitted.

    ``cluster[, net_name], source, stat, pval, delta_mean, pval_adj``, corrected over all tests.
    """
    by = ["cluster", *[c for c in ("net_name",) if c in scores.columns], "source"]
    tagged = cells.select("cell_id", F.col(cluster).alias("cluster"), F.col(condition).cast("boolean").alias("_on"))
    rows = scores.join(tagged.where(F.col("_on").isNotNull() & F.col("cluster").isNotNull()), "cell_id")
    sums = rank_sums(rows, by, "_on", "score")
    on = F.col("_on")

    def pick(cond, c):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0.0))

    m = sums.groupBy(*by).agg(
        pick(on, "n").alias("n1"), pick(~on, "n").alias("n2"), pick(on, "rank_sum").alias("r1"),
        pick(on, "s1").alias("s1"), pick(~on, "s1").alias("s2"),
    )
    tests = m.select(
        *by, rank_sum_z(F.col("r1"), F.col("n1"), F.col("n2")).alias("stat"),
        (F.col("s1") / F.nullif("n1", F.lit(0.0)) - F.col("s2") / F.nullif("n2", F.lit(0.0))).alias("delta_mean"),
    ).withColumn("pval", normal_p("stat"))
    return adjust(tests, "pval")


def significant(df: DataFrame, effect: str = "delta_mean", max_p: float = 0.01, min_effect: float = 1.5) -> DataFrame:
    return df.where((F.col("pval_adj") < max_p) & (F.abs(effect) > min_effect))


def contingency(cells: DataFrame, row: str, column: str) -> DataFrame:
    """Cross-table in long form, zero cells included: ``row, column, observed, expected, residual``."""
    counts = cells.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(
        F.col(row).cast("string").alias("row"), F.col(column).cast("string").alias("column")
    ).agg(F.count("*").cast("double").alias("n"))
    columns = counts.groupBy("column").agg(F.sum("n").alias("column_total"))
    listed = columns.agg(F.collect_list(F.struct("column", "column_total"))).scalar()
    grand = columns.agg(F.sum("column_total")).scalar()
    rows = counts.groupBy("row").agg(
        F.sum("n").alias("row_total"), F.map_from_entries(F.collect_list(F.struct("column", "n"))).alias("_in")
    )
    full = rows.withColumn("_all", grand).select("*", F.inline_outer(listed))
    observed = F.coalesce(F.try_element_at("_in", F.col("column")), F.lit(0.0))
    expected = F.col("row_total") * F.col("column_total") / F.col("_all")
    return full.select(
        "row", "column", observed.alias("observed"), expected.alias("expected"), (observed - expected).alias("residual")
    )


def chi_square(cells: DataFrame, row: str, column: str, yates: bool = True) -> DataFrame:
    """Independence test of two attributes. ``yates`` corrects 2x2 tables only."""
    table = contingency(cells, row, column)
    shape = table.agg(
        F.count_distinct("row").alias("_r"), F.count_distinct("column").alias("_c"),
        F.sum(F.pow(F.col("residual"), 2) / F.col("expected")).alias("_plain"),
        F.sum(
            F.pow(F.abs("residual") - F.least(F.lit(0.5), F.abs("residual")), 2) / F.col("expected")
        ).alias("_yates"),
    )
    dof = (F.col("_r") - 1) * (F.col("_c") - 1)
    stat = F.when((dof == 1) & F.lit(yates), F.col("_yates")).otherwise(F.col("_plain"))
    return shape.select(stat.alias("statistic"), dof.cast("double").alias("dof")).withColumn(
        "pvalue", F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_p("statistic", "dof"))
    )
