"""Gene-set scores per cell: univariate (ULM) and multivariate (MLM) linear models.

Both need only sums over non-zeros plus closed forms. ``net(source, target, weight)`` may carry a
``net_name`` column: several resources are then scored in one pass over the expression table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe.session import store

#: All models of one call, matrices of (sources + 1) squared doubles, may take so many bytes on the driver and in each worker.
MAX_MODEL_BYTES = 512 * 1024 * 1024
#: A network of at most so many edges is broadcast: few genes would be few keys, and all values of a gene one task.
MAX_SENT_EDGES = 500_000


def _named(net: DataFrame) -> DataFrame:
    weight = F.col("weight").cast("double") if "weight" in net.columns else F.lit(1.0)
    name = F.col("net_name") if "net_name" in net.columns else F.lit("")
    return net.select(name.alias("net_name"), "source", F.col("target").alias("gene_id"), weight.alias("weight"))


def usable_net(net: DataFrame, genes: DataFrame, tmin: int = 2) -> DataFrame:
    """Edges whose target is in the data, of sources that keep at least ``tmin`` targets."""
    by = [c for c in ("net_name", "source") if c in net.columns]
    seen = net.join(genes.select(F.col("gene_id").alias("target")).distinct(), "target", "left_semi")
    enough = seen.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") >= tmin).drop("_n")
    return seen.join(enough, by, "left_semi")


def check_no_repeats(net: DataFrame) -> None:
    """Repeated (source, target) edges would make the model matrix ambiguous."""
    by = [c for c in ("net_name", "source", "target") if c in net.columns]
    bad = net.groupBy(*by).count().where("count > 1").orderBy(*by).limit(5).collect()
    if bad:
        raise ValueError(f"repeated network edges: {[tuple(r)[:-1] for r in bad]}")


def _catalog(net: DataFrame) -> DataFrame:
    """(net_name, source, j, sx, sxx): the sources numbered 0, 1, ... by name, with the sums of their weights and squares."""
    sums = net.groupBy("net_name", "source").agg(F.sum("weight").alias("sx"), F.sum(F.col("weight") * F.col("weight")).alias("sxx"))
    return sums.withColumn("j", F.row_number().over(Window.orderBy("net_name", "source")) - 1)


def _cell_sums(expr: DataFrame, net: DataFrame, catalog: DataFrame, width: Column, value: str) -> DataFrame:
    """Per cell: ``sy``, ``syy`` and the array ``sxy`` with the sum of weight * value of each source, at its number.

    The network is packed to one row per gene, so the expression table meets it in one equi join; it is broadcast unless it has more
    than ``MAX_SENT_EDGES`` edges, so the expression table stays where it is. Every
    row also feeds an entry numbered -1 that carries the cell totals, so one aggregate by (cell, source) and one
    by cell serve all three results; on a table already hashed by cell neither shuffles. The array is filled up with zeros between the
    sources a cell has, in one pass over them.
    """
    numbered = net.join(catalog.select("net_name", "source", "j"), ["net_name", "source"])
    packed = numbered.groupBy("gene_id").agg(F.collect_list(F.struct("j", F.col("weight").alias("w"))).alias("_hits"))
    if net.limit(MAX_SENT_EDGES + 1).count() <= MAX_SENT_EDGES:
        packed = F.broadcast(packed)
    entry = "array<struct<j:int,w:double>>"
    totals = F.expr(f"cast(array(named_struct('j', -1, 'w', 1.0D)) as {entry})")
    hits = F.concat(totals, F.coalesce(F.col("_hits").cast(entry), F.array().cast(entry)))
    y = F.col(value)
    spread = expr.join(packed, "gene_id", "left").select("cell_id", y.alias("_y"), F.explode(hits).alias("_e"))
    per_source = spread.groupBy("cell_id", F.col("_e.j").alias("j")).agg(
        F.sum(F.col("_y") * F.col("_e.w")).alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("_syy")
    )
    by_cell = per_source.groupBy("cell_id").agg(
        F.max(F.when(F.col("j") < 0, F.col("s"))).alias("sy"), F.max(F.when(F.col("j") < 0, F.col("_syy"))).alias("syy"),
        F.sort_array(F.collect_list(F.struct("j", "s"))).alias("e"),
    ).withColumn("_width", width)
    following = F.concat(F.transform(F.slice("e", 2, F.size("e")), lambda x: x["j"]), F.array("_width"))
    pieces = F.zip_with("e", following, lambda x, nxt: F.concat(F.array(x["s"]), F.array_repeat(F.lit(0.0), nxt - x["j"] - 1)))
    return by_cell.select("cell_id", "sy", "syy", F.slice(F.flatten(pieces), F.lit(2), F.col("_width")).alias("sxy"))


def ulm_scores(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, net: DataFrame,
    tmin: int = 2, value: str = "lognorm",
) -> DataFrame:
    """``(cell_id[, net_name], source, score)``: t-value of the slope of expression on weight over all genes.

    Every cell of ``cells`` is scored against every source, whether or not it expresses a target.
    """
    net_kept = _named(usable_net(net, genes, tmin))
    n_genes = genes.agg(F.count_distinct("gene_id")).scalar()
    catalog = _catalog(net_kept)
    # A scalar array of one entry per source, exploded per cell next to the cell's sums: the output size itself, no join.
    names = catalog.agg(F.sort_array(F.collect_list(F.struct("j", "net_name", "source", "sx", "sxx")))).scalar()
    width = catalog.agg(F.count("*").cast("int")).scalar()
    sums = cells.select("cell_id").join(_cell_sums(expr, net_kept, catalog, width, value), "cell_id", "left")
    filled = F.coalesce("sxy", F.transform("_names", lambda _: F.lit(0.0)))
    g, sy = F.col("_g"), F.col("sy")
    vy = F.col("syy") - sy * sy / g

    def correlation(n: Column, xy: Column) -> Column:
        vx = n["sxx"] - n["sx"] * n["sx"] / g
        r = F.when((vx > 0) & (F.col("_vy") > 0), (xy - n["sx"] * sy / g) / F.sqrt(vx * F.col("_vy")))
        return F.struct(n["net_name"].alias("net_name"), n["source"].alias("source"), r.alias("r"))

    def t_value(e: Column) -> Column:
        rest = (1 - e["r"]) * (1 + e["r"])
        score = F.when(rest > 0, e["r"] * F.sqrt((g - 2) / rest))
        return F.struct(e["net_name"].alias("net_name"), e["source"].alias("source"), score.alias("score"))

    # Scores are made inside the array: as columns of the exploded rows, a later filter on them would repeat the whole formula many times.
    cells_with = sums.withColumn("_g", n_genes.cast("double")).withColumn("_names", names).withColumn("_vy", vy)
    out = cells_with.select("cell_id", F.inline(F.transform(F.zip_with("_names", filled, correlation), t_value)))
    return out if "net_name" in net.columns else out.drop("net_name")


def _overlaps(net: DataFrame, catalog: DataFrame) -> DataFrame:
    """(i, j, s): products of weights over shared targets of any two sources of one network, i <= j."""
    numbered = net.join(catalog.select("net_name", "source", "j"), ["net_name", "source"]).select("net_name", "gene_id", "j", "weight")
    other = numbered.select("net_name", "gene_id", F.col("j").alias("i"), F.col("weight").alias("_w"))
    met = numbered.join(other, ["net_name", "gene_id"]).where("i <= j")
    return met.groupBy("i", "j").agg(F.sum(F.col("weight") * F.col("_w")).alias("s"))


def _mlm_inverse(sources: list[str], gram: np.ndarray, name: str) -> np.ndarray:
    """The inverse of the Gram matrix of intercept and sources."""
    n_genes = int(gram[0, 0])
    if n_genes <= len(sources) + 1:
        raise ValueError(f"{n_genes} genes leave no degree of freedom for {len(sources)} sources")
    scale = 1 / np.sqrt(np.diag(gram))
    scaled = gram * scale[:, None] * scale[None, :]
    values, vectors = np.linalg.eigh(scaled)
    if values[0] < 1e-10:
        involved = [s for s, v in zip(["intercept", *sources], np.abs(vectors[:, 0])) if v > 0.1]
        raise ValueError(f"network {name!r}: linearly dependent sources {involved[:10]}")
    return np.linalg.inv(scaled) * scale[:, None] * scale[None, :]


def _models(net: DataFrame, catalog: DataFrame, n_genes: int, max_bytes: int) -> list[tuple[str, list[str], np.ndarray]]:
    """(net_name, sources, inverse) of each network. Spark makes the matrices; no row of a network comes to the driver."""
    names = catalog.orderBy("j").collect()
    groups: dict[str, list] = {}
    for r in names:
        groups.setdefault(r["net_name"], []).append(r)
    need = sum(8 * (len(g) + 1) ** 2 for g in groups.values())
    if need > max_bytes:
        raise ValueError(f"models of {', '.join(str(len(g)) for g in groups.values())} sources take {need} bytes, more than {max_bytes}")
    cells = _overlaps(net, catalog).toArrow()
    i, j, s = (cells.column(c).to_numpy() for c in ("i", "j", "s"))
    out, first = [], 0
    for name, rows in groups.items():
        gram = np.zeros((len(rows) + 1,) * 2)
        gram[0, 0] = n_genes
        gram[0, 1:] = gram[1:, 0] = [r["sx"] for r in rows]
        own = (i >= first) & (i < first + len(rows))
        gram[i[own] - first + 1, j[own] - first + 1] = gram[j[own] - first + 1, i[own] - first + 1] = s[own]
        out.append((name, [r["source"] for r in rows], _mlm_inverse([r["source"] for r in rows], gram, name)))
        first += len(rows)
    return out


def mlm_scores(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, net: DataFrame,
    tmin: int = 2, value: str = "lognorm", max_bytes: int = MAX_MODEL_BYTES,
) -> DataFrame:
    """``(cell_id[, net_name], source, score)``: t-value of each source in one joint model with intercept.

    The model matrix is the same for all cells: its products come from a join of the network with itself on the target. Only the
    (sources + 1)² inverse of each network is formed on the driver and broadcast, and all of them may take ``max_bytes``. The per-cell
    right-hand sides are arrays that Spark has made, multiplied in Arrow batches.
    """
    usable = _named(usable_net(net, genes, tmin))
    n_genes = genes.select("gene_id").distinct().count()
    catalog = store(_catalog(usable))
    models = _models(usable, catalog, n_genes, max_bytes)
    names = [(name, s) for name, sources, _ in models for s in sources]
    width = len(names)
    sums = cells.select("cell_id").join(_cell_sums(expr, usable, catalog, F.lit(width), value), "cell_id", "left")
    schema = T.StructType([
        sums.schema["cell_id"], T.StructField("net_name", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("score", T.DoubleType()),
    ])
    if not names:
        return expr.sparkSession.createDataFrame([], schema)
    shared = expr.sparkSession.sparkContext.broadcast(models)
    right = sums.select(
        "cell_id", F.coalesce("sy", F.lit(0.0)).alias("sy"), F.coalesce("syy", F.lit(0.0)).alias("syy"),
        F.coalesce("sxy", F.array_repeat(F.lit(0.0), width)).alias("sxy"),
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sy, syy = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sy", "syy"))
            xy = batch.column("sxy").flatten().to_numpy(zero_copy_only=False).reshape(len(sy), width)
            scores = np.empty((len(sy), width))
            first = 0
            for _, sources, inverse in shared.value:
                v = np.column_stack([sy, xy[:, first:first + len(sources)]])
                beta = v @ inverse
                rss = np.maximum(syy - (beta * v).sum(axis=1), 0.0)
                error = np.sqrt(np.diag(inverse)[None, :] * rss[:, None] / (n_genes - len(sources) - 1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = np.where(error > 0, beta / error, np.nan)
                scores[:, first:first + len(sources)] = t[:, 1:]
                first += len(sources)
            flat = pa.array(scores.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sy) + 1, dtype=np.int32) * width), flat)
            yield pa.RecordBatch.from_arrays([batch.column("cell_id"), lists], ["cell_id", "scores"])

    packed = right.mapInArrow(solve, T.StructType([sums.schema["cell_id"], T.StructField("scores", T.ArrayType(T.DoubleType()))]))
    listed = catalog.agg(F.sort_array(F.collect_list(F.struct("j", "net_name", "source")))).scalar()
    rows = packed.withColumn("_names", listed).select("cell_id", F.inline(F.arrays_zip(F.col("_names").alias("n"), F.col("scores").alias("score"))))
    out = rows.select("cell_id", "n.net_name", "n.source", F.nanvl("score", F.lit(None)).alias("score"))
    return out if "net_name" in net.columns else out.drop("net_name")


def enrichment_scores(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, net: DataFrame, method: str = "mlm",
    tmin: int = 2, value: str = "lognorm", mask: DataFrame | None = None,
) -> DataFrame:
    """Scores by either method. With ``mask`` (a subset of cells), the other cells get null scores."""
    score = {"ulm": ulm_scores, "mlm": mlm_scores}.get(method)
    if score is None:
        raise ValueError(f"method must be 'mlm' or 'ulm', got {method!r}")
    check_no_repeats(net)
    if mask is None:
        return score(expr, cells, genes, net, tmin, value)
    chosen = mask.select("cell_id")
    scored = score(expr.join(chosen, "cell_id", "left_semi"), chosen, genes, net, tmin, value)
    left_out = cells.select("cell_id").join(chosen, "cell_id", "left_anti")
    by = [c for c in ("net_name", "source") if c in scored.columns]
    kept = usable_net(net, genes, tmin).select(*by).distinct()
    names = kept.agg(F.collect_list(F.struct(*by))).scalar()
    empty = left_out.select("cell_id", F.inline_outer(names)).withColumn("score", F.lit(None).cast("double"))
    return scored.unionByName(empty.where(F.col("source").isNotNull()))


def missing_targets(net: DataFrame, genes: DataFrame) -> DataFrame:
    """Network targets that the data does not measure."""
    known = genes.select(F.col("gene_id").alias("target"))
    return net.select("target").distinct().join(known, "target", "left_anti")


def present_markers(net: DataFrame, genes: DataFrame) -> DataFrame:
    """Network edges whose target is in the data; sources without any drop out."""
    return net.join(genes.select(F.col("gene_id").alias("target")), "target", "left_semi")
