"""Sparse cell vectors and principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellframe.session import store

MAX_GENES = 500_000  # a block of directions, genes x components, is held on the driver and sent to every task
MAX_COVARIANCE_GENES = 8192  # the covariance of the chosen genes is held on the driver: 8192² doubles = 512 MB
OVERSAMPLE = 10  # directions beyond the wanted components
_ENTRIES = 100_000  # non-zeros multiplied at a time
_STRIPE = 256  # genes whose partial products travel together


def index_genes(genes: DataFrame) -> tuple[DataFrame, list]:
    """(gene_id, idx) in gene order, and that order; the gene list is bounded and checked.

    It is broadcast where it is joined: few genes would be few keys, and all values of a gene one task.
    """
    names = [r[0] for r in genes.select("gene_id").distinct().orderBy("gene_id").limit(MAX_GENES + 1).collect()]
    if len(names) > MAX_GENES:
        raise ValueError(f"more than {MAX_GENES} genes")
    spark = genes.sparkSession
    schema = T.StructType([genes.schema["gene_id"], T.StructField("idx", T.IntegerType())])
    return F.broadcast(spark.createDataFrame([(g, i) for i, g in enumerate(names)], schema)), names


def _entries(expr: DataFrame, cells: DataFrame, indexed: DataFrame, value: str) -> DataFrame:
    """(cell_id, _e): the non-zeros (idx, v) of every cell in gene order, none for cells without counts.

    The rows of one cell are bounded by the number of genes.
    """
    entries = (
        expr.join(indexed, "gene_id").where(F.col(value) != 0).groupBy("cell_id")
        .agg(F.sort_array(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("v")))).alias("_e"))
    )
    empty = F.array().cast("array<struct<idx:int,v:double>>")
    return cells.select("cell_id").join(entries, "cell_id", "left").withColumn("_e", F.coalesce("_e", empty))


def cell_vectors(expr: DataFrame, cells: DataFrame, indexed: DataFrame, size: int, value: str = "lognorm") -> DataFrame:
    """(cell_id, features): one sparse ML vector per cell, empty for cells without counts.

    Vectors are aggregated as the struct that stores a sparse vector and read back from Parquet as
    vectors, so no row passes through Python.
    """
    sparse = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.col("_e.idx").alias("indices"), F.col("_e.v").alias("values"),
    )
    stored = store(_entries(expr, cells, indexed, value).select("cell_id", sparse.alias("features")))
    schema = T.StructType([cells.schema["cell_id"], T.StructField("features", VectorUDT())])
    out = expr.sparkSession.read.schema(schema).parquet(stored._stored_at)
    out._stored_at = stored._stored_at
    return out


def _csr(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gene numbers and values of all rows of (idx, v) one after another, and where each row ends."""
    lengths = pc.list_value_length(batch.column("idx")).to_numpy(zero_copy_only=False).astype(np.int64)
    idx, v = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("idx", "v"))
    return idx, v, np.cumsum(lengths)


def _chunks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``_ENTRIES`` non-zeros each."""
    start, n = 0, len(ends)
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + _ENTRIES, side="right")))
        yield start, min(stop, n)
        start = stop


def _times(idx: np.ndarray, v: np.ndarray, ends: np.ndarray, q: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, slice]:
    """Rows a..b times ``q``, the row of each of their non-zeros, and where those stand."""
    low = ends[a - 1] if a else 0
    own = slice(low, ends[b - 1])
    lengths = np.diff(np.append(low, ends[a:b]))
    row = np.repeat(np.arange(b - a), lengths)
    y = np.zeros((b - a, q.shape[1]))
    if len(row):
        filled = np.flatnonzero(lengths)
        y[filled] = np.add.reduceat(v[own, None] * q[idx[own]], (np.cumsum(lengths) - lengths)[filled])
    return y, row, own


def _gram_product(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """AᵀA q for the sparse rows A (idx, v). Every task adds up its own rows; the stripes of genes are added up in Spark."""
    n_genes, width = q.shape
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(q)
    n_stripes = -(-n_genes // _STRIPE)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        z = np.zeros((n_stripes * _STRIPE, width))
        for batch in batches:
            idx, v, ends = _csr(batch)
            for a, b in _chunks(ends):
                y, row, own = _times(idx, v, ends, shared.value, a, b)
                if len(row):
                    order = np.argsort(idx[own], kind="stable")
                    gene, first = np.unique(idx[own][order], return_index=True)
                    z[gene] += np.add.reduceat((v[own, None] * y[row])[order], first)
        parts = z.reshape(n_stripes, _STRIPE, width)
        used = np.flatnonzero(parts.any(axis=(1, 2)))
        deal = TaskContext.get().partitionId() % 32
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(np.full(len(used), deal), pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())
        ], ["stripe", "deal", "z"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(z.as_buffer()) for z in table.column("z")], axis=0)
        return pa.Table.from_arrays([table.column("stripe")[:1], table.column("deal")[:1], pa.array([total.tobytes()], pa.binary())], ["stripe", "deal", "z"])

    schema = "stripe int, deal int, z binary"
    partial = rows.select("idx", "v").mapInArrow(multiply, schema)
    dealt = partial.groupBy("stripe", "deal").applyInArrow(add, schema)  # at most 32 tables are added up under one stripe afterwards
    out = np.zeros((n_stripes * _STRIPE, width))
    for r in dealt.groupBy("stripe").applyInArrow(add, schema).collect():
        out[r["stripe"] * _STRIPE:(r["stripe"] + 1) * _STRIPE] = np.frombuffer(r["z"]).reshape(_STRIPE, width)
    shared.unpersist()
    return out[:n_genes]


def _subspace(rows: DataFrame, n_cells: int, mean: np.ndarray, k: int, seed: int, tol: float, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of the centred rows' scatter matrix and their directions, by subspace iteration from a random block."""
    n_genes = len(mean)
    width = min(k + OVERSAMPLE, n_genes)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_genes, width)))
    before = np.full(k, np.inf)
    for turn in range(max(passes, 1)):
        z = _gram_product(rows, q) - n_cells * np.outer(mean, mean @ q)
        values, turned = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        axes = q @ turned[:, :k]
        if width == n_genes or np.abs(values[:k] - before).max() <= tol * max(values[0], 1e-300):
            break
        before = values[:k]
        q, _ = np.linalg.qr(z @ turned)
    return np.maximum(values[:k], 0.0), axes


def _randomized(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, indexed: DataFrame, names: list, k: int, value: str, seed: int, tol: float, passes: int
) -> dict[str, DataFrame]:
    spark = expr.sparkSession
    rows = store(_entries(expr, cells, indexed, value).select("cell_id", F.col("_e.idx").alias("idx"), F.col("_e.v").alias("v")))
    n_cells = rows.count()
    sums = expr.join(indexed, "gene_id").join(cells.select("cell_id"), "cell_id", "left_semi").groupBy("idx").agg(
        F.sum(F.col(value).cast("double")).alias("s1"), F.sum(F.col(value).cast("double") * F.col(value)).alias("s2")
    ).toArrow()
    s1, s2 = np.zeros(len(names)), np.zeros(len(names))
    at = sums.column("idx").to_numpy()
    s1[at], s2[at] = sums.column("s1").to_numpy(), sums.column("s2").to_numpy()
    mean = s1 / max(n_cells, 1)
    total = float((s2 - n_cells * mean * mean).sum())
    values, axes = _subspace(rows, n_cells, mean, k, seed, tol, passes)
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), range(k)] < 0, -1.0, 1.0)
    shared = spark.sparkContext.broadcast((axes, mean @ axes))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, shift = shared.value
        for batch in batches:
            idx, v, ends = _csr(batch)
            y = np.concatenate([_times(idx, v, ends, directions, a, b)[0] for a, b in _chunks(ends)]) - shift if len(ends) else np.zeros((0, k))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("cell_id"), lists], ["cell_id", "vector"])

    shape = T.StructType([cells.schema["cell_id"], T.StructField("vector", T.ArrayType(T.DoubleType()))])
    listed = pa.table({"idx": pa.array(range(len(names)), pa.int32()), "loadings": pa.array(list(axes), pa.list_(pa.float64()))})
    loadings = spark.createDataFrame(listed).join(indexed, "idx").select("gene_id", F.posexplode("loadings").alias("component", "loading"))
    ratios = [(c + 1, float(x) / total if total > 0 else 0.0) for c, x in enumerate(values)]
    return {
        "embedding": rows.mapInArrow(project, shape),
        "loadings": loadings.select("gene_id", (F.col("component") + 1).alias("component"), "loading"),
        "variance": spark.createDataFrame(ratios, "component int, ratio double"),
    }


SOLVERS = ("covariance", "randomized")


def pca(
    expr: DataFrame, cells: DataFrame, genes: DataFrame, n_comps: int = 50, value: str = "lognorm", solver: str | None = None,
    seed: int = 0, tol: float = 1e-9, passes: int = 50,
) -> dict[str, DataFrame]:
    """Principal components of the given (variable) genes.

    Returns ``embedding(cell_id, vector)``, ``loadings(gene_id, component, loading)`` and
    ``variance(component, ratio)``. Scores are centred and the largest loading of a component is positive.

    ``solver='covariance'`` holds the covariance of at most ``MAX_COVARIANCE_GENES`` genes on the driver. ``'randomized'`` takes any number
    of genes up to ``MAX_GENES``: a random block of ``n_comps`` + OVERSAMPLE directions is multiplied with the rows and back, pass by
    pass, until the variances change by less than ``tol`` of the first, or ``passes`` are done (variances are then a little too low). It
    is the default where the other can't be.
    """
    indexed, names = index_genes(genes)
    solver = solver or ("covariance" if len(names) <= MAX_COVARIANCE_GENES else "randomized")
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {SOLVERS}, got {solver!r}")
    if solver == "randomized":
        return _randomized(expr, cells, genes, indexed, names, min(n_comps, len(names)), value, seed, tol, passes)
    if len(names) > MAX_COVARIANCE_GENES:
        raise ValueError(f"{len(names)} genes; a covariance holds at most {MAX_COVARIANCE_GENES}")
    data = cell_vectors(expr, cells, indexed, len(names), value)
    k = min(n_comps, len(names))
    model = PCA(k=k, inputCol="features", outputCol="projected").fit(data)
    axes = model.pc.toArray()
    sign = np.sign(axes[np.abs(axes).argmax(axis=0), range(k)])
    sign[sign == 0] = 1.0
    mean = data.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
    # The model projects uncentred vectors, so the projected mean is subtracted here.
    shift = F.array(*[F.lit(float(v)) for v in mean @ axes])
    flip = F.array(*[F.lit(float(v)) for v in sign])
    centred = F.zip_with(F.zip_with(vector_to_array("projected"), shift, lambda a, b: a - b), flip, lambda a, b: a * b)
    spark = expr.sparkSession
    loadings = [
        (g, c + 1, float(axes[i, c] * sign[c])) for i, g in enumerate(names) for c in range(k)
    ]
    ratios = [(c + 1, float(r)) for c, r in enumerate(model.explainedVariance.toArray())]
    load_schema = T.StructType([
        genes.schema["gene_id"], T.StructField("component", T.IntegerType()), T.StructField("loading", T.DoubleType())
    ])
    return {
        "embedding": model.transform(data).select("cell_id", centred.alias("vector")),
        "loadings": spark.createDataFrame(loadings, load_schema),
        "variance": spark.createDataFrame(ratios, "component int, ratio double"),
    }
