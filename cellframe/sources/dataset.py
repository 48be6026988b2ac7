"""A dataset is a folder of Parquet tables: ``cells``, ``genes``, ``expr``, ``scores``, ``edges``, ..."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.operators.summaries import top_per_group
from cellframe.sources.manifest import attach_metadata, concat_samples, list_samples

REQUIRED_TABLE = "cells"

# The instrument's least transcript quality, and its names of control features.
MIN_QV = 20.0
CONTROL_FEATURES = "^(NegControl|BLANK|Blank|antisense_|UnassignedCodeword|DeprecatedCodeword|Intergenic_)"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables in a dataset."""
    fs, target = _fs(spark, root)
    if not fs.exists(target):
        raise FileNotFoundError(f"no dataset at {root}")
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() and not s.getPath().getName().startswith((".", "_")))


def open_dataset(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """All tables (or the named ones) as lazy readers; tables nobody queries are never scanned."""
    found = tables(spark, root)
    if REQUIRED_TABLE not in found:
        raise ValueError(f"dataset {root} has no {REQUIRED_TABLE!r} table; found {found}")
    wanted = names or found
    for n in wanted:
        recover(spark, root, n)
    missing = [n for n in wanted if n not in found]
    if missing:
        raise ValueError(f"dataset {root} has no tables {missing}; found {found}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in wanted}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table, without touching its siblings."""
    recover(spark, root, name)
    return spark.read.parquet(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> None:
    """Replace one table and keep its siblings; the new data may be derived from the table it replaces.

    Written next to the target first and swapped in by renames, so a failed write leaves the old table.
    """
    spark = df.sparkSession
    target = f"{root}/{name}"
    staged = f"{root}/_staged_{name}_{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    fs, old = _fs(spark, target)
    _, new = _fs(spark, staged)
    if fs.exists(old):
        _, aside = _fs(spark, f"{root}/_replaced_{name}_{uuid.uuid4().hex}")
        if not fs.rename(old, aside):
            raise OSError(f"could not move {target} aside")
        if not fs.rename(new, old):
            fs.rename(aside, old)
            raise OSError(f"could not move {staged} to {target}")
        fs.delete(aside, True)
    elif not fs.rename(new, old):
        raise OSError(f"could not move {staged} to {target}")


def write_dataset(parts: dict[str, DataFrame], root: str, overwrite: bool = False) -> None:
    """Write several tables. An existing dataset is an error unless ``overwrite``, which replaces all of it.

    Tables of the old dataset that are not among ``parts`` go once the new ones are written.
    """
    if not parts:
        raise ValueError("no tables to write")
    spark = next(iter(parts.values())).sparkSession
    if exists(spark, root) and not overwrite:
        raise FileExistsError(f"{root} exists; pass overwrite=True to replace its tables")
    old = tables(spark, root) if exists(spark, root) else []
    for name, df in parts.items():
        write_table(df, root, name)
    drop_tables(spark, root, [name for name in old if name not in parts])


def drop_tables(spark: SparkSession, root: str, names: list[str]) -> None:
    """Delete the named tables, those that exist."""
    for name in names:
        fs, target = _fs(spark, f"{root}/{name}")
        fs.delete(target, True)


def _record(root: str, name: str) -> str:
    return f"{root}/_commit_{name}.json"


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below ``path``, relative to it."""
    found = [""]
    for _ in range(depth):
        deeper = []
        for at in found:
            fs, folder = _fs(spark, f"{path}/{at}" if at else path)
            deeper += [f"{at}/{x.getPath().getName()}".lstrip("/") for x in fs.listStatus(folder) if x.isDirectory() and "=" in x.getPath().getName()]
        found = deeper
    return sorted(found)


def recover(spark: SparkSession, root: str, name: str) -> None:
    """Completes a replacement of partitions that was committed but not carried out to the end. Readers and writers call it first."""
    fs, record = _fs(spark, _record(root, name))
    if not fs.exists(record):
        return
    plan = json.loads(_read_text(spark, _record(root, name)))
    staged, aside = f"{root}/{plan['staged']}", f"{root}/{plan['aside']}"
    for leaf in plan["partitions"]:
        _, new = _fs(spark, f"{staged}/{leaf}")
        if not fs.exists(new):
            continue  # done before
        _, old = _fs(spark, f"{root}/{name}/{leaf}")
        _, gone = _fs(spark, f"{aside}/{leaf}")
        if fs.exists(old):
            fs.mkdirs(gone.getParent())
            if not fs.rename(old, gone):
                raise OSError(f"could not move {old} aside")
        fs.mkdirs(old.getParent())
        if not fs.rename(new, old):
            raise OSError(f"could not move {new} to {old}")
    fs.delete(record, False)
    for path in (staged, aside):
        fs.delete(_fs(spark, path)[1], True)


def update_partitions(df: DataFrame, root: str, name: str, by: list[str]) -> None:
    """Replace only the partitions (for example samples) that occur in ``df``, all of them or none.

    The new partitions are written next to the table; a record that names them commits the change. Until then the old ones stay
    as they are, so a write that fails leaves them; from then on whoever reads or writes the table first carries the record out.
    """
    spark = df.sparkSession
    recover(spark, root, name)
    tag = uuid.uuid4().hex
    staged = f"_staged_{name}_{tag}"
    df.write.partitionBy(*by).parquet(f"{root}/{staged}")
    plan = {"staged": staged, "aside": f"_replaced_{name}_{tag}", "partitions": _leaves(spark, f"{root}/{staged}", len(by))}
    fs, draft = _fs(spark, f"{root}/_draft_{name}_{tag}.json")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(plan).encode()))
    finally:
        out.close()
    if not fs.rename(draft, _fs(spark, _record(root, name))[1]):
        raise OSError(f"could not commit the partitions of {root}/{name}")
    recover(spark, root, name)


def _files_of(spark: SparkSession, path: str, name: str) -> str:
    for suffix in (".parquet", ".csv.gz", ".csv", ""):
        if exists(spark, file := f"{path}/{name}{suffix}"):
            return file
    raise FileNotFoundError(f"no {name} table in {path}")


def _read_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Parquet or CSV files of one table in one read, with ``_file``, the place of each row's file."""
    csv = [f for f in files if f.endswith((".csv", ".csv.gz"))]
    columnar = [f for f in files if f not in csv]
    parts = []
    if columnar:
        parts.append(spark.read.option("mergeSchema", "true").parquet(*columnar))
    if csv:
        parts.append(spark.read.csv(csv, header=True, inferSchema=True))
    return concat_samples([p.withColumn("_file", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")) for p in parts])


def _instrument_tables(cells: DataFrame, spots: DataFrame, min_qv: float | None, keep: list[str]) -> dict[str, DataFrame]:
    """Raw ``cells`` and ``transcripts`` -> cells, genes and counts, per value of the columns ``keep``."""
    cells = cells.select(
        F.col("cell_id").cast("string").alias("cell_id"), F.col("x_centroid").cast("double").alias("x"),
        F.col("y_centroid").cast("double").alias("y"), *keep,
    )
    inside = ~F.col("cell_id").cast("string").isin("UNASSIGNED", "-1")
    gene = ~F.col("feature_name").rlike(CONTROL_FEATURES)
    inside = inside & gene
    if min_qv is not None and "qv" in spots.columns:
        inside = inside & (F.col("qv").isNull() & F.lit(bool(keep)) | (F.col("qv") >= min_qv))
    expr = spots.where(inside).groupBy(
        F.col("cell_id").cast("string").alias("cell_id"), F.col("feature_name").alias("gene_id"), *keep
    ).agg(F.count("*").cast("double").alias("value"))
    genes = spots.where(gene).select(F.col("feature_name").alias("gene_id"), *keep).distinct()
    return {"cells": cells, "genes": genes, "expr": expr.select("cell_id", "gene_id", "value", *keep)}


def read_instrument_folder(spark: SparkSession, path: str, min_qv: float | None = MIN_QV) -> dict[str, DataFrame]:
    """Raw sample folder: ``cells`` and ``transcripts`` (Parquet, else CSV) -> cells, genes and counts.

    Counts are one partial aggregate over transcripts. Transcripts outside cells, below the quality ``min_qv`` (where the
    table has a quality) and of control features are left out, as in the instrument's own matrix.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"no sample folder at {path}")
    raw, spots = (_read_files(spark, [_files_of(spark, path, name)]).drop("_file") for name in ("cells", "transcripts"))
    return _instrument_tables(raw, spots, min_qv, [])


def _home(spark: SparkSession, path: str) -> str:
    """The place of a file or folder as Spark names it in ``_metadata.file_path``."""
    fs, target = _fs(spark, path)
    return re.sub("^file:/+", "file:/", fs.makeQualified(target).toUri().toString())


def _tagged(df: DataFrame, homes: DataFrame, home) -> DataFrame:
    """Rows with the samples that read them; a folder that several samples name is read for each."""
    return df.drop("sample").withColumn("_home", home).join(F.broadcast(homes), "_home").drop("_home", "_file")


def _check_dataset(spark: SparkSession, root: str, names: tuple) -> None:
    if not exists(spark, root):
        raise FileNotFoundError(f"no dataset at {root}")
    for n in names:
        recover(spark, root, n)
        if not exists(spark, f"{root}/{n}"):
            raise ValueError(f"dataset {root} has no table {n!r}")


def load_samples(spark: SparkSession, manifest: DataFrame, stored_suffix: str = ".dataset") -> dict[str, DataFrame]:
    """Union of all samples of a manifest, cells tagged with sample and metadata.

    Paths that end with ``stored_suffix`` are stored datasets, others raw sample folders. All folders of a kind are one read of each
    table, whatever their number, and rows find their sample by the place of their file. The manifest, at most ``MAX_SAMPLES`` rows, is
    sent to the rows: few samples would be few keys, and all rows of a sample one task. Columns that some samples lack are null
    there; transcripts without a quality stay, since some samples may have none. Cell ids get the sample as prefix, so equal ids of
    different samples stay apart.
    """
    samples = list_samples(manifest)
    if not samples:
        raise ValueError("no samples to concatenate")
    stored = [(s, p.rstrip("/")) for s, p in samples if p.rstrip("/").endswith(stored_suffix)]
    raw = [(s, p.rstrip("/")) for s, p in samples if not p.rstrip("/").endswith(stored_suffix)]
    names = ("cells", "genes", "expr")
    kinds = []
    if stored:
        folders = sorted({p for _, p in stored})
        for p in folders:
            _check_dataset(spark, p, names)
        homes = spark.createDataFrame([(s, _home(spark, p)) for s, p in stored], "sample string, _home string")
        part = {}
        for n in names:
            read = spark.read.option("mergeSchema", "true").parquet(*(f"{p}/{n}" for p in folders)).withColumn("_file", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/"))
            part[n] = _tagged(read, homes, F.regexp_extract("_file", f"^(.*)/{n}/", 1))
        kinds.append(part)
    if raw:
        folders = sorted({p for _, p in raw})
        lost = [p for p in folders if not exists(spark, p)]
        if lost:
            raise FileNotFoundError(f"no sample folder at {lost[0]}")
        homes = spark.createDataFrame([(s, _home(spark, p)) for s, p in raw], "sample string, _home string")
        tables_ = []
        for n in ("cells", "transcripts"):
            read = _read_files(spark, [_files_of(spark, p, n) for p in folders])
            tables_.append(_tagged(read, homes, F.regexp_extract("_file", rf"^(.*)/{n}(?:\.|/|$)", 1)))
        kinds.append(_instrument_tables(*tables_, MIN_QV, ["sample"]))
    tag = F.concat_ws("-", "sample", F.col("cell_id").cast("string"))
    return {
        "cells": attach_metadata(concat_samples([k["cells"].withColumn("cell_id", tag) for k in kinds]), F.broadcast(manifest)),
        "genes": concat_samples([k["genes"].select("gene_id") for k in kinds]).distinct(),
        "expr": concat_samples([k["expr"].withColumn("cell_id", tag).drop("sample") for k in kinds]),
    }


def write_ranked(ranked: DataFrame, folder: str, tag: str, n_top: int = 100) -> dict[str, str]:
    """Full ranking and the top ``n_top`` rows of every group as CSV folders named after ``tag``."""
    order = [F.desc("score"), F.asc("gene_id")]
    paths = {"all": f"{folder}/de_genes_all_{tag}", "top": f"{folder}/de_genes_top{n_top}_{tag}"}
    ranked.write.mode("overwrite").csv(paths["all"], header=True)
    top_per_group(ranked, "group", order, n_top).write.mode("overwrite").csv(paths["top"], header=True)
    return paths
