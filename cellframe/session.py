"""Session defaults and the stored intermediate tables that iterative operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def local_session(cores: str = "*", app: str = "cellframe", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass your own session instead."""
    n = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only by a ``local`` master that names none.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="cellframe-")
    return _local_root


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back.

    Cuts the lineage of iterative operators; the files outlive lost executors, keep column pruning and
    are computed once (an eager checkpoint evaluates its last stage twice).
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cellframe-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table written by :func:`store` that no later step reads."""
    path = getattr(df, "_stored_at", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
