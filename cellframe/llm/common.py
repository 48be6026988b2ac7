"""Small helpers that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Text is worked off in slices of about so many characters, so a worker's memory does not follow the batch size.
SLICE_CHARS = 1_000_000
#: Rows of an Arrow batch inside ``small_batches``: the JVM and the worker hold whole batches of texts beside all else.
BATCH_ROWS = 500


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column (case ignored) has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: bytes.split() cuts at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_ascii(text: str | None) -> list[bytes]:
    """The words with A-Z (and nothing else) in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters in all; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


#: What a worker's modules remember and can do without: called when a task ends.
FORGET: list[Callable[[], None]] = []


def tidy(fn):
    """``fn`` over Arrow batches; when the task is done, the worker gives its memory back to the machine.

    Spark keeps workers for later tasks, also of other operators, and an executor's memory has to do for all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            for forget in FORGET:
                forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library keeps what it has
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside send ``BATCH_ROWS`` rows at most to a worker at a time; the session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = int(before)
    spark.conf.set(name, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parts(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes in a text column each, so that only so much becomes Python objects."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    group = (np.cumsum(size) - 1) // limit if len(size) else size
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(size) else size
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(size)).tolist()):
        yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads close values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``start, start + 1, ...`` of the given lengths."""
    lengths = lengths.astype(np.int64)
    if not len(lengths) or not lengths.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def with_columns(df: DataFrame, text: str, added: list[tuple[str, DataType]], fn) -> DataFrame:
    """``df`` with the columns that ``fn(texts) -> list of Arrow arrays`` makes of each slice of ``text``, row by row."""
    schema = StructType([*df.schema.fields, *(StructField(n, t) for n, t in added)])
    names = [n for n, _ in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text):
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(part.column(text).to_pylist())], [*part.schema.names, *names])

    return df.mapInArrow(tidy(run), schema)


def crc_fold(column: str, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n
