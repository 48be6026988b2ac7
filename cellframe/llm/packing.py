"""Packing of token ids into rows of fixed length: best-fit-decreasing with a segment tree over free capacities.

Every document's ids, with an end id, are cut into segments of at most ``length`` ids (losslessly: the cuts are kept as (doc_id,
first id)). A task packs the segments of a few thousand documents at a time: in order of falling length, each goes to the row with the least
capacity left that it fits in, found by descending a segment tree over the capacities, or else opens a row. No shuffle: which
documents meet in a row does not matter, and rows of such a batch are nearly full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import bpe, common
from cellframe.llm.registry import query

LENGTH = 2048
#: Ids that a task packs at a time, about; a batch's memory is a small multiple of its bytes.
BATCH_IDS = 2_000_000

SCHEMA = (
    "n_tokens int, doc_ids array<bigint>, doc_starts array<int>, cu_seqlens array<int>, ids binary, positions binary"
)


class Capacities:
    """A segment tree over 0..length: which free capacities occur among the rows."""

    def __init__(self, length: int):
        self.size = 1 << (length + 1).bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        k = capacity + self.size
        while k and not self.any[k]:
            self.any[k] = 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (capacity, row) of the least capacity of at least ``need``."""
        k = need + self.size
        if not self.any[k]:
            while k > 1 and (k & 1 or not self.any[k + 1]):  # up to the first node whose right neighbour has one
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.size:
                k *= 2
                if not self.any[k]:
                    k += 1
        capacity = k - self.size
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self.any[k] = 0
            k >>= 1
            while k:
                if self.any[2 * k] or self.any[2 * k + 1]:
                    break
                self.any[k] = 0
                k >>= 1
        return capacity, row


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of segment numbers, each of at most ``length`` ids; equal sizes in the order given."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for s in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[s])
        found = free.take(size)
        if found is None:
            rows.append([s])
            left, row = length - size, len(rows) - 1
        else:
            left, row = found[0] - size, found[1]
            rows[row].append(s)
        if left:
            free.add(left, row)
    return rows


def pack_batch(doc_ids: list, flat: np.ndarray, counts: np.ndarray, length: int, pad: int) -> pa.RecordBatch:
    """Packed rows of documents whose ids stand in ``flat`` one after another."""
    pieces = -(-counts // length)
    doc = np.repeat(np.arange(len(counts)), pieces)
    first = common.ragged(np.zeros(len(counts), np.int64), pieces) * length
    sizes = np.minimum(counts[doc] - first, length)
    start = (np.cumsum(counts) - counts)[doc] + first
    rows = best_fit_decreasing(sizes, length)
    n, own, begins, cu, ids, positions = [], [], [], [], [], []
    for r in rows:
        ends = np.cumsum(sizes[r])
        out = np.full(length, pad, "<i4")
        out[:ends[-1]] = flat[common.ragged(start[r], sizes[r])]
        place = np.zeros(length, "<i4")
        place[:ends[-1]] = common.ragged(np.zeros(len(r), np.int64), sizes[r])
        n.append(int(ends[-1]))
        own.append([doc_ids[d] for d in doc[r]])
        begins.append(first[r].astype(np.int32))
        cu.append(np.concatenate([[0], ends]).astype(np.int32))
        ids.append(out.tobytes())
        positions.append(place.tobytes())
    return pa.RecordBatch.from_arrays([
        pa.array(n, pa.int32()), pa.array(own, pa.list_(pa.int64())), pa.array(begins, pa.list_(pa.int32())),
        pa.array(cu, pa.list_(pa.int32())), pa.array(ids, pa.binary()), pa.array(positions, pa.binary()),
    ], ["n_tokens", "doc_ids", "doc_starts", "cu_seqlens", "ids", "positions"])


@lru_cache(maxsize=2)
def _library(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def _ids(path: str, pattern: str, texts: list[str | None], end_id: int) -> list[np.ndarray]:
    """The ids of each text, and the end id behind them."""
    encode = _library(path, pattern).encode_to_numpy
    end = np.array([end_id], np.int32)
    return [np.concatenate([encode(t, disallowed_special=()).astype(np.int32), end]) if t else end for t in texts]


def pack(docs: DataFrame, path: str, pattern: str, end_id: int, length: int = LENGTH, batch_ids: int = BATCH_IDS) -> DataFrame:
    """Packed rows of all ids of ``docs`` (doc_id, text), each document's followed by ``end_id``.

    A row: its ids as ``length`` little-endian 32-bit numbers (filled up with ``end_id``; rows put together are an id matrix), how
    many of them count, the position of each within its segment, the segments' cumulative lengths, and their documents with the number
    of the first id. A null or empty text is its end id alone; a null doc_id stays null; repeated rows are packed each; no row, no
    output. ``pack_id`` is a hash of the row's documents and ids: the same however often a partition is computed, and equal only for
    rows with the same documents and ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        flats: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for part in common.parts(batch, 1):
                each = _ids(path, pattern, part.column(1).to_pylist(), end_id)
                flats += each
                counts.append(np.array([len(x) for x in each], np.int64))
                ids += part.column(0).to_pylist()
                held += int(counts[-1].sum())
                if held >= batch_ids:
                    yield pack_batch(ids, np.concatenate(flats), np.concatenate(counts), length, end_id)
                    ids, flats, counts, held = [], [], [], 0
        if held:
            yield pack_batch(ids, np.concatenate(flats), np.concatenate(counts), length, end_id)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(common.tidy(run), SCHEMA)
    return rows.select(F.xxhash64("doc_ids", "doc_starts", "ids").alias("pack_id"), "*")


def fill_rate(packed: DataFrame) -> DataFrame:
    """(rows, n_tokens, fill): how many rows there are, ids that count, and their share of all places; no rows, a null share."""
    places = F.sum(F.octet_length("ids") / 4)
    return packed.agg(F.count("*").alias("rows"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), (F.sum("n_tokens") / places).alias("fill"))


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, first, ids): the segments of packed rows, from which every document can be put together again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, starts, cu, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                row = np.frombuffer(data, "<i4")
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(starts, pa.int32()),
                    pa.array([row[a:b] for a, b in zip(cu, cu[1:])], pa.list_(pa.int32())),
                ], ["doc_id", "first", "ids"])

    return packed.select("doc_ids", "doc_starts", "cu_seqlens", "ids").mapInArrow(common.tidy(run), "doc_id bigint, first int, ids array<int>")


@query("op6_packed_ids")
def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return pack(common.documents(spark, sf_dir), path, public_tokenizers.PATTERN, end_id=50_256)
