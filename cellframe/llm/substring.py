"""Removal of word passages that occur earlier in the corpus: Rabin-Karp hashes of every fixed-length window.

1. *Hash*: every task hashes the windows of a slice of documents by two Rabin-Karp polynomials, drops the windows whose
   hash the slice has already had (those are repeats) and sends the first ones, packed, to a bucket named by one of the
   polynomials. A window that thousands of documents share is thus sent once per slice.
2. *Count*: a bucket groups its windows by all bits of the other polynomial; all but the earliest of a group are repeats.
3. *Merge*: the repeats of a document come together and are merged into maximal spans of words.
4. *Cut*: documents are joined with their spans by id.

Two different windows are taken for equal only if all 61 bits agree within a bucket: about 2e-7 for a bucket of a million windows,
3e-5 for one of 12 million. The number of buckets is set by ``spark.sql.shuffle.partitions`` and not by the input, so the chance
grows with the data unless that setting does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cellframe.llm import common, oracles, packets
from cellframe.llm.registry import query

WINDOW = 20
_P = (1 << 61) - 1
_BASES = (1_113_871_470_261_530_123, 842_502_087_349_201_907)
_SLICE = 2_000_000
_HASH_BYTES = 8
_NO_ID = -(2 ** 63)


class WordHashes(dict):
    """64-bit hash of each word, remembered; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _times(a: np.ndarray, b: int) -> np.ndarray:
    """a * b modulo 2^61 - 1, for a, b below it, by 32-bit halves."""
    p, low = np.uint64(_P), np.uint64(0xFFFFFFFF)
    al, ah = a & low, a >> np.uint64(32)
    bl, bh = np.uint64(b & 0xFFFFFFFF), np.uint64(b >> 32)
    mid = al * bh + ah * bl  # below 2^62
    out = al * bl
    out = (out & p) + (out >> np.uint64(61))
    out += ((mid & np.uint64(0x1FFFFFFF)) << np.uint64(32)) + (mid >> np.uint64(29))
    out = (out & p) + (out >> np.uint64(61))
    out += (ah * bh) << np.uint64(3)
    out = (out & p) + (out >> np.uint64(61))
    return np.where(out >= p, out - p, out)


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    s = a + b
    return np.where(s >= np.uint64(_P), s - np.uint64(_P), s)


def rabin_karp(x: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2^61 - 1 of every ``window`` consecutive numbers, by doubling the length."""
    x = x % np.uint64(_P)
    done: np.ndarray | None = None  # hashes of the first `length` numbers from each start
    length, part, size = 0, x, 1
    while True:
        if window & size:
            if done is None:
                done, length = part, size
            else:  # the new part goes in front
                n = len(x) - (length + size) + 1
                done = _plus(_times(part[:n], pow(base, length, _P)), done[size:size + n])
                length += size
        if size * 2 > window:
            return done
        n = len(part) - size
        part = _plus(_times(part[:n], pow(base, size, _P)), part[size:size + n])
        size *= 2


def _windows(texts: list[str | None], hashes: WordHashes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: two hashes, number of its text, first word."""
    words = [hashes.of(common.words_of(t)) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    x = np.concatenate(words) if words else np.zeros(0, np.uint64)
    starts = np.maximum(n - window + 1, 0)
    if not starts.sum():
        empty = np.zeros(0, np.uint64)
        return empty, empty, empty.astype(np.int64), empty.astype(np.int64)
    at = common.ragged(np.cumsum(n) - n, starts)
    a, b = (rabin_karp(x, window, base)[at] for base in _BASES)
    text = np.repeat(np.arange(len(texts)), starts)
    return common.mix(a), common.mix(b), text, at - (np.cumsum(n) - n)[text]


def _later(by: np.ndarray, key: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For rows in the order ``by``, where each key's first row is its earliest: does a row have another place than that?"""
    if not len(by):
        return np.zeros(0, bool)
    new = np.append(True, key[by[1:]] != key[by[:-1]])
    first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return (doc[by] != doc[first]) | (pos[by] != pos[first])


def removed_spans(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): for each document with repeats, the word ranges ``start, end, start, end, ...`` to remove.

    A word is removed if a window over it also starts earlier: in a document with a smaller id, or before in the same one.
    Rows with one id count as one document; a null id stands for the smallest one.
    """
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.coalesce(F.col(doc_id), F.lit(_NO_ID)).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    source = source.where("text is not null")

    def hash_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def rows(found):
            keys, data = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

        for batch in batches:
            for part in common.parts(batch, 1, _SLICE):
                ids, texts = np.asarray(part.column(0)).astype(np.int64), part.column(1).to_pylist()
                order = np.argsort(ids, kind="stable")
                a, b, at, pos = _windows([texts[i] for i in order], hashes, window)
                doc = ids[order][at]
                by = np.argsort(a, kind="stable")
                again = np.zeros(len(a), bool)
                again[by] = _later(by, a, doc, pos)
                group = (common.mix(doc[again].view(np.uint64)) % np.uint64(n)).astype(np.int64)
                yield rows([(-1 - g, d) for g, d in packets.marks_by_group(doc[again], pos[again], group)])
                a, doc, pos, bucket = a[~again], doc[~again], pos[~again], (b[~again] % np.uint64(n)).astype(np.int32)
                by = np.argsort(bucket, kind="stable")
                a, doc, pos, bucket = a[by], doc[by], pos[by], bucket[by]
                cuts = np.searchsorted(bucket, np.arange(n + 1))
                for first in range(0, n, 64):
                    yield rows([
                        (k, packets.pack_marks(doc[x:y], pos[x:y]) + packets.planes(a[x:y], _HASH_BYTES))
                        for k, x, y in zip(range(first, n), cuts[first:], cuts[first + 1:first + 65]) if y > x
                    ])

    def count(bucket: pd.DataFrame) -> pd.DataFrame:
        if not len(bucket):
            return pd.DataFrame({"part": [], "data": []})
        key = int(bucket["bucket"].iloc[0])
        if key < 0:  # repeats that the hashing tasks found themselves
            return pd.DataFrame({"part": -1 - key, "data": bucket["data"]})
        docs, places, hashes = [], [], []
        for data in bucket["data"]:
            d, p, used = packets.unpack_marks(data)
            docs.append(d)
            places.append(p.astype(np.int32))
            hashes.append(packets.from_planes(memoryview(data)[used:], len(d), _HASH_BYTES))
        doc, pos, h = np.concatenate(docs), np.concatenate(places), np.concatenate(hashes)
        by = np.argsort(h, kind="stable")
        equal = h[by[1:]] == h[by[:-1]]
        several = np.append(equal, False) | np.append(False, equal)
        by = by[several]
        by = by[np.lexsort((pos[by], doc[by], h[by]))]
        late = by[_later(by, h, doc, pos)]
        group = (common.mix(doc[late].view(np.uint64)) % np.uint64(n)).astype(np.int64)
        found = list(packets.marks_by_group(doc[late], pos[late], group))
        return pd.DataFrame({"part": [g for g, _ in found], "data": [d for _, d in found]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        marks = [packets.unpack_marks(d)[:2] for d in part["data"]]
        if not marks:
            return pd.DataFrame({"doc_id": [], "spans": []})
        doc, pos = (np.concatenate([m[k] for m in marks]) for k in (0, 1))
        by = np.lexsort((pos, doc))
        doc, pos = doc[by], pos[by]
        new = np.append(True, (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + window))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(pos)) - 1
        pairs = np.stack([pos[starts], pos[ends] + window], axis=1)
        own = np.flatnonzero(np.append(True, doc[starts[1:]] != doc[starts[:-1]]))
        spans = [pairs[x:y].reshape(-1).astype(np.int32) for x, y in zip(own, np.append(own[1:], len(pairs)))]
        return pd.DataFrame({"doc_id": doc[starts[own]], "spans": spans})

    sent = source.mapInArrow(common.tidy(hash_windows), "bucket int, data binary")
    late = sent.groupBy("bucket").applyInPandas(count, "part int, data binary")
    return late.groupBy("part").applyInPandas(merge, "doc_id bigint, spans array<int>")


def _digest(text: str | None, spans) -> tuple[int, int, str]:
    words = common.words_of(text)
    gone = 0
    if spans is not None:
        kept, at = [], 0
        for a, b in zip(spans[::2], spans[1::2]):
            kept += words[at:a]
            at = min(b, len(words))
            gone += max(0, at - a)
        words, n = kept + words[at:], len(words)
    else:
        n = len(words)
    return n, gone, hashlib.sha256(b" ".join(words)).hexdigest()


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(text: str, spans) -> str:
    """``text`` without the words of the spans and the white space after them; what stays is unchanged."""
    starts = [m.start() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        if a >= len(starts):
            break
        out.append(text[at:starts[a]])
        at = starts[b] if b < len(starts) else len(text)
    return "".join([*out, text[at:]])


def with_spans(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, str]:
    """``docs`` with the column of :func:`removed_spans` (null: nothing to remove), and that column's name."""
    key, spans = common.free_name(docs.columns, "_key"), common.free_name(docs.columns, "_spans")
    found = removed_spans(docs, window).select(F.col("doc_id").alias(key), F.col("spans").alias(spans))
    mine = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_NO_ID))
    return docs.join(found.hint("shuffle_hash"), mine == F.col(key), "left").drop(key), spans


def dedup_text(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cut (and ``n_chars``, if there, counted anew); every row stays, also if its text is then empty.

    Null texts stay null; rows without repeats stay as they are.
    """
    joined, spans = with_spans(docs, window)
    out = joined.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, where = batch.column("text").to_pylist(), batch.column(spans).to_pylist()
            new = [t if s is None or t is None else cut(t, s) for t, s in zip(texts, where)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    done = joined.mapInArrow(common.tidy(run), out)
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(counted))
    return done.select(*docs.columns)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; a null text has no words."""
    joined, spans = with_spans(docs.select("doc_id", "text"), window)
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()),
        StructField("n_removed", LongType()), StructField("kept_sha256", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_digest(t.as_py(), s.as_py()) for t, s in zip(batch.column("text"), batch.column(spans))]
            n, gone, sha = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return joined.mapInArrow(common.tidy(run), schema)


@query("op8_substring_dedup", oracles.SUBSTRING)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.documents(spark, sf_dir))
