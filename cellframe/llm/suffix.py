"""Removal of byte strings that occur earlier in the corpus, by external induced sorting of suffix shards.

A shard has to hold every copy of a 100-byte string, but no more text than that takes. Each string is therefore sent where its
*anchor* says: the least hash among its 32-byte grams. Equal strings have equal anchors, and consecutive strings mostly share
theirs, so they travel together as one fragment.

1. *Anchors*: fragments' anchor hashes are counted (packed, a few bytes for some 35 bytes of text). A fragment whose anchor occurs
   once in the corpus holds no repeated string; only the others go on.
2. *Sort*: a shard keeps each distinct fragment once, with its earliest place, and sorts their suffixes by
   :mod:`cellframe.llm.induced`. Suffixes whose common prefix reaches 100 bytes are copies; all but the earliest are removed.
3. *Merge* and *cut*: the removed ranges of a document are put together, and the document without them is hashed.

Shards follow ``spark.sql.shuffle.partitions``; the sort's queues and ranks go to disk beyond ``MEMORY``, but a
shard's fragments, text, types and classes are held in memory and a shard is not split, so memory grows with the largest. Hashes only choose shards and fragments: a
collision costs a little work and never a result, since strings are compared by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import common, packets
from cellframe.llm.induced import END, equal_classes
from cellframe.llm.registry import query
from cellframe.session import store

LENGTH = 100
GRAM = 32
#: Bytes of a shard's distinct fragments that are sorted in memory; a larger shard uses the task's disk.
MEMORY = 1 << 25
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_PIECE = 500_000
_SLICE = 2_000_000
_NO_ID = -(2 ** 63)


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def fragments(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per run of strings with one anchor: the anchor's hash, the text's number, first byte and end byte of the run.

    Ranges cover the run's strings whole; a tie of hashes goes to the leftmost gram, which depends on the string alone.
    """
    n = np.array([len(t) for t in texts], np.int64)
    starts = np.maximum(n - length + 1, 0)
    if not starts.sum():
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty, empty, empty
    h = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    size = 1
    while size < gram:  # polynomial hash by doubling; gram is a power of two
        m = np.uint64(pow(_MULTIPLIER, size, 1 << 64))
        h = h[:-size] * m + h[size:]
        size *= 2
    h = common.mix(h)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    window, size = length - gram + 1, 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:
        low = np.minimum(low[:size - window], low[window - size:])
    text = np.repeat(np.arange(len(texts)), starts)
    base = np.cumsum(n) - n
    at = common.ragged(base, starts)
    anchor = (low[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    t = text[first]
    return h[anchor[first]], t, at[first] - base[t], at[last] - base[t] + length


def _all_fragments(texts: list[bytes], length: int, gram: int):
    parts, at = [], 0
    for lo, hi in common.slices(texts, _PIECE):
        h, t, a, b = fragments(texts[lo:hi], length, gram)
        parts.append((h, t + lo, a, b))
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3]


def _part_of(doc: np.ndarray, n: int) -> np.ndarray:
    return (common.mix(doc.view(np.uint64)) % np.uint64(n)).astype(np.int64)


def _pack_ranges(doc: np.ndarray, a: np.ndarray, b: np.ndarray, n: int):
    """(part, packed ranges) of ranges in any order: marks of their starts, then their lengths."""
    part = _part_of(doc, n)
    order = np.lexsort((a, doc, part))
    doc, a, b, part = doc[order], a[order], b[order], part[order]
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    for x, y in zip(cuts, np.append(cuts[1:], len(part))):
        yield int(part[x]), packets.pack_marks(doc[x:y], a[x:y]) + packets.planes(b[x:y] - a[x:y], 4)


def _unpack_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    doc, a, used = packets.unpack_marks(data)
    return doc, a, a + packets.from_planes(memoryview(data)[used:], len(doc), 4).astype(np.int64)


def _union(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that overlap or touch put together, by document."""
    if not len(doc):
        return doc, a, b
    order = np.lexsort((a, doc))
    doc, a, b = doc[order], a[order], b[order]
    group = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    step = np.int64(1) << 31  # a text has fewer bytes, and a part fewer than 2^32 documents
    reach = np.maximum.accumulate(b + group * step) - group * step
    new = np.append(True, (group[1:] != group[:-1]) | (a[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return doc[first], a[first], reach[np.append(first[1:], len(doc)) - 1]


def _merge(frame: pd.DataFrame, column: str) -> pd.DataFrame:
    """(doc_id, spans) of the packed ranges of one part."""
    found = [_unpack_ranges(d) for d in frame["data"]]
    doc, a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    doc, a, b = _union(doc, a, b)
    own = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else doc
    pairs = np.stack([a, b], axis=1).astype(np.int32)
    spans = [pairs[x:y].reshape(-1) for x, y in zip(own, np.append(own[1:], len(doc)))]
    return pd.DataFrame({"doc_id": doc[own], column: spans})


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def suspects(docs: DataFrame, length: int, gram: int, n: int) -> DataFrame:
    """(doc_id, suspect): per document the byte ranges of fragments whose anchor occurs elsewhere too. ``docs``: doc_id (not null), text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found):
            keys, data = zip(*found) if found else ((), ())
            return _batch({"bucket": pa.array(keys, pa.int32()), "data": pa.array(data, pa.binary())})

        for batch in batches:
            for part in common.parts(batch, 1, _SLICE):
                h, t, a, b = _all_fragments([_bytes(x) for x in part.column(1).to_pylist()], length, gram)
                doc = np.asarray(part.column(0)).astype(np.int64)[t]
                by = np.argsort(h, kind="stable")
                same = h[by[1:]] == h[by[:-1]]
                twice = np.zeros(len(h), bool)  # the slice itself has the anchor again
                twice[by[1:][same]] = True
                twice[by[:-1][same]] = True
                yield rows([(-1 - p, d) for p, d in _pack_ranges(doc[twice], a[twice], b[twice], n)])
                first = np.sort(by[np.append(True, ~same)]) if len(by) else by
                h, doc, a, b = h[first], doc[first], a[first], b[first]
                bucket = (common.mix(h) % np.uint64(n)).astype(np.int64)
                by = np.lexsort((a, doc, bucket))
                h, doc, a, b = h[by], doc[by], a[by], b[by]
                cuts = np.searchsorted(bucket[by], np.arange(n + 1))
                yield rows([
                    (k, packets.pack_marks(doc[x:y], a[x:y]) + packets.planes(b[x:y] - a[x:y], 4) + packets.planes(h[x:y], 4))
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x
                ])

    def count(bucket: pd.DataFrame) -> pd.DataFrame:
        key = int(bucket["bucket"].iloc[0])
        if key < 0:
            return pd.DataFrame({"part": -1 - key, "data": bucket["data"]})
        found = []
        for data in bucket["data"]:
            doc, a, used = packets.unpack_marks(data)
            rest = memoryview(data)[used:]
            found.append((doc, a, a + packets.from_planes(rest, len(doc), 4).astype(np.int64), packets.from_planes(rest[4 * len(doc):], len(doc), 4)))
        doc, a, b, h = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(h, kind="stable")
        same = h[by[1:]] == h[by[:-1]]
        again = by[np.append(same, False) | np.append(False, same)]
        out = list(_pack_ranges(doc[again], a[again], b[again], n))
        return pd.DataFrame({"part": [p for p, _ in out], "data": [d for _, d in out]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return _merge(part, "suspect")

    sent = docs.mapInArrow(common.tidy(send), "bucket int, data binary")
    found = sent.groupBy("bucket").applyInPandas(count, "part int, data binary")
    return found.groupBy("part").applyInPandas(merge, "doc_id bigint, suspect array<int>")


def sort_shard(contents: list[bytes], doc: np.ndarray, start: np.ndarray, length: int, memory: int = MEMORY):
    """Ranges (doc, a, b) of strings that also start earlier, of fragments with their places."""
    order = np.lexsort((start, doc))
    number: dict[bytes, int] = {}
    own = np.array([number.setdefault(contents[i], len(number)) for i in order.tolist()], np.int64)
    doc, start = doc[order], start[order]
    size = np.array([len(c) for c in number], np.int64)
    _, first = np.unique(own, return_index=True)  # the earliest place of each distinct fragment
    later = (doc != doc[first[own]]) | (start != start[first[own]])
    out = [(doc[later], start[later], start[later] + size[own[later]])]
    text = np.frombuffer(b"".join(c + bytes([END]) for c in number), np.uint8)
    base = np.cumsum(size + 1) - size - 1
    kind, pos = equal_classes(text, length, memory)
    piece = np.searchsorted(base, pos, side="right") - 1
    inside = pos - base[piece] + length <= size[piece]
    kind, pos, piece = kind[inside], pos[inside], piece[inside]
    d, a = doc[first[piece]], start[first[piece]] + pos - base[piece]
    by = np.lexsort((a, d, kind))
    kind, d, a = kind[by], d[by], a[by]
    if len(kind):
        head = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
        lead = head[np.cumsum(np.append(True, kind[1:] != kind[:-1])) - 1]
        late = (d != d[lead]) | (a != a[lead])
        out.append(_union(d[late], a[late], a[late] + length))
    return _union(*(np.concatenate(x) for x in zip(*out)))


def repeats(texts: DataFrame, length: int, gram: int, n: int, memory: int = MEMORY) -> DataFrame:
    """(doc_id, spans): the byte ranges to remove. ``texts``: doc_id, text and the ranges of suspect fragments."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kinds, keys, data, sizes):
            return _batch({
                "kind": pa.array(kinds, pa.int32()), "key": pa.array(keys, pa.int32()), "data": pa.array(data, pa.binary()),
                "content": pa.array(sizes, pa.binary()),
            })

        for batch in batches:
            for part in common.parts(batch, 1, _SLICE):
                raw = [_bytes(x) for x in part.column(1).to_pylist()]
                h, t, a, b = _all_fragments(raw, length, gram)
                inside = np.zeros(len(t), bool)
                cuts = np.searchsorted(t, np.arange(len(raw) + 1))
                for k, found in enumerate(part.column(2).to_pylist()):
                    spans = np.array(found, np.int64)
                    x, y = cuts[k], cuts[k + 1]
                    at = np.searchsorted(spans[::2], a[x:y], side="right") - 1
                    inside[x:y] = (at >= 0) & (b[x:y] <= spans[1::2][np.maximum(at, 0)])
                h, t, a, b = h[inside], t[inside], a[inside], b[inside]
                doc = np.asarray(part.column(0)).astype(np.int64)[t]
                order = np.lexsort((a, doc)).tolist()
                seen: dict[bytes, int] = {}
                later, kept = [], []
                for i in order:
                    c = raw[t[i]][a[i]:b[i]]
                    j = seen.setdefault(c, i)
                    if j == i or (doc[i] == doc[j] and a[i] == a[j]):
                        kept.append((i, c))
                    else:
                        later.append(i)  # an earlier fragment of the slice is equal as a whole
                for p, d in _pack_ranges(doc[later], a[later], b[later], n):
                    yield rows([1], [p], [d], [b""])
                shard = (common.mix(h + np.uint64(1)) % np.uint64(n)).astype(np.int64)
                groups: dict[int, list[int]] = {}
                for k, (i, _) in enumerate(kept):
                    groups.setdefault(int(shard[i]), []).append(k)
                for s, ks in groups.items():
                    i = np.array([kept[k][0] for k in ks])
                    marks = packets.pack_marks(doc[i], a[i]) + packets.planes(b[i] - a[i], 4)
                    yield rows([0], [s], [marks], [b"".join(kept[k][1] for k in ks)])

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        if int(group["kind"].iloc[0]) == 1:
            return pd.DataFrame({"part": group["key"], "data": group["data"]})
        docs, starts, contents = [], [], []
        for data, content in zip(group["data"], group["content"]):
            doc, a, b = _unpack_ranges(data)
            docs.append(doc)
            starts.append(a)
            ends = np.cumsum(b - a)
            contents += [content[x:y] for x, y in zip((ends - (b - a)).tolist(), ends.tolist())]
        found = sort_shard(contents, np.concatenate(docs), np.concatenate(starts), length, memory)
        out = list(_pack_ranges(*found, n))
        return pd.DataFrame({"part": [p for p, _ in out], "data": [d for _, d in out]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        return _merge(part, "spans")

    sent = texts.mapInArrow(common.tidy(send), "kind int, key int, data binary, content binary")
    found = sent.groupBy("kind", "key").applyInPandas(sort, "part int, data binary")
    return found.groupBy("part").applyInPandas(merge, "doc_id bigint, spans array<int>")


def _digest(data: bytes, spans) -> tuple[int, int, int, str]:
    kept, at, gone = hashlib.sha256(), 0, 0
    for a, b in zip(spans[::2], spans[1::2]):
        kept.update(data[at:a])
        gone += min(b, len(data)) - min(a, len(data))
        at = b
    kept.update(data[at:])
    return len(data), gone, len(spans) // 2, kept.hexdigest()


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, memory: int = MEMORY) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text).

    A null text is empty. A null id stands for the smallest one; rows that share an id are taken for repeats of one document, so
    the same place in two of them is no earlier start.
    """
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))
    rows = docs.select(key.alias("doc_id"), F.col("doc_id").isNull().alias("anonymous"), "text")
    found = suspects(rows.where("text is not null").select("doc_id", "text"), length, gram, n)
    joined = rows.join(found.hint("shuffle_hash"), "doc_id", "left")
    # texts without suspect fragments are done; only the others are kept
    plain = F.coalesce("text", F.lit(""))
    split = store(joined.select(
        "doc_id", "anonymous", "suspect", F.octet_length(plain).cast("bigint").alias("n_bytes"),
        F.when(F.col("suspect").isNull(), F.sha2(plain.cast("binary"), 256)).alias("kept_sha256"),
        F.when(F.col("suspect").isNotNull(), F.col("text")).alias("text"),
    ))
    some = split.where("suspect is not null")
    spans = store(repeats(some.select("doc_id", "text", "suspect"), length, gram, n, memory))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_digest(_bytes(t.as_py()), s.as_py() or []) for t, s in zip(batch.column("text"), batch.column("spans"))]
            cols = list(zip(*done)) if done else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield _batch({
                "doc_id": batch.column("doc_id"), "anonymous": batch.column("anonymous"),
                **{k: pa.array(c, t) for k, c, t in zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), cols, kinds)},
            })

    cut = some.select("doc_id", "anonymous", "text").join(spans.hint("shuffle_hash"), "doc_id", "left").mapInArrow(
        common.tidy(run), "doc_id bigint, anonymous boolean, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    whole = split.where("suspect is null").select(
        "doc_id", "anonymous", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), "kept_sha256"
    )
    out = whole.unionByName(cut)
    return out.withColumn("doc_id", F.when(~F.col("anonymous"), F.col("doc_id"))).drop("anonymous")


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.documents(spark, sf_dir))
