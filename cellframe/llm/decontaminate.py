"""Benchmark decontamination: rare n-gram seeds find candidate passages, Smith-Waterman alignment scores them.

Words are compared in lower case (A-Z) with ASCII punctuation taken as white space, so case and punctuation do not hide a copy.

1. One pass counts how often each benchmark word occurs in the corpus (only counts come back, one per word and task).
2. An n-gram of an item is a *rare seed* if the product of its words' shares says that chance alone would bring it up in at
   most ``rate`` of all places. Rarity is judged by expectation and not by how often the n-gram was seen: a passage that leaked
   into thousands of documents is still rare by chance. Items with less than ``LEAST_SEEDS`` such n-grams use their rarest.
3. A second pass finds the seeds, and aligns the item with the words around every seed (match 1, mismatch and gap -1). A
   passage counts as a copy if the local alignment's score reaches ``threshold`` of the item's length, or ``long_match``.
4. Items of fewer than ``LEAST_WORDS`` words can't be told from chance by an edited copy. They are looked for as they are: a text that
   consists of the item's words holds it, and one that has them somewhere does if they are as rare by chance as a seed has to be.

The benchmark is worked off in blocks of at most about ``BLOCK_WORDS`` words, one pass over the documents each; only a block is ever
broadcast. Nothing of the corpus but word counts reaches the driver, and no row is shuffled but these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from cellframe.llm import common
from cellframe.llm.registry import query
from cellframe.llm.substring import WordHashes, rabin_karp

SEED = 3
#: Items with fewer words are not aligned, only found unchanged.
LEAST_WORDS = 5
LEAST_SEEDS = 4
RATE = 1e-8
THRESHOLD = 0.5
LONG_MATCH = 30
BLOCK_WORDS = 1_000_000
REMEMBERED = 400_000  # words whose hashes a worker keeps

_FLAT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
_BASE = 1_240_013_777_231_899_447
_HITS = ArrayType(StructType([
    StructField("item_id", LongType()), StructField("score", DoubleType()),
    StructField("start_word", IntegerType()), StructField("end_word", IntegerType()),
]))


def plain_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FLAT).split() if text else []


class Table:
    """Finds which of many 64-bit numbers are in a small sorted set; a bit table sorts out nearly all others first."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << max(16, int(len(keys)).bit_length() + 5), bool)
        self.mask = np.uint64(len(self.bits) - 1)
        self.bits[(common.mix(keys) & self.mask).astype(np.int64)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``x`` of members, and their places in ``keys``."""
        at = np.flatnonzero(self.bits[(common.mix(x) & self.mask).astype(np.int64)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.keys, x[at]), len(self.keys) - 1)
        ok = self.keys[place] == x[at]
        return at[ok], place[ok]


def align(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman scores of ``item`` against each row of ``passages``, with the last item word and passage word aligned."""
    k, width = passages.shape
    across = np.arange(width, dtype=np.int32)
    row = np.zeros((k, width), np.int32)
    best, end_i, end_j = np.zeros(k, np.int32), np.full(k, -1), np.full(k, -1)
    for i, word in enumerate(item):
        step = np.where(passages == word, 1, -1).astype(np.int32)
        step[:, 1:] += row[:, :-1]
        step = np.maximum(np.maximum(step, row - 1), 0)
        row = np.maximum.accumulate(step + across, axis=1) - across  # gaps in the item: one less per word skipped
        j = row.argmax(axis=1)
        top = row[np.arange(k), j]
        better = top > best
        best[better], end_i[better], end_j[better] = top[better], i, j[better]
    return best, end_i, end_j


@dataclass
class Block:
    """A block of the benchmark as arrays: item ids, their words, and the seeds with where they come from."""

    ids: list
    words: list[np.ndarray]
    keys: np.ndarray | None = None  # sorted distinct seeds
    first: np.ndarray | None = None  # places of a seed: item and offset between first[k] and first[k + 1]
    item: np.ndarray | None = None
    offset: np.ndarray | None = None
    short: dict[int, tuple[np.ndarray, list[list[int]]]] | None = None  # by length: sorted hashes of whole items, and the items of each
    rare: list[bool] | None = None  # of an item: found anywhere, and not just as a whole text
    state: tuple | None = None  # of a worker

    def choose_seeds(self, share: dict[int, float], rate: float) -> None:
        keys, items, offsets = [], [], []
        short: dict[int, dict[int, list[int]]] = {}
        self.rare = [False] * len(self.words)
        for i, w in enumerate(self.words):
            if len(w) < LEAST_WORDS:
                own = int(rabin_karp(w, len(w), _BASE)[0])
                short.setdefault(len(w), {}).setdefault(own, []).append(i)
                self.rare[i] = sum(np.log(max(share.get(int(x), 0.0), 1e-12)) for x in w) <= np.log(rate)
                continue
            grams = rabin_karp(w, SEED, _BASE)
            logs = np.log([max(share.get(int(x), 0.0), 1e-12) for x in w])
            chance = sum(logs[k:len(logs) - SEED + 1 + k] for k in range(SEED))
            use = chance <= np.log(rate)
            if use.sum() < LEAST_SEEDS:
                use[np.argsort(chance, kind="stable")[:LEAST_SEEDS]] = True
            at = np.flatnonzero(use)
            keys.append(grams[at])
            items.append(np.full(len(at), i))
            offsets.append(at)
        k, it, off = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, items, offsets))
        by = np.lexsort((off, it, k))
        self.keys, first = np.unique(k[by].astype(np.uint64), return_index=True)
        self.first, self.item, self.offset = np.append(first, len(k)), it[by], off[by]
        self.short = {n: (np.array(sorted(of), np.uint64), [of[k] for k in sorted(of)]) for n, of in short.items()}


def _count_words(docs: DataFrame, blocks_words: np.ndarray, text: str) -> tuple[dict[int, float], float]:
    """Share of each benchmark word (by hash) among all words of the documents."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(blocks_words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes = Table(vocabulary.value), WordHashes(REMEMBERED)
        n, total = np.zeros(len(table.keys), np.int64), 0
        for batch in batches:
            for part in common.parts(batch, 0):
                x = np.concatenate([hashes.of(plain_words(t)) for t in part.column(0).to_pylist()])
                total += len(x)
                n += np.bincount(table.find(x)[1], minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(n[at], total), pa.int64())], ["word", "n"]
        )

    rows = docs.select(text).mapInArrow(common.tidy(count), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    total = max(found.pop(-1, 0), 1)
    vocabulary.unpersist()
    return {int(blocks_words[k]): v / total for k, v in found.items()}, total


def _passages(block: Block, item: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, first word, end word) of the parts of one document to align; seeds on close diagonals go together."""
    by = np.lexsort((diagonal, item))
    item, diagonal = item[by], diagonal[by]
    out: list[tuple[int, int, int]] = []
    for i, d in zip(item.tolist(), diagonal.tolist()):
        m = len(block.words[i])
        pad = m // 2 + 2
        if out and out[-1][0] == i and d - pad <= out[-1][2] - m - pad + 1:
            out[-1] = (i, out[-1][1], d + m + pad)
        else:
            out.append((i, d - pad, d + m + pad))
    return out


def _whole_items(block: Block, tables: dict[int, Table], x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, first word, end word) of the short items that a text of the word hashes ``x`` holds, the first place of each."""
    for n, (_, items) in block.short.items():
        if len(x) < n:
            continue
        for at, key in zip(*(v.tolist() for v in tables[n].find(rabin_karp(x, n, _BASE)))):
            for i in items[key]:
                if (block.rare[i] or len(x) == n) and (x[at:at + n] == block.words[i]).all():
                    yield i, at, at + n


def _score_slice(block: Block, table: Table, short: dict[int, Table], hashes: WordHashes, texts: list[str | None], threshold: float, long_match: int):
    """Per text its hits: {item: (score, first word, end word)}, the best alignment of each item."""
    hits: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
    x = [hashes.of(plain_words(t)) for t in texts]
    wanted: dict[int, list[tuple[int, int, int]]] = {}
    if block.short:
        for n, w in enumerate(x):
            for i, a, b in _whole_items(block, short, w):
                hits[n].setdefault(i, (1.0, a, b))
    size = np.array([len(w) for w in x], np.int64)
    start = np.cumsum(size) - size
    flat = np.concatenate(x) if x else np.zeros(0, np.uint64)
    at, key = table.find(rabin_karp(flat, SEED, _BASE)) if len(flat) >= SEED else (size[:0], size[:0])
    doc = np.searchsorted(start, at, side="right") - 1
    whole = at + SEED <= start[doc] + size[doc]  # not over the end of a text
    at, key, doc = at[whole], key[whole], doc[whole]
    cuts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else size[:0]
    for lo, hi in zip(cuts.tolist(), np.append(cuts[1:], len(doc)).tolist()):
        n, k = int(doc[lo]), key[lo:hi]
        many = block.first[k + 1] - block.first[k]
        place = common.ragged(block.first[k], many)
        found = np.unique(np.stack([block.item[place], np.repeat(at[lo:hi] - start[n], many) - block.offset[place]]), axis=1)
        for i, a, b in _passages(block, *found):
            wanted.setdefault(i, []).append((n, max(a, 0), min(b, len(x[n]))))
    for i, parts in wanted.items():
        word = block.words[i]
        least = min(threshold * len(word), long_match)
        parts.sort(key=lambda p: p[2] - p[1])
        for lo in range(0, len(parts), 256):
            group = parts[lo:lo + 256]
            width = max(b - a for _, a, b in group)
            rows = np.zeros((len(group), width), np.uint64)
            filled = np.zeros((len(group), width), bool)
            for r, (n, a, b) in enumerate(group):
                rows[r, :b - a] = x[n][a:b]
                filled[r, :b - a] = True
            rows[~filled] = np.uint64(0)  # no word's hash
            best, end_i, end_j = align(word, rows)
            for r in np.flatnonzero(best >= least):
                n, a, b = group[r]
                back = align(word[:end_i[r] + 1][::-1], rows[r:r + 1, :end_j[r] + 1][:, ::-1])[2][0]
                hit = (float(best[r]) / len(word), a + int(end_j[r] - back), a + int(end_j[r]) + 1)
                if i not in hits[n] or hit[0] > hits[n][i][0]:
                    hits[n][i] = hit
    return hits


def with_hits(
    docs: DataFrame, benchmark: DataFrame, hits: str, text: str = "text", rate: float = RATE, threshold: float = THRESHOLD,
    long_match: int = LONG_MATCH, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with an array ``hits`` of (item_id, score, start_word, end_word): the benchmark items each row holds a copy of.

    ``score`` is the alignment's score over the item's words (1: whole and unchanged), of the best place in the document;
    word ranges count words as :func:`plain_words` does. Null and empty texts have no hits; repeated rows get the same hits. Items
    shorter than LEAST_WORDS words have the score 1 where they are found; a null text or one without a word is found nowhere; repeated
    items are found each. An empty benchmark finds nothing. Raises if a column ``hits`` exists.
    """
    if hits.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"column exists already: {hits}")
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // (4 * block_words)))
    done, arrays = docs, []
    for k in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).orderBy("item_id", "text").collect()
        own = WordHashes()
        words = [(r["item_id"], own.of(plain_words(r["text"]))) for r in part]
        words = [(i, w) for i, w in words if len(w)]
        if not words:
            continue
        block = Block([i for i, _ in words], [w for _, w in words])
        share, _ = _count_words(docs, np.unique(np.concatenate(block.words)), text)
        block.choose_seeds(share, rate)
        shared = spark.sparkContext.broadcast(block)

        def run(texts, shared=shared):
            b = shared.value
            if b.state is None:
                b.state = Table(b.keys), {n: Table(keys) for n, (keys, _) in b.short.items()}, WordHashes(REMEMBERED)
            rows = _score_slice(b, *b.state, texts, threshold, long_match)
            out = [
                [{"item_id": b.ids[i], "score": s, "start_word": x, "end_word": y} for i, (s, x, y) in sorted(r.items())]
                for r in rows
            ]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int32()), ("end_word", pa.int32())]))
            return [pa.array(out, kind)]

        name = common.free_name(done.columns, f"{hits}_{k}")
        done = common.with_columns(done, text, [(name, _HITS)], run)
        arrays.append(name)
    none = F.lit(None).cast(_HITS)
    found = F.concat(*arrays) if arrays else F.coalesce(none, F.array().cast(_HITS))
    return done.withColumn(hits, found).drop(*arrays)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): a row for each document row and benchmark item that it holds a copy of."""
    return with_hits(docs.select("doc_id", "text"), benchmark, "hits", **options).drop("text").select("doc_id", F.inline("hits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a copy of any benchmark item."""
    name = common.free_name(docs.columns, "_hits")
    return with_hits(docs, benchmark, name, **options).where(F.size(name) == 0).drop(name)


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
