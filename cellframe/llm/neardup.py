"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. Every document's set of five-word shingles gives a digest and a signature of ``FUNCTIONS`` MinHash values. Documents
   with equal digests are one class; only its smallest id goes on.
2. *Forest*: each of ``TREES`` trees has its own order of the MinHash functions; documents whose signatures, in that order, share
   a prefix stand in one region. Depth adapts to the region: one of up to ``LEAF`` documents is a leaf, and all its
   documents are neighbours; in a larger one every document is a neighbour of the smallest id, and the region is cut
   anew at the next longer prefix, until its signatures differ or the deepest prefix is reached. There the region is dealt into leaves by
   hash. No region emits more than ``LEAF`` neighbours for each document, however many it holds.
3. *Confirm*: neighbours go to a home that both sets are sent to once, and are linked if the exact similarity reaches the threshold.
4. *Crowds*: documents of a large region of the first level whose links so far leave it in several components are joined exactly,
   on the shingles that come first in a common order, rarest first: sets as similar as the threshold share one of their first
   n - ceil(threshold * n) + 1. Only pairs of different components count, and a shingle of many documents is dealt in blocks.
5. The links' connected components are the groups.

So a link is lost only if its documents share no region of the first level in any tree, (1 - s^4)^24 at similarity s: 2.0e-8 at 0.85, 3.2e-6 at 0.80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import common, oracles
from cellframe.llm.components import components
from cellframe.llm.registry import query
from cellframe.llm.substring import WordHashes, rabin_karp
from cellframe.session import discard, store

SHINGLE = 5
PERCENT = 85
FUNCTIONS = 128
TREES = 24
DEPTHS = (4, 6, 8, 11, 15, 20)
LEAF = 32
HOME = 256
#: Documents of one shingle that are compared with as many others in one place.
BLOCK = 256
_CELL_BITS = 20
_BASE = 987_654_321_012_345_679
_SLICE = 1_500_000


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_250_101)
    return rng.integers(0, 2**31, FUNCTIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, FUNCTIONS, dtype=np.uint32)


def _orders() -> np.ndarray:
    """Per tree its order of the functions; the first ones differ from tree to tree."""
    rng = np.random.default_rng(20_250_102)
    per = FUNCTIONS // TREES
    out = []
    for t in range(TREES):
        own = np.arange(t * per, (t + 1) * per)
        out.append(np.concatenate([own, rng.permutation(np.setdiff1d(np.arange(FUNCTIONS), own))]))
    return np.array(out)


def shingle_sets(texts: list[str | None], hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words make one shingle; no words, none."""
    out = []
    for t in texts:
        x = hashes.of(common.lower_ascii(t))
        if not len(x):
            out.append(x)
        else:
            k = min(SHINGLE, len(x))
            out.append(np.unique(common.mix(rabin_karp(x, k, _BASE) + np.uint64(k))))
    return out


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, a row each."""
    a, b = _multipliers()
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), FUNCTIONS), np.uint32)
    for k in range(FUNCTIONS):
        out[:, k] = np.minimum.reduceat(x * a[k] + b[k], starts)
    return out


def _region_keys(sig: np.ndarray) -> np.ndarray:
    """Per document and tree the keys of its regions, from the shortest prefix to the longest."""
    orders = _orders()
    out = np.empty((len(sig), TREES, len(DEPTHS)), np.int64)
    for t in range(TREES):
        h = np.full(len(sig), t + 1, np.uint64)
        level = 0
        for d in range(DEPTHS[-1]):
            h = common.mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, orders[t, d]].astype(np.uint64) + np.uint64(1))
            if d + 1 == DEPTHS[level]:
                out[:, t, level] = h.view(np.int64)
                level += 1
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, signature): size and digest of each row's set, and its MinHash values (empty without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in common.parts(batch, 1, _SLICE):
                sets = shingle_sets(part.column(1).to_pylist(), hashes)
                some = [s for s in sets if len(s)]
                signatures = iter(_signatures(some) if some else ())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(s.sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([int(common.mix(s).sum().view(np.int64)) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([next(signatures).tobytes() if len(s) else b"" for s in sets], pa.binary()),
                ], ["doc_id", "n", "d1", "d2", "signature"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(common.tidy(run), "doc_id bigint, n bigint, d1 bigint, d2 bigint, signature binary")


def _unfold(classes: DataFrame) -> DataFrame:
    """A row per class and tree, with the region keys k0, k1, ..."""
    names = [f"k{i}" for i in range(len(DEPTHS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, FUNCTIONS)
            keys = _region_keys(signatures).reshape(-1, len(DEPTHS))
            cols = [np.repeat(np.asarray(batch.column(i)), TREES) for i in (0, 1)] + list(keys.T)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc", "n", *names])

    schema = ", ".join(f"{c} bigint" for c in ["doc", "n", *names])
    return classes.select("doc", "n", "signature").mapInArrow(common.tidy(run), schema)


def _leaf_pairs(rows: DataFrame, *key) -> DataFrame:
    """All pairs within small groups of ``rows`` (member: struct of doc and n)."""
    lists = rows.groupBy(*key).agg(F.sort_array(F.collect_list("member")).alias("m")).where(F.size("m") > 1).select("m")
    first = lists.select("m", F.posexplode("m").alias("i", "x"))
    return first.select("x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))


def neighbours(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of neighbours in the forest whose set sizes allow the similarity, and (region, doc) of the
    first level's regions of over ``LEAF`` documents: only there can two documents share a region without becoming a pair."""
    rows, found, kept = _unfold(classes), [], []
    for level in range(len(DEPTHS)):
        key = f"k{level}"
        region = rows.groupBy(key).agg(F.count("*").alias("size"), F.min(F.struct("doc", "n")).alias("pivot")).where("size > 1")
        hit = store(rows.join(region, key))
        kept.append(hit)
        member = F.struct("doc", "n").alias("member")
        found.append(_leaf_pairs(hit.where(F.col("size") <= LEAF).select(key, member), key))
        large = hit.where(F.col("size") > LEAF)
        found.append(large.where("doc <> pivot.doc").select(F.col("pivot").alias("x"), F.struct("doc", "n").alias("y")))
        if not level:
            crowded = store(large.select(F.col(key).alias("region"), "doc"))
        rows = large.drop("size", "pivot", key)
        if level == len(DEPTHS) - 1:
            leaf = F.pmod(F.xxhash64("doc"), F.ceil(F.col("size") / (LEAF // 2)))
            found.append(_leaf_pairs(large.select(key, leaf.alias("leaf"), member), key, "leaf"))
        elif large.isEmpty():
            break
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    fits = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    out = store(pairs.where(fits).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct())
    for k in kept:
        discard(k)
    return out, crowded


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, members) of the rows whose id is in ``wanted`` (doc_id): their sorted shingle hashes."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    texts = texts.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in common.parts(batch, 1, _SLICE):
                sets = pa.array([s.tobytes() for s in shingle_sets(part.column(1).to_pylist(), hashes)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sets], ["doc", "members"])

    return texts.mapInArrow(common.tidy(make_sets), "doc bigint, members binary")


def _cells(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each of 2^20 cells of the hash. Any order common to all sets is right; this one puts rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << _CELL_BITS, np.int64)
        for batch in batches:
            for part in common.parts(batch, "members", _SLICE):
                x = np.frombuffer(b"".join(part.column("members").to_pylist()), np.uint64)
                n += np.bincount((x >> np.uint64(64 - _CELL_BITS)).astype(np.int64), minlength=len(n))
        cell = np.flatnonzero(n)
        for i in range(0, len(cell), 1 << 16):
            c = cell[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n[c], pa.int64())], ["cell", "n"])

    got = sets.select("members").mapInArrow(common.tidy(run), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << _CELL_BITS, np.int64)
    out[got["cell"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(s, doc, comp, n, rest): the shingles that come first in each set and how many stand from there to its end."""
    shared = sets.sparkSession.sparkContext.broadcast(_cells(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.parts(batch, "members", _SLICE):
                out, sizes, lengths = [], [], []
                for raw in part.column("members").to_pylist():
                    x = np.frombuffer(raw, np.uint64)
                    count = shared.value[(x >> np.uint64(64 - _CELL_BITS)).astype(np.int64)]
                    first = np.lexsort((x, count))[:len(x) - (percent * len(x) + 99) // 100 + 1]
                    at = np.flatnonzero(count[first] > 1)  # a cell of one shingle: no other document holds it
                    out.append((x[first[at]].view(np.int64), len(x) - at))
                    sizes.append(len(at))
                    lengths.append(len(x))
                ids = [np.repeat(np.asarray(part.column(c)), sizes) for c in ("doc", "comp")]
                s, rest = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (s, *ids, np.repeat(lengths, sizes), rest)], ["s", "doc", "comp", "n", "rest"]
                )

    return sets.select("doc", "comp", "members").mapInArrow(common.tidy(run), "s bigint, doc bigint, comp bigint, n bigint, rest bigint")


def across(docs: DataFrame, crowded: DataFrame, groups: DataFrame, percent: int) -> DataFrame | None:
    """Pairs (a < b) of different components that may reach the similarity, of all documents whose region in ``crowded``
    (region, doc) holds several components; none of them is left out. ``groups`` (doc, component) names the linked ones."""
    member = crowded.join(groups, "doc", "left").select("region", "doc", F.coalesce("component", "doc").alias("comp"))
    mixed = member.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("region")
    asked = store(member.join(mixed, "region").select("doc", "comp").distinct())
    if asked.isEmpty():
        return None
    sets = store(_sets(docs, asked.select(F.col("doc").alias("doc_id"))).join(asked, "doc"))
    prefix = store(_prefixes(sets, percent))
    # a shingle's blocks: some for each component of over BLOCK documents, which need not meet each other, and a pool of the rest
    per = prefix.groupBy("s", "comp").agg(F.count("*").alias("c"))
    big = F.col("c") > BLOCK
    spread = per.groupBy("s").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum(F.when(~big, F.col("c"))).alias("pool"),
        F.collect_list(F.when(big, F.struct("comp", F.ceil(F.col("c") / BLOCK).alias("parts")))).alias("big"),
    ).where("lo < hi").select("s", F.ceil(F.coalesce("pool", F.lit(0)) / BLOCK).alias("pool"), "big")
    rows = prefix.join(spread, "s").withColumn("own", F.filter("big", lambda x: x["comp"] == F.col("comp")))
    alone = F.size("own") > 0

    def block(kind, owner, part):
        return F.struct(kind.cast("int").alias("kind"), owner.cast("bigint").alias("owner"), part.cast("bigint").alias("part"))

    def numbered(kind, owner, parts):
        none = F.array().cast("array<struct<kind:int,owner:bigint,part:bigint>>")
        return F.when(parts > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda k: block(kind, owner, k))).otherwise(none)

    others = F.flatten(F.transform(F.filter("big", lambda x: x["comp"] != F.col("comp")), lambda x: numbered(F.lit(1), x["comp"], x["parts"])))
    mine = F.when(alone, block(F.lit(1), F.col("comp"), F.pmod(F.xxhash64("doc"), F.col("own")[0]["parts"]))).otherwise(
        block(F.lit(0), F.lit(0), F.pmod(F.xxhash64("doc"), F.greatest(F.col("pool"), F.lit(1))))
    )
    rows = rows.select("s", "doc", "comp", "n", "rest", mine.alias("mine"), F.explode(F.concat(numbered(F.lit(0), F.lit(0), F.col("pool")), others)).alias("met"))
    lists = rows.groupBy("s", F.least("mine", "met").alias("x"), F.greatest("mine", "met").alias("y")).agg(
        F.collect_list(F.struct((F.col("mine") == F.least("mine", "met")).alias("left"), (F.col("mine") == F.greatest("mine", "met")).alias("right"),
                                "doc", "comp", "n", "rest")).alias("m"),
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
    ).where("lo < hi").select("m")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            cuts, flat = np.asarray(lists.offsets), lists.values
            left, right, doc, comp, n, rest = (np.asarray(flat.field(i).to_numpy(zero_copy_only=False)) for i in range(6))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                x, y = i + np.flatnonzero(left[i:j]), i + np.flatnonzero(right[i:j])
                enough = np.minimum(rest[x][:, None], rest[y]) * (100 + percent) >= percent * (n[x][:, None] + n[y])
                p, q = np.nonzero(enough & (comp[x][:, None] != comp[y]))
                a, b = doc[x[p]], doc[y[q]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    out = store(lists.mapInArrow(common.tidy(meet), "a bigint, b bigint").distinct())
    for t in (asked, sets, prefix):
        discard(t)
    return out


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    least = pairs.groupBy("b").agg(F.min("a").alias("anchor"))
    crowd = least.groupBy("anchor").agg(F.count("*").alias("crowd"))
    # home of a pair: the smallest neighbour of b, in as many parts as its crowd needs
    homes = least.join(crowd, "anchor").select(
        "b", F.xxhash64("anchor", F.pmod(F.xxhash64("b"), F.ceil(F.col("crowd") / HOME))).alias("home")
    )
    placed = store(pairs.join(homes, "b").select("home", "a", "b"))
    needed = placed.select("home", F.col("a").alias("doc")).unionByName(placed.select("home", F.col("b").alias("doc"))).distinct()
    wanted = needed.select(F.col("doc").alias("doc_id")).distinct()
    sets = needed.join(_sets(docs, wanted), "doc").select(F.col("home").alias("place"), "doc", "members")

    def confirm(pair: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        sets = {d: np.frombuffer(s, np.uint64) for d, s in zip(members["doc"], members["members"])}
        ok = []
        for a, b in zip(pair["a"], pair["b"]):
            x, y = sets[a], sets[b]
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        return pair.loc[np.array(ok, bool), ["a", "b"]] if ok else pair[["a", "b"]].iloc[:0]

    out = store(placed.groupBy("home").cogroup(sets.groupBy("place")).applyInPandas(confirm, "a bigint, b bigint"))
    discard(placed)
    return out


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Null, empty and word-less texts have an empty set and link with nothing; so do rows without an id, whose component is null
    and which are kept. Rows with one id are expected to be repeats of one text and get the same component.
    """
    rows = store(sketch(docs))
    alive = rows.where("n > 0 and doc_id is not null")
    classes = store(
        alive.groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "signature")).alias("first"))
        .select("n", "d1", "d2", F.col("first.doc_id").alias("doc"), F.col("first.signature").alias("signature"))
    )
    pairs, crowded = neighbours(classes, percent)
    links = confirmed(docs, pairs, percent)
    groups = components(links).select(F.col("node").alias("doc"), "component")
    if (more := across(docs, crowded, groups, percent)) is not None:
        links = links.unionByName(confirmed(docs, more, percent))
        groups = components(links).select(F.col("node").alias("doc"), "component")
    named = classes.join(groups, "doc", "left").select("n", "d1", "d2", F.coalesce("component", "doc").alias("component"))
    # one row per id and set: rows that repeat an id and differ in text take the smallest component of theirs
    mine = rows.select("doc_id", F.col("n").alias("n_shingles"), "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    component = F.coalesce("component", "doc_id")
    return mine.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps: of each group the smallest id."""
    gone = near_duplicates(docs.select("doc_id", "text"), percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@query("op5_minhash_forest", oracles.NEAR_DUPLICATES)
def op5_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir))
