"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of its bigram's and its own maximum-likelihood estimate and the uniform one; the mixture's
weights depend on the bucket (power of two) of the context's frequency and are learned by expectation-maximisation on held-out counts:
every training token is taken out of the counts before it is predicted from the rest.

Counts come from the whole training part and are never broadcast. Documents are dealt into groups; a group sends the hashes of its
distinct words and bigrams, packed, to buckets, which add up the groups' training counts and answer each group in its own order.
A word that stands in a third of all documents is thus one number per group. A group then writes each token's counts, from which
both the learning, over a small histogram of probabilities, and the scoring read.

Hashes carry 48 bits within a bucket, and the number of buckets is set by ``spark.sql.shuffle.partitions``, not by the input: in a bucket
of a million entries two share a hash, and so their counts, with a probability of about 0.002; in one of 12 million some 0.25 pairs do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from cellframe.llm import common, packets
from cellframe.llm.registry import query
from cellframe.llm.substring import WordHashes
from cellframe.session import discard, store

_HASH_BYTES = 6
_END = np.uint64(0x5DEECE66D1234567)
_UNIGRAM, _BIGRAM, _TOTALS = 1, 2, 3
#: Steps of the histogram's axes (log2 of the ratio to the uniform probability) and rounds of learning.
_STEP = 0.25
ROUNDS = 60


def _tokens(group: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The group's rows in a fixed order, and of all their tokens: hash, hash with the one before, row."""
    group = group.sort_values(["doc_id", "text"], kind="stable", ignore_index=True)
    hashes = WordHashes()
    words = [np.append(hashes.of(common.lower_ascii(t)), _END) for t in group["text"]]
    n = np.array([len(w) for w in words], np.int64)
    x = np.concatenate(words)
    before = np.append(_END, x[:-1])  # the end of the text before is also what a first word follows
    return group, x, common.mix(before * np.uint64(0x9E3779B97F4A7C15) + x), np.repeat(np.arange(len(n)), n)


def _distinct(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by bucket: their hash bits, where each bucket's begin, and for each key its place among them."""
    u, inverse = np.unique(keys, return_inverse=True)
    m = common.mix(u)
    bucket = (common.mix(m ^ np.uint64(0xA5A5A5A5DEADBEEF)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    place = np.empty(len(u), np.int64)
    place[by] = np.arange(len(u))
    return m[by] & np.uint64((1 << 48) - 1), np.searchsorted(bucket[by], np.arange(buckets + 1)), place[inverse], by


def _counts(docs: DataFrame, held_out: Column) -> DataFrame:
    """A row per document with its tokens' counts in the training part, and rows of totals (kind 3: n_tokens N, n_known V)."""
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(n)).cast("int").alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out.alias("held_out"), "text",
    )

    def ask(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        group, x, pairs, row = _tokens(group)
        training = (~group["held_out"].to_numpy(bool))[row]
        columns = {}
        for kind, keys in ((_UNIGRAM, x), (_BIGRAM, pairs)):
            bits, cuts, place, _ = _distinct(keys, n)
            count = np.bincount(place[training], minlength=len(bits))
            columns[kind] = [
                packets.planes(bits[a:z], _HASH_BYTES) + packets.planes(count[a:z], 4) for a, z in zip(cuts, cuts[1:])
            ]
        return pd.DataFrame({"bucket": np.arange(n), "part": part, "unigrams": columns[_UNIGRAM], "bigrams": columns[_BIGRAM]})

    def add_up(messages: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """Each message's training counts summed over all messages, and the sums of the distinct hashes."""
        sizes = np.array([len(d) for d in messages]) // (_HASH_BYTES + 4)
        views = [memoryview(d) for d in messages]
        bits = np.concatenate([packets.from_planes(v[: k * _HASH_BYTES], k, _HASH_BYTES) for v, k in zip(views, sizes)])
        count = np.concatenate([packets.from_planes(v[k * _HASH_BYTES:], k, 4) for v, k in zip(views, sizes)])
        distinct, inverse = np.unique(bits, return_inverse=True)
        total = np.bincount(inverse, weights=count.astype(float), minlength=len(distinct)).astype(np.uint64)
        return [packets.planes(f, 5) for f in np.split(total[inverse], np.cumsum(sizes)[:-1])], total

    def answer(bucket: pd.DataFrame) -> pd.DataFrame:
        number, parts = int(bucket["bucket"].iloc[0]), bucket["part"].tolist()
        unigrams, total = add_up(bucket["unigrams"].tolist())
        bigrams, _ = add_up(bucket["bigrams"].tolist())
        out = [(int(p), 0, number, u, g) for p, u, g in zip(parts, unigrams, bigrams)]
        stats = np.array([total.sum(), np.count_nonzero(total)], "<u8").tobytes()
        out.append((int(parts[0]), _TOTALS, number, stats, b""))
        return pd.DataFrame(out, columns=["to", "kind", "bucket", "unigrams", "bigrams"])

    def collect(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["kind", "doc_id", "held_out", "n_tokens", "n_known", "logs", "counts"]
        stats = [np.frombuffer(d, "<u8") for d in answers.loc[answers["kind"] == _TOTALS, "unigrams"]]
        out = [(_TOTALS, None, None, int(s[0]), int(s[1]), None, None) for s in stats]
        if len(group):
            group, x, pairs, row = _tokens(group)
            both = []
            mine = answers[answers["kind"] == 0]
            for column, keys in (("unigrams", x), ("bigrams", pairs)):
                bits, cuts, place, _ = _distinct(keys, n)
                total = np.zeros(len(bits), np.int64)
                for b, d in zip(mine["bucket"], mine[column]):
                    total[cuts[b]:cuts[b + 1]] = packets.from_planes(memoryview(d), cuts[b + 1] - cuts[b], 5).astype(np.int64)
                both.append(total[place])
            one, two = both
            logs = np.bincount(row, weights=np.log10(one + 0.5), minlength=len(group))
            known = np.bincount(row, weights=one > 0, minlength=len(group)).astype(int)
            size = np.bincount(row, minlength=len(group))
            pack, ends = zstandard.ZstdCompressor(level=1), np.cumsum(size)
            data = [pack.compress(packets.planes(one[z - k:z], 5) + packets.planes(two[z - k:z], 5)) for z, k in zip(ends, size)]
            ids = [None if pd.isna(i) else int(i) for i in group["doc_id"]]
            out += zip([0] * len(ids), ids, group["held_out"].astype(bool), size.tolist(), known.tolist(), logs.tolist(), data)
        return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "held_out": "boolean"})

    asked = rows.groupBy("part").applyInPandas(ask, "bucket int, part int, unigrams binary, bigrams binary")
    answers = asked.groupBy("bucket").applyInPandas(answer, "to int, kind int, bucket int, unigrams binary, bigrams binary")
    return rows.groupBy("part").cogroup(answers.groupBy("to")).applyInPandas(
        collect, "kind int, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, counts binary"
    )


def _unpack(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the tokens of a text, of their contexts (the text's end comes before its first word), and of both together."""
    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    one, two = (packets.from_planes(raw[k * 5 * n:(k + 1) * 5 * n], n, 5).astype(float) for k in (0, 1))
    return one, np.append(one[-1], one[:-1]), two


@dataclass
class Mixture:
    """Weights (bigram, unigram, uniform) per bucket of the context's count, and the totals of the training part."""

    weights: np.ndarray
    tokens: int
    distinct: int

    def score(self, one: np.ndarray, context: np.ndarray, two: np.ndarray) -> float:
        w = self.weights[np.minimum(_bucket(context), len(self.weights) - 1)]
        p = w[:, 0] * two / np.maximum(context, 1) + w[:, 1] * one / max(self.tokens, 1) + w[:, 2] / (self.distinct + 1)
        return float(np.log10(p).sum())


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(context, 0))[1]  # 0 for 0, then one more for each power of two


def learn_weights(cells: pd.DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of each bucket by expectation-maximisation over ``cells`` (bucket, r2, r1, n).

    ``r2``, ``r1``: held-out bigram and unigram probability over the uniform one. Each weight starts with one token's worth of
    evidence, so none gets to 0; a bucket without tokens takes the weights of all tokens together.
    """

    def fit(part: pd.DataFrame) -> np.ndarray:
        p = np.stack([part["r2"], part["r1"], np.ones(len(part))], axis=1)
        n, w = part["n"].to_numpy(float), np.full(3, 1 / 3)
        for _ in range(rounds):
            share = w * p
            share *= (n / share.sum(axis=1))[:, None]
            new = (share.sum(axis=0) + 1) / (n.sum() + 3)
            if np.abs(new - w).max() < 1e-7:
                break
            w = new
        return new

    if not len(cells):
        return np.full((1, 3), 1 / 3)
    out = np.tile(fit(cells), (int(cells["bucket"].max()) + 1, 1))
    for b, part in cells.groupby("bucket"):
        out[int(b)] = fit(part)
    return out


def train(counts: DataFrame) -> Mixture:
    """The mixture learned from a table of :func:`_counts`; only a histogram of bounded size reaches the driver."""
    total = counts.where(F.col("kind") == _TOTALS).agg(F.sum("n_tokens").alias("n"), F.sum("n_known").alias("v")).first()
    tokens, distinct = int(total["n"] or 0), int(total["v"] or 0)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log2((distinct + 1) / max(tokens - 1, 1))
        for batch in batches:
            parts = []
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one, context, two = _unpack(data, n)
                with np.errstate(divide="ignore", invalid="ignore"):  # a token less of everything: its own
                    r1 = np.log2(one - 1) + base
                    r2 = np.where(context > 1, np.log2((two - 1) / (context - 1)) + np.log2(distinct + 1.0), -np.inf)
                # -100: the estimate is 0
                q1, q2 = (np.where(np.isfinite(r), np.round(np.nan_to_num(r, neginf=0.0) / _STEP), -400) for r in (r1, r2))
                cell = (_bucket(context - 1).astype(np.int64) << 24) + ((q2.astype(np.int64) + 2048) << 12) + q1.astype(np.int64) + 2048
                parts.append(cell)
            if parts:
                cell, n = np.unique(np.concatenate(parts), return_counts=True)
                cells = (cell >> 24, (cell >> 12 & 4095) - 2048, (cell & 4095) - 2048)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cells, n)], ["bucket", "q2", "q1", "n"])

    training = counts.where((F.col("kind") == 0) & ~F.col("held_out")).select("n_tokens", "counts")
    cells = training.mapInArrow(common.tidy(histogram), "bucket bigint, q2 bigint, q1 bigint, n bigint")
    cells = cells.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).orderBy("bucket", "q2", "q1").toPandas()
    for r, q in (("r2", "q2"), ("r1", "q1")):
        cells[r] = np.where(cells[q] == -400, 0.0, 2.0 ** (cells[q].astype(float) * _STEP))
    return Mixture(learn_weights(cells), tokens, distinct)


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text).

    A null or empty text is its end token alone. Rows that repeat an id count and are scored one by one. Without any training
    row all counts are 0 and the uniform estimate over one word is what is left of both scores.
    """
    counts = store(_counts(docs, held_out))
    model = train(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = counts.where("kind = 0").select("doc_id", "held_out", "n_tokens", "n_known", "logs", "counts")
    schema = StructType([
        StructField("doc_id", LongType()), StructField("held_out", BooleanType()), StructField("n_tokens", LongType()),
        StructField("n_known", LongType()), StructField("train_tokens", LongType()), StructField("base_score", DoubleType()),
        StructField("score", DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        each = np.log10(m.tokens + 0.5 * (m.distinct + 1))
        for batch in batches:
            n = np.asarray(batch.column(2))
            done = [m.score(*_unpack(d, k)) for d, k in zip(batch.column(5).to_pylist(), n.tolist())]
            base = np.asarray(batch.column(4)) - n * each
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.full(len(n), m.tokens)), pa.array(base), pa.array(done, pa.float64())],
                schema.names,
            )

    return rows.mapInArrow(common.tidy(run), schema)


@query("op9_interpolated_lm")
def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(common.documents(spark, sf_dir), common.crc_fold("doc_id", 5) == 1)
