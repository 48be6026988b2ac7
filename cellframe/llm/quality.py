"""Quality rules whose cutoffs are certified on labelled documents (risk-controlled thresholds).

Every rule rejects a document whose feature reaches a cutoff. Labelled documents are split by the crc32 of their id:

* on the *tuning* half, the cutoffs of all features are put in order: first those that reject no good document and the
  most bad ones; a step of the order adds one cutoff to those before it, so the rejected sets are nested;
* on the *certification* half, the steps are tested one after another (fixed-sequence testing, so the steps cost no
  correction): step k passes if the exact binomial (Clopper-Pearson) upper bound of the share of good documents that the
  first k cutoffs reject is at most ``risk``. The first step that fails ends the stratum's order.

The confidence is split evenly over the strata (Bonferroni), so with probability ``1 - delta`` no stratum loses more than
``risk`` of its good documents. A stratum with too few labels to certify anything rejects nothing beyond the base rules.
All counts are Spark aggregates over all labelled documents; a stratum's order is worked out from its few counts.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

import pyarrow as pa

from cellframe.llm import common
from cellframe.llm.registry import query
from cellframe.session import discard, store

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 5

#: Counted columns of a text, in this order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_stutter")

#: Cutoffs that the rules try, per feature: a document is rejected from the cutoff on.
GRID: dict[str, tuple[float, ...]] = {
    "symbols": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5),
    "dup_lines": (0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeats": (0.05, 0.1, 0.15),
    "upper": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "stutter": (0.1, 0.2, 0.3, 0.4, 0.5),
    "shouts": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0),
    "long_words": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0),
    "short_words": (-2.5, -3.0, -3.5, -4.0),
}
_RULES = [(f, c) for f, cuts in GRID.items() for c in cuts]


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; null counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    words = common.words_of(text)
    n = len(words)
    lines: set[str] = set()
    n_lines = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            n_lines += 1
            lines.add(line)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return (
        n, len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, _SYMBOLS)), n_lines - len(lines),
        _repeated(words), n_lines, upper, sum(map(str.isalpha, text)), text.count("!"),
        sum(map(operator.eq, words, words[1:])),
    )


def _repeated(words: list[bytes]) -> int:
    """Words inside a window of five words that the text holds twice or more."""
    m = len(words) - _WINDOW + 1
    if m < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    base = len(number)
    if base ** _WINDOW < 2 ** 63:
        key = np.zeros(m, np.int64)
        for k in range(_WINDOW):
            key = key * base + ids[k:k + m]
    else:
        key = ids[:m]
        for k in range(1, _WINDOW):  # ranks of ever longer windows: exact for any number of words
            key = np.unique(key * base + ids[k:k + m], return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(m, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:m] += again
    edge[_WINDOW:_WINDOW + m] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def add_counts(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the COUNTS of ``text``, each name after ``prefix``; one Arrow pass, no shuffle."""

    def run(texts):
        rows = np.array([count_text(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return [pa.array(rows[:, k]) for k in range(len(COUNTS))]

    return common.with_columns(df, text, [(prefix + c, LongType()) for c in COUNTS], run)


def base_failed(prefix: str = "") -> Column:
    n, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 10) | (100 * again > 20 * n)


def features(prefix: str = "") -> dict[str, Column]:
    """Per rule the value that grows with how bad a text is; 0 for a text without words."""
    c = {k: F.col(prefix + k) for k in COUNTS}

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    mean = ratio(c["word_chars"], c["n_words"])
    return {
        "symbols": ratio(c["n_symbols"], c["n_words"]), "dup_lines": ratio(c["n_dup_lines"], c["n_lines"]),
        "repeats": ratio(c["n_repeat_words"], c["n_words"]), "upper": ratio(c["n_upper"], c["n_letters"]),
        "stutter": ratio(c["n_stutter"], c["n_words"]), "shouts": ratio(c["n_shouts"], c["n_words"]), "long_words": mean, "short_words": -mean,
    }


def binomial_upper(k: int, n: int, delta: float) -> float:
    """Exact upper confidence bound of a share after ``k`` hits in ``n``: the p with P(X <= k | n, p) = delta."""
    if n == 0 or k >= n:
        return 1.0
    i = np.arange(k + 1, dtype=float)
    steps = np.log(np.arange(1, n + 1, dtype=float))
    log_fact = np.concatenate([[0.0], np.cumsum(steps)])
    comb = log_fact[n] - log_fact[: k + 1] - log_fact[n - k:][::-1][: k + 1]
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        x = comb + i * np.log(p) + (n - i) * np.log1p(-p) if p < 1 else np.full(k + 1, -np.inf)
        top = x.max()
        tail = np.exp(top) * np.exp(x - top).sum() if np.isfinite(top) else 0.0
        low, high = (p, high) if tail > delta else (low, p)
    return high


def order_rules(good: np.ndarray, bad: np.ndarray, n_good: int, risk: float) -> list[int]:
    """Rules of a stratum in the order in which they are tried.

    ``good[r]``, ``bad[r]``: tuning documents that rule r rejects. Rules that catch nothing bad, or whose share of good
    documents is over half the risk, are left out.
    """
    use = [r for r in range(len(good)) if bad[r] > 0 and good[r] <= risk / 2 * n_good]
    return sorted(use, key=lambda r: (good[r], -bad[r], r))


def certified_steps(firsts: dict[int, int], n_good: int, steps: int, risk: float, delta: float) -> int:
    """How many steps pass. ``firsts[k]``: good certification documents that step k is the first to reject."""
    lost = 0
    for k in range(steps):
        lost += firsts.get(k, 0)
        if binomial_upper(lost, n_good, delta) > risk:
            return k
    return steps


def calibrate(counts: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """(stratum, one cutoff per rule or null, n_good, n_rejected): the certified cutoffs of each stratum.

    ``counts``: doc_id, ``stratum`` and COUNTS. ``labels``: doc_id, quality (1 good, 0 bad); of repeated labels the lower
    holds, null ids and labels count for nothing, and a null stratum is a stratum of its own. Documents that fail the base
    rules are not the rules' to judge and are left out. Without labels the result is empty.
    """
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    feats = features()
    known = store(
        counts.where(~base_failed()).join(label, "doc_id").select(
            F.col(stratum).alias("stratum"), (F.col("_good") > 0).alias("good"),
            (common.crc_fold("doc_id", 2) == 0).alias("tuning"), *(v.alias(k) for k, v in feats.items()),
        )
    )
    hits = [(F.col(f) >= c).cast("bigint") for f, c in _RULES]
    tuned = known.where("tuning").groupBy("stratum").agg(
        F.count(F.when(F.col("good"), 1)).alias("n_good"),
        F.array(*(F.sum(F.when(F.col("good"), h).otherwise(0)) for h in hits)).alias("good"),
        F.array(*(F.sum(F.when(F.col("good"), 0).otherwise(h)) for h in hits)).alias("bad"),
    )

    def orders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rules = [order_rules(np.array(g), np.array(x), n, risk) for g, x, n in zip(b["good"], b["bad"], b["n_good"])]
            yield pd.DataFrame({"stratum": b["stratum"], "rules": rules})

    kind = counts.schema[stratum].dataType.simpleString()
    tried = store(tuned.mapInPandas(orders, f"stratum {kind}, rules array<int>"))
    # the first rule of its stratum's order that rejects a document, from 1; 0: none does
    values = F.array(*((F.col(f) >= c) for f, c in _RULES))
    first = F.array_position(F.transform("rules", lambda r: F.get(F.col("values"), r)), True)
    tested = (
        known.where("not tuning and good").withColumn("values", values)
        .join(tried.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")))
        .groupBy("stratum", first.alias("first")).agg(F.count("*").alias("n"))
        .groupBy("stratum").agg(F.collect_list(F.struct("first", "n")).alias("firsts"), F.sum("n").alias("n_good"))
    )
    strata = max(tested.count(), 1)

    def certify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, rules, firsts, n_good in zip(b["stratum"], b["rules"], b["firsts"], b["n_good"]):
                at = {int(x["first"]) - 1: int(x["n"]) for x in firsts}
                steps = certified_steps(at, int(n_good), len(rules), risk, delta / strata)
                cuts: dict[str, float | None] = dict.fromkeys(GRID)
                for r in rules[:steps]:
                    f, c = _RULES[r]
                    cuts[f] = c if cuts[f] is None else min(c, cuts[f])
                out.append({"stratum": s, **{f"cut_{f}": v for f, v in cuts.items()}, "n_good": int(n_good),
                            "n_rejected": sum(at.get(k, 0) for k in range(steps))})
            yield pd.DataFrame(out, columns=["stratum", *(f"cut_{f}" for f in GRID), "n_good", "n_rejected"])

    schema = StructType([
        StructField("stratum", counts.schema[stratum].dataType), *(StructField(f"cut_{f}", DoubleType()) for f in GRID),
        StructField("n_good", LongType()), StructField("n_rejected", LongType()),
    ])
    joined = tested.join(tried.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of"))).drop("of")
    done = store(joined.mapInPandas(certify, schema))
    discard(known)
    discard(tried)
    return done


def judge(counts: DataFrame, cutoffs: DataFrame, stratum: str = "lang", prefix: str = "") -> DataFrame:
    """``counts`` with base_failed and kept. A stratum without cutoffs is judged by the base rules alone."""
    feats = features(prefix)
    of = common.free_name(counts.columns, "_stratum")
    cuts = {f: common.free_name(counts.columns, f"_cut_{f}") for f in GRID}
    names = cutoffs.select(F.col("stratum").alias(of), *(F.col(f"cut_{f}").alias(n) for f, n in cuts.items()))
    rejected = F.lit(False)
    for f, n in cuts.items():
        rejected = rejected | F.coalesce(feats[f] >= F.col(n), F.lit(False))
    return (
        counts.join(names, F.col(stratum).eqNullSafe(F.col(of)), "left")
        .withColumn(f"{prefix}base_failed", base_failed(prefix))
        .withColumn(f"{prefix}kept", ~base_failed(prefix) & ~rejected).drop(of, *cuts.values())
    )


def quality(docs: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Counts, base_failed and kept of every row of ``docs`` (doc_id, lang, text).

    A null or empty text has no words and fails the base rules; repeated rows are judged alike; an empty table gives no rows.
    """
    counts = store(add_counts(docs.select("doc_id", "lang", "text")).drop("text"))
    return judge(counts, calibrate(counts, labels, risk=risk, delta=delta))


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with the columns they came with."""
    prefix = common.free_name([c[: len("_q_")] for c in docs.columns], "_q_")
    counted = add_counts(docs, prefix=prefix)
    plain = counted.select("doc_id", "lang", *(F.col(prefix + c).alias(c) for c in COUNTS))
    judged = judge(counted, calibrate(plain, labels, risk=risk, delta=delta), prefix=prefix)
    return judged.where(F.col(f"{prefix}kept")).select(*docs.columns)


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality(common.documents(spark, sf_dir, "doc_id", "lang", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return done.select("doc_id", *COUNTS[:5], "base_failed", "kept", "lang")
