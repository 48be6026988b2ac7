"""Language identification by word-first backoff.

A word that the training texts hold scores, per language, its smoothed log frequency. An unseen word falls back to its
character n-grams (with marks for the word's ends), from the longest length of which any n-gram is known to ever shorter ones. A text's
score per language is the sum over its words.

The model is fitted on a bounded sample: about ``SAMPLE`` training documents per language, chosen by a hash of their ids, so its
tables stay small enough to broadcast whatever the corpus holds. Every word and n-gram of the sample is kept, with the languages
that hold it only; the driver sees them as packed arrays. Every text is then scored as a whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from cellframe.llm import common
from cellframe.llm.registry import query
from cellframe.session import discard, store

#: Training documents per language, about.
SAMPLE = 1500
#: Characters of the longest and the shortest n-grams of the backoff.
LONGEST = 5
#: What is added to every count.
ALPHA = 0.5
REMEMBERED = 200_000
#: Up to so many languages their document counts are broadcast.
BROADCAST_LANGUAGES = 10_000
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    """n-grams of a word between its end marks; of a single character, its letters without the marks."""
    marked = f"<{word}>"
    return list(word) if n == 1 else [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies per language. ``names`` are the words and n-grams, a line each; they start with the n-gram length, 0 for words.

    ``base`` holds, per length, the log frequency of what a language does not hold; ``gain`` what its count adds to that,
    ``held[starts[i]:starts[i + 1]]`` being the languages that hold name i.
    """

    langs: list[str]
    names: bytes
    base: np.ndarray
    starts: np.ndarray
    held: np.ndarray
    gain: np.ndarray
    unseen: dict[str, np.ndarray] = field(default_factory=dict)

    @cached_property
    def rows(self) -> dict[str, int]:
        return {g: i for i, g in enumerate(self.names.decode().split("\n"))} if self.names else {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "unseen")} | {"unseen": {}}

    def _sum(self, rows: list[int], length: int) -> np.ndarray:
        """The summed scores of names of one length."""
        r = np.array(rows, np.int64)
        at = common.ragged(self.starts[r], self.starts[r + 1] - self.starts[r])
        return len(r) * self.base[length] + np.bincount(self.held[at], weights=self.gain[at], minlength=len(self.langs))

    def _backoff(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            known = [self.rows[k] for g in grams(word, n) if (k := f"{n}{g}") in self.rows]
            if known:
                return self._sum(known, n) / len(known)
        return np.zeros(len(self.langs))

    def score(self, text: str | None) -> tuple[str, float]:
        if not (found := words(text)) or not self.langs:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.langs))
        seen: list[int] = []
        for word, n in Counter(found).items():
            row = self.rows.get("0" + word)
            if row is not None:
                seen += [row] * n
                continue
            value = self.unseen.get(word)
            if value is None:
                if len(self.unseen) >= REMEMBERED:
                    self.unseen.clear()
                value = self.unseen[word] = self._backoff(word)
            total = total + n * value
        if seen:
            total = total + self._sum(seen, 0)
        best = int(total.argmax())  # of equals the first in the languages' order
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def fit(train: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``train`` (doc_id, text, lang: not null). No rows, no languages."""
    per = store(train.where("text is not null").groupBy("lang").agg(F.count("*").alias("_docs")))
    share = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    if per.count() <= BROADCAST_LANGUAGES:  # a few numbers; a join by language would gather most texts in a few tasks
        per = F.broadcast(per)
    chosen = train.join(per, "lang").where(share * F.col("_docs") < sample).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in common.parts(batch, 1)):
            own: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own.setdefault(lang, Counter()).update(words(text))
            for lang, c in own.items():
                out: Counter = Counter()
                for w, n in c.items():
                    out["0" + w] += n
                    for k in range(1, LONGEST + 1):
                        for g in grams(w, k):
                            out[f"{k}{g}"] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(out)), pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())],
                    ["lang", "gram", "n"],
                )

    counts = chosen.mapInArrow(common.tidy(count), "lang string, gram string, n bigint").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counts = store(counts)
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    number = {x: i for i, x in enumerate(langs)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            cuts, flat = np.asarray(lists.offsets), lists.values
            held = np.array([number[x] for x in flat.field(0).to_pylist()], np.int32)[cuts[0]:cuts[-1]]
            n = np.asarray(flat.field(1)).astype(np.int64)[cuts[0]:cuts[-1]]
            cols = ("\n".join(batch.column(0).to_pylist()).encode(), np.diff(cuts).astype(np.int32).tobytes(), held.tobytes(), n.tobytes())
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cols], ["names", "sizes", "held", "n"])

    by_gram = counts.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("n"))
    packed = by_gram.mapInArrow(common.tidy(pack), "names binary, sizes binary, held binary, n binary").collect()
    discard(counts)
    return _model(langs, sorted(packed, key=lambda r: bytes(r["names"])))


def _model(langs: list[str], packed: list) -> Model:
    names = b"\n".join(bytes(r["names"]) for r in packed)
    sizes, held = (np.concatenate([np.frombuffer(r[c], np.int32) for r in packed] or [np.zeros(0, np.int32)]) for c in ("sizes", "held"))
    n = np.concatenate([np.frombuffer(r["n"], np.int64) for r in packed] or [np.zeros(0, np.int64)]).astype(float)
    raw = np.frombuffer(b"\n" + names if names else b"", np.uint8)
    order = raw[np.flatnonzero(raw == 10) + 1].astype(np.int64) - ord("0")
    each = np.repeat(order, sizes)
    base = np.zeros((LONGEST + 1, len(langs)))
    for k in range(LONGEST + 1):
        own = each == k
        total = np.bincount(held[own], weights=n[own], minlength=len(langs))
        base[k] = np.log(ALPHA / (total + ALPHA * ((order == k).sum() + 1)))
    return Model(langs, names, base, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), held, np.log((n + ALPHA) / ALPHA))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (the share of the best language, 0 to 1) of ``text``; no shuffle.

    A null text, one without letters, and every text of a model without languages are ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        lang, score = zip(*(shared.value.score(t) for t in texts))
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

    return common.with_columns(docs, "text", [("lang_pred", StringType()), ("score", DoubleType())], run)


def held_out() -> Column:
    return common.crc_fold("doc_id", 3) == 1


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = common.documents(spark, sf_dir, "doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull())
    done = identify(common.documents(spark, sf_dir), fit(train))
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
