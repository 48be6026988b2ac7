"""Documents to token ids: quality rules, near-duplicates, repeated passages, benchmark copies, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of ``documents``. Each works on
whatever its predecessor kept, however many rows that are; ids, texts and other columns may be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm import bpe, decontaminate, neardup, quality, substring
from cellframe.session import store


#: Documents whose sets of five-word shingles are at least so similar are near copies; op5's own contract has 85.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or a certified cutoff reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id."""
    return neardup.keep_first(docs, percent=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that occur earlier in the corpus out of the texts; every document stays."""
    return substring.dedup_text(docs)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a copy, also an edited one, of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every text, encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text")
    done = bpe.decode(encoded, path)
    return done.select("doc_id", *bpe.digest_columns(), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark copies", benchmark_copies),
    ("token ids", token_ids),
]

#: The certified cutoffs, the forest and the alignment have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
