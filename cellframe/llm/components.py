"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.session import discard, store


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: ids); the component is its smallest node.

    Each step hooks every node's neighbours to the smallest of them and only ever emits as many edges as it reads, so a hub of
    any degree costs its degree; the number of steps grows with the logarithm of the longest path. Every second step is a
    stored table. Null ends and loops are left out.
    """
    pairs = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    pairs = store(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = _state(pairs)
        if now == before or not now[0]:
            break
        before = now
        # large star: v > u hooks to the smallest of u and its neighbours
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours hook to the smallest of them; here a > b holds
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        done = store(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        discard(pairs)
        pairs = done
    members = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
