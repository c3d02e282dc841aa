"""Connected components of a graph too large for one machine, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select("a", F.col("m").alias("b")).unionByName(
        joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """Node and the smallest node it is linked to, for every node that has a link; ``edges`` are pairs a, b.

    A round halves what is left of long paths, so rounds grow with the logarithm of a component's size.
    """
    now, before = scratch.written(edges.select("a", "b").where("a <> b").distinct(), "edges"), None
    while True:
        now = scratch.written(_small(_large(now)).distinct(), "stars")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
