"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import stored

MAX_ROUNDS = 60


def _star(pairs: DataFrame, name: str) -> DataFrame:
    """Every neighbour v of u is tied to the smallest of u and its neighbours.

    The minima are aggregated before the shuffle, and stored, so that the join can split a node with very many neighbours.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(stored(least, f"{name}-least"), "u")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for each node of the edges (a, b): the smallest node it can reach.

    Each round is written to the shared folder. The driver sees a count and a checksum of a round, nothing else.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, name).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, f"{name}-large")
        tied = _star(large, name)
        small = (
            tied.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(tied.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = stored(small, name)
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == before or not now[0]:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
        before = now
    raise RuntimeError("the components did not settle")
