"""Connected components of an edge table, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").union(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b): root is the
    smallest node of its component, also for itself. Rounds (each written to
    the shared folder) are few: the logarithm of a component's width, squared."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                            F.least("a", "b").alias("b")).distinct(), label)
    state = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            break
        state = now
        e = stored(_small_star(_large_star(e)), label)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
