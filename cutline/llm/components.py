"""Connected components of an edge table by alternating star steps; nothing but the edges' count and checksum is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutline.llm.common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b: long); component: the smallest id that links reach.

    A large step hangs all larger neighbours of a node on its smallest neighbour, a small step does so with the smaller ones.
    The smallest neighbours are stored before they are joined, so a node with many neighbours is a skewed join that Spark
    splits, and the aggregations combine before their shuffle. The number of rounds grows with the logarithm of the nodes.
    """
    now = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = stored(both.where("b > a").join(smallest, "a").select(F.col("m").alias("a"), "b").distinct())
        least = stored(large.groupBy("b").agg(F.min("a").alias("m")))
        hung = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        now = stored(hung.unionByName(least.select(F.col("m").alias("a"), "b")).distinct())
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return roots.unionByName(now.select(F.col("b").alias("id"), F.col("a").alias("component")))
