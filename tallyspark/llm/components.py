"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component: smallest node reachable) for every node of ``edges``(a, b).

    Alternates two steps until nothing changes: every node hangs its larger neighbours under the
    smallest of its neighbourhood, then its smaller ones. A path halves each round, so the rounds
    grow with the logarithm of the longest path. A hub's edges meet in partial minima before
    the shuffle; each round is written, so lost executors cost one round at most.
    """
    pairs = written(edges.filter("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: larger neighbours of a node go to the smallest of its neighbourhood
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        # small star: smaller neighbours, and the node itself, go to the smallest neighbour
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        last, pairs = pairs, written(small, "stars")
        forget(last)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component") \
                .unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
