"""Connected components of link tables, kept in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``links`` (long columns a, b).

    The component is its smallest node.  Rounds alternate the two star steps:
    every node points its larger (then its smaller) neighbours to the smallest
    neighbour it knows, until nothing changes; the number of rounds grows with
    the logarithm of the longest chain.  Each round is written to the shared
    folder, so the plan stays short and lost executors cost one round at most.
    Links that have not settled after ``max_rounds`` (chains of some 2**40 nodes)
    raise an error.
    """
    now = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first, the minima meet the links in a join of its own, which Spark can
        # split where one node has very many links.
        least = settled(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a").select("a", "b", "m")
        linked = star.select(F.col("a"), F.col("m").alias("b")).unionByName(star.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = settled(linked.where("a <> b").distinct())
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"links have not settled after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
