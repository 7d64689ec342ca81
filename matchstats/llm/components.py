"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import dropped, written


def components(links: DataFrame) -> DataFrame:
    """node, root of every node in ``links`` (a, b: long); root is the least
    node reachable.

    Links are replaced, in turn, by a node's larger neighbours' links to its
    least neighbour and by its smaller neighbours' links to the least one, so
    that every component becomes a star; the number of rounds grows with the
    logarithm of the component's size.  Each round is written to the shared
    folder.  A node's least neighbour is an aggregate combined before the
    shuffle; a hot node's links are joined back over rows that Spark may split.
    """
    def directed(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(edges)
    while True:
        both = directed(edges)
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        before, edges = edges, written(small, "links")
        dropped(before)
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
