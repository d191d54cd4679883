"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmx.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, component), the component's
    smallest node, for every node that has an edge.

    Each round links every node and its neighbours to the smallest of them
    (large star, then small star), so chains halve; it ends when a round
    changes nothing.  Groups are reduced to minima before they are shuffled,
    so a node with very many edges isn't gathered in a task.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # large star: neighbours above a node link to the smallest around it
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours link to the smallest
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        after = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                        .union(down.select("a", F.col("m").alias("b"))).distinct())
        # the set of links, by number and a sum of hashes (of 2**40 each, so that it can't overflow)
        state = after.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)).cast("decimal(38,0)"))).collect()[0]
        links = after
        if state == before:
            break
        before = state
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
