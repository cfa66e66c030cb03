"""Connected components of a graph given by its edges, as DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.common import Stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of the component of each node that an edge names.

    ``edges`` has ``a`` and ``b`` of one orderable type without nulls. In each round every node
    links its greater neighbours to its least neighbour, and then its lesser ones, which never
    separates a component and ends when each is a star round its least node. A node's neighbours
    are only aggregated, never gathered, so a hub is combined in each task before the shuffle.
    Every round is stored in the shared folder, so a lost executor costs one round at most.
    """
    current = Stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        one = current.df
        both = one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small_least, "a")
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.unionByName(small_least.select("a", F.col("m").alias("b"))).distinct()
        after = Stored(small)
        state = after.df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        current.drop()
        current = after
        if state == before:
            break
        before = state
    tree = current.df
    return tree.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        tree.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
