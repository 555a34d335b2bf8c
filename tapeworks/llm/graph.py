"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, join_groups


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node that it is connected with) for nodes of ``edges`` (a, b: long).

    Each round hangs every larger neighbour, then every smaller one, on the smallest of a
    node's neighbours, until nothing changes; the number of rounds grows with the
    logarithm of the components' size. Nodes with very many neighbours are joined apart from the others.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = seen = (edges.count(),)
    while True:
        most = 2 * state[0]  # rows of a join, at most
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        known = join_groups(both, least, ["a"], "n", most)
        hung = F.when(F.col("b") > F.col("a"), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))).when(F.col("m") < F.col("a"), F.struct("a", F.col("m").alias("b")))
        large = cut(known.select(hung.alias("e")).filter("e IS NOT NULL").select("e.*").distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_groups(large, lowest, ["a"], "n", most)
        edges = cut(small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        seen = state
