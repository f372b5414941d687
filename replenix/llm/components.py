"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replenix.llm.common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b); the component is the smallest node reachable.  ``edges`` is
    read more than once, so it should be a written table.

    Every step is one aggregate (the smallest neighbour, combined map-side) and one join with that unique side, so
    a node with very many neighbours is split like any skewed join.  Each round's edges are written to the shared
    folder: a lost executor costs a re-read.  Done when all edges lead from a node that has no other edge to one
    that leads nowhere: then these are the components.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    for _ in range(rounds):
        if _only_stars(pairs):
            break
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        down = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lowest.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        pairs = stored(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    pairs = pairs.distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _only_stars(pairs: DataFrame) -> bool:
    """No node leads to two others, none both leads and is led to."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
        pairs.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("to")))
    seen = ends.groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.count("to").alias("leads"),
                                    F.count("*").alias("n"))
    return seen.where("lo <> hi or (leads > 0 and leads < n)").isEmpty()
