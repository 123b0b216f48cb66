"""Connected components by alternating large and small stars.

Every step keeps at most as many edges as there were and is stored, so nothing grows with
the depth of the plan; a node's smallest neighbour is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlark.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; ``a`` > ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of every node in ``a``, ``b``."""
    edges = common.stored(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = None
    while True:
        edges = common.stored(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("b", "b")
    )
