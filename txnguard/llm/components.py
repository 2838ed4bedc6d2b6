"""Connected components by alternating large-star and small-star rounds.

The rounds are logarithmic in the number of vertices in practice (chains of 10^9
take some thirty); more than ``max_rounds`` raise rather than return parts.

Each round is a few joins and grouped minima on tables written to the shared
folder, so the join that hands a vertex's minimum to its edges has plain
shuffles on both sides and a hub's edges can be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (a, b: long), component being its smallest vertex."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        if now.isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "large_min")
        # large star: greater neighbours move to the smallest of the neighbourhood
        large = materialize(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large_star")
        large = large.where("a <> b").distinct()
        # small star: a vertex and its smaller neighbours move to the smallest of them
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "small_min")
        moved = large.join(least, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = materialize(small.where("a <> b").distinct(), "edges")
        # done when every edge is a star around its component's smallest vertex: no centre is itself linked to a smaller one
        settled = after.select(F.col("b").alias("a")).join(after, "a", "left_semi").isEmpty() and _alone(after)
        now = after
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())


def _alone(edges: DataFrame) -> bool:
    """Whether each vertex has one centre."""
    return edges.groupBy("a").count().where("count > 1").isEmpty()
