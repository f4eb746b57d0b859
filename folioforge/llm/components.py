"""Connected components by hooking and contraction, on DataFrames alone.

Nodes have a fixed random order (a hash). In each round every node hooks onto its least neighbour if that is less than itself, follows two more hooks, and the edges are drawn again between
the places reached; edges within one place go. No step gathers a node's neighbours: the minimum is combined before the shuffle and the joins have exchanges that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.support import written


def components(edges: DataFrame) -> DataFrame:
    """node and place for every node of edges (a, b: long); two nodes have the same place if and only if edges connect them. Which node is the place is arbitrary but repeatable."""
    pair = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = written(pair.distinct(), "edges")
    steps = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(left.select("b", "a"))
        least = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v")).alias("m"))
        hook = F.when(F.col("m") < F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("v")), F.col("m.v")).otherwise(F.col("u"))
        hooks = written(least.select("u", hook.alias("p")), "hooks")
        for _ in range(2):
            up = hooks.select(F.col("u").alias("p"), F.col("p").alias("up"))
            hooks = hooks.join(up, "p").select("u", F.col("up").alias("p"))
        hooks = written(hooks, "places")
        steps.append(hooks)
        at = left.join(hooks.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a").join(hooks.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b")
        left = written(at.where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("place"))
    found = steps[0].select(F.col("u").alias("node"), F.col("p").alias("place"))
    for step in steps[1:]:
        on = step.select(F.col("u").alias("place"), F.col("p").alias("next"))
        found = found.join(on, "place", "left").select("node", F.coalesce("next", "place").alias("place"))
    return found
