"""Components of a similarity graph from lists of candidates, without spelling out the pairs of a list.

A list holds the nodes that share a signature. In each of two rounds a list has a leader, and its nodes are compared with the leader alone: first its least node; then the node most like that, which in a group of
copies is their original. A list whose nodes are in one component is then done: comparing them further can't change any component. In the lists that are left, every node outside of the list's largest
component is compared with the nodes of other components that cheap bounds don't rule out while lists are joined. Together these are all pairs that the rounds left open, so no link that joins components is missed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.components import components
from folioforge.llm.support import written

ROUNDS = 2


def connected(members: DataFrame, facts: DataFrame, maybe: Callable[[str, str], Column], verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node and place of every node with a link.

    members: key and node (long), each pair once. facts: node and what maybe(a, b) needs to rule out pairs cheaply (as a_name and b_name). verify takes pairs (a, b) and returns them with far, their distance, and link.
    """
    carried = [c for c in facts.columns if c != "node"]
    lists = members.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("lead")).where("many > 1")
    open_ = written(members.join(lists, "key").select("key", "node", "lead"), "lists")
    named = lambda p: facts.select(F.col("node").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in carried])

    def judged(pairs: DataFrame, name: str, bounded: bool = False) -> DataFrame:
        """bounded: maybe has been asked."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if not bounded:
            pairs = pairs.join(named("a"), "a").join(named("b"), "b").where(maybe("a", "b")).select("a", "b")
        return written(verify(pairs).select("a", "b", "far", "link"), name)

    edges = place = None
    for k in range(ROUNDS):
        found = judged(open_.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")), f"judged-{k}").where("link")
        edges = found if edges is None else edges.unionByName(found)
        place = written(components(edges.select("a", "b")), f"places-{k}")
        told = found.select(F.col("a").alias("lead"), F.col("b").alias("node"), "far").unionAll(found.select("b", "a", "far"))
        at = open_.select("key", "node", "lead").join(place, "node", "left").withColumn("place", F.coalesce("place", "node")).join(told, ["lead", "node"], "left")
        at = written(at, f"placed-{k}")
        mixed = at.groupBy("key").agg(F.min("place").alias("p"), F.max("place").alias("q"), F.min(F.when(F.col("far").isNotNull(), F.struct("far", "node"))).alias("like"))
        mixed = mixed.where("p != q").select("key", F.col("like.node").alias("next"))
        open_ = written(at.join(mixed, "key").select("key", "node", "place", F.coalesce("next", "lead").alias("lead")), f"open-{k}")
        if open_.isEmpty():
            return place

    open_ = open_.select("key", "node", "place").join(facts, "node")
    parts = open_.groupBy("key", "place").agg(F.count(F.lit(1)).alias("many"))
    largest = written(parts.groupBy("key").agg(F.max_by("place", F.struct("many", "place")).alias("largest")), "largest")
    full = open_.join(largest, "key")
    side = lambda p, rows, *more: rows.select("key", *[F.col(c).alias(f"{p}_{c}") for c in ("place", *carried)], F.col("node").alias(p), *more)
    once = (F.col("b_place") == F.col("largest")) | (F.col("a") < F.col("b"))
    rest = side("a", full.where("place != largest")).join(side("b", full, "largest"), "key").where((F.col("a_place") != F.col("b_place")) & once & maybe("a", "b")).select("a", "b")
    more = judged(rest, "judged-rest", True).where("link")
    if more.isEmpty():
        return place
    return components(edges.unionByName(more).select("a", "b"))
