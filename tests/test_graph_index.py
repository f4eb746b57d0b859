"""The nearest-neighbour index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import graph_index as gi
from folioforge.operators import vectors


def points(spark, n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=16)).astype("f4").tolist(), "extra") for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, part string")


def hits(spark, index, every, distance):
    asked = every.where("vec_id % 20 = 0 AND size(embedding) = 16").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))
    near = {(r.qid, r.id): r.score for r in gi.search(index, asked, 5, 60, distance).collect()}
    exact = {(r.qid, r.id): r.score for r in vectors.top_k(asked, every, 5, distance).collect()}
    assert all(abs(near[x] - exact[x]) < 1e-5 for x in near.keys() & exact.keys()) and len(near) == len(exact)
    return len(near.keys() & exact.keys()) / len(exact)


@pytest.mark.parametrize("distance", ["cosine", "l2", "dot"])
def test_recall(spark, distance):
    every = points(spark, 1500, 1)
    assert hits(spark, gi.graph_index(every, distance=distance, part_rows=400), every, distance) >= 0.9


def test_insert_and_odd_rows(spark, tmp_path):
    every = points(spark, 900, 2)
    odd = spark.createDataFrame([(None, [1.0] * 16, ""), (9001, None, ""), (9002, [], ""), (9003, [None] * 16, ""), (9004, [float("nan")] * 16, ""), (9005, [1.0], ""), (9006, [float("inf")] * 16, "")], every.schema)
    first = gi.graph_index(every.where("vec_id < 600").union(odd), part_rows=150)
    first.write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    assert stored.count() == 600 and stored.select("part").distinct().count() == 4
    grown = gi.inserted(stored, every.where("vec_id >= 550"))
    grown.write.parquet(str(tmp_path / "grown"))
    grown = spark.read.parquet(str(tmp_path / "grown"))
    assert sorted(r.id for r in grown.collect()) == list(range(900))
    assert hits(spark, grown, every, "cosine") >= 0.9
    one = gi.inserted(grown, every.where("vec_id = 7").withColumn("vec_id", F.lit(5000).cast("long")))
    changed = one.join(grown, ["id", "part"], "left_anti").count()
    assert changed == 1 and gi.search(one, every.where("vec_id = 7").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query")), 1, 60).collect()[0].id == 5000


def test_empty(spark):
    none = points(spark, 1, 3).limit(0)
    index = gi.graph_index(none)
    assert index.count() == 0 and gi.search(index, none.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))).count() == 0
    alone = gi.graph_index(points(spark, 1, 3))
    assert [len(r.links) for r in alone.collect()] == [0]
