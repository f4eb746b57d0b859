"""Exact search by products of matrices against brute force, and the graphs' search of many queries at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import graph_index as gi
from folioforge.operators import vectors


def brute(rows, asked, k, distance, decimals):
    """k best (qid, id) by sums from left to right, larger first, then the smaller id."""
    out = []
    for qid, q in asked:
        scored = []
        for i, p in rows:
            if i != qid:
                dot = sum(x * y for x, y in zip(q, p, strict=True))
                length = float(np.sqrt(sum(x * x for x in q)) * np.sqrt(sum(x * x for x in p)))
                s = dot if distance == "dot" else -float(np.sqrt(sum((x - y) ** 2 for x, y in zip(q, p, strict=True)))) if distance == "l2" else dot / length if length else 0.0
                scored.append((-(s if decimals is None else round(s, decimals)), i))
        out += [(qid, rank, i) for rank, (_, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("distance", ["cosine", "l2", "dot"])
@pytest.mark.parametrize("decimals", [None, 12])
def test_nearest_by_cells_and_blocks(spark, monkeypatch, distance, decimals):
    """Many cells, blocks and small steps; copies in all of them, scaled copies, zeros."""
    for name, value in {"QUERY_ROWS": 40, "POINT_ROWS": 60, "LEAST_POINTS": 20}.items():
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5).astype("f4")]) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(60)] + [(2000 + i, [4 * x for x in rows[5][1]]) for i in range(9)] + [(3000 + i, [0.0] * 5) for i in range(9)]
    points = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = [r for r in rows if r[0] % 3 == 0]
    queries = spark.createDataFrame(asked, "qid long, query array<float>")
    got = sorted((r.qid, r.rank, r.id) for r in vectors.top_k(queries, points, 5, distance, decimals=decimals).collect())
    assert got == brute(rows, asked, 5, distance, decimals)


def test_rounded_scores_tie_and_no_pair_is_spelled_out(spark):
    """Scores that differ by less than the rounding go by id, as in the queries' SQL; the plan joins no query with each point as a row."""
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1e-8]), (3, [1.0, 0.0]), (9, [1.0, 0.0])]
    points = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = points.where("vec_id = 9").selectExpr("vec_id AS qid", "embedding AS query")
    ids = lambda decimals: [r.id for r in vectors.top_k(asked, points, 3, decimals=decimals).orderBy("rank").collect()]
    assert ids(12) == [1, 2, 3]
    plan = vectors.top_k(asked, points, 3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_numbers_that_are_not_finite(spark):
    """NaN comes before all scores, as Spark orders it; very large and small vectors are scored as the expression scores them."""
    rows = [(1, [1.0, 2.0]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [1e160, 1e160]), (5, [1e-170, 1e-170]), (6, [2.0, 1.0]), (7, [0.0, 0.0])]
    points = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = points.selectExpr("vec_id AS qid", "embedding AS query")
    for distance in ("cosine", "l2", "dot"):
        scored = asked.crossJoin(points).where("qid != vec_id").select("qid", "vec_id", vectors.score(F.col("query"), F.col("embedding"), distance).alias("score")).where("score IS NOT NULL")
        want = {(r.qid, r.rank): (r.vec_id, repr(r.score)) for r in scored.selectExpr("qid", "vec_id", "score", "row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank").where("rank <= 4").collect()}
        got = {(r.qid, r.rank): (r.id, repr(r.score)) for r in vectors.top_k(asked, points, 4, distance).collect()}
        assert got == want


def test_beams_of_many_queries():
    rng = np.random.default_rng(5)
    points, asked = rng.normal(size=(200, 8)), rng.normal(size=(30, 8))
    links = [rng.permutation(200)[:12] for _ in range(200)]
    starts = np.arange(0, 200, 50)
    for q, (scores, places) in zip(asked, gi._beams(asked, points, links, starts, 20), strict=True):
        assert sorted(places.tolist()) == sorted(p for _, p in gi._beam(q, points, links, starts, 20)) and (np.diff(scores) <= 0).all()
