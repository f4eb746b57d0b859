"""A nearest-neighbour index: navigable graphs of points, kept as rows, searched by beams and merged.

Points are dealt by the hash of their id to parts of a bounded size. Within a part each point is linked with its m nearest ones, found by products of blocks, with those that have it among theirs, and with a few others drawn by its id, so that a
search gets from anywhere to anywhere. A search starts at a few points of each part, follows links from the best ones seen, keeps ef of them, and a window over the parts' results has the k best. The index is an ordinary table; new points change only
the parts they belong to. It is approximate: vectors.top_k is the exact search.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators import vectors

#: Points of a part: held by one task, as are their links. Points multiplied at once; share of m that is drawn; points at which a search starts.
PART_ROWS, BLOCK, DRAWN, STARTS = 20_000, 1024, 4, 8
#: Points up to which a part's queries are searched together; scores held for them at once.
SMALL, STEP = 1024, 1 << 17
SHAPE = "part long, parts long, id long, vector array<float>, links array<long>"


def _scaled(vectors: np.ndarray, kind: str) -> np.ndarray:
    """Vectors whose dot products order points as the distance does: unit ones for the cosine; for l2, with their halved squares as one more dimension of the points."""
    if kind == "cosine":
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    return np.hstack([vectors, -0.5 * (vectors**2).sum(axis=1, keepdims=True)]) if kind == "l2" else vectors


def _asked(vectors: np.ndarray, kind: str) -> np.ndarray:
    return np.hstack([vectors, np.ones((len(vectors), 1))]) if kind == "l2" else _scaled(vectors, kind)


def _kind(distance: str) -> str:
    kind = distance.strip().lower()
    return "l2" if kind in ("l2", "euclid", "euclidean") else "dot" if kind == "dot" else "cosine"


def _linked(part: pd.DataFrame, m: int, kind: str) -> pd.DataFrame:
    part = part.drop_duplicates("id").sort_values("id", ignore_index=True)
    ids, n = part["id"].to_numpy(), len(part)
    raw = np.array(part["vector"].tolist(), float)
    points, near = _scaled(raw, kind), min(m, n - 1)
    best = np.zeros((n, near), np.int64)
    for low in range(0, n if near else 0, BLOCK):
        scores = _asked(raw[low : low + BLOCK], kind) @ points.T
        scores[np.arange(len(scores)), np.arange(low, low + len(scores))] = -np.inf
        best[low : low + BLOCK] = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    rng = np.random.default_rng(int(ids[0]) & 0xFFFFFFFF)
    drawn = rng.integers(0, n, (n, max(1, m // DRAWN)))
    mutual: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(best.tolist()):
        for j in row:
            if len(mutual[j]) < m:
                mutual[j].append(i)
    links = [ids[np.setdiff1d(np.concatenate([best[i], drawn[i], np.array(mutual[i], np.int64)]), [i])] for i in range(n)]
    return part.assign(links=links)[["part", "parts", "id", "vector", "links"]]


def _sound(points: DataFrame, id_col: str, vector_col: str, size: int | None) -> DataFrame:
    """id and vector of the points that can be compared: an id, and a vector of the size asked for without nulls or numbers that aren't finite."""
    at = points.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    at = at.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return at if size is None else at.where(F.size("vector") == size)


def graph_index(points: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", m: int = 16, distance: str = "cosine", part_rows: int = PART_ROWS) -> DataFrame:
    """part, parts, id, vector and links of each point: the index. Points of the most frequent size (of several, the largest) are in it; those without id or with a null, empty or non-finite vector aren't; of points with one id, one is."""
    sound = _sound(points, id_col, vector_col, None)
    sizes = sound.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("many"), F.desc("size")).limit(1).collect()
    size, n = (sizes[0]["size"], sizes[0]["many"]) if sizes else (0, 0)
    parts = max(1, -(-n // part_rows))
    dealt = sound.where(F.size("vector") == size).select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("long").alias("part"), F.lit(parts).cast("long").alias("parts"), "id", "vector")
    kind = _kind(distance)
    return dealt.groupBy("part").applyInPandas(lambda part: _linked(part, m, kind), SHAPE)


def inserted(index: DataFrame, points: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", m: int = 16, distance: str = "cosine") -> DataFrame:
    """The index with new points, which take the places of those with their ids. Only parts that get points are linked again. A part grows with them: build anew when the table has doubled."""
    known = index.select("parts", F.size("vector").alias("size")).limit(1)
    new = _sound(points, id_col, vector_col, None).join(F.broadcast(known), F.size("vector") == F.col("size"))
    new = new.select(F.pmod(F.xxhash64("id"), F.col("parts")).cast("long").alias("part"), "parts", "id", "vector")
    touched = new.select("part").distinct()
    old = index.join(touched, "part", "left_semi").join(new.select("id"), "id", "left_anti").select("part", "parts", "id", "vector")
    kind = _kind(distance)
    again = old.unionByName(new).groupBy("part").applyInPandas(lambda part: _linked(part, m, kind), SHAPE)
    return index.join(touched, "part", "left_anti").select("part", "parts", "id", "vector", "links").unionByName(again)


def _beam(query: np.ndarray, points: np.ndarray, links: list[np.ndarray], starts: np.ndarray, ef: int) -> list[tuple[float, int]]:
    """(score, place) of the ef best points that a beam finds."""
    seen = np.zeros(len(points), bool)
    seen[starts] = True
    ahead = [(-s, p) for s, p in zip((points[starts] @ query).tolist(), starts.tolist(), strict=True)]
    heapq.heapify(ahead)
    best = heapq.nlargest(ef, [(-s, p) for s, p in ahead])
    heapq.heapify(best)
    while ahead:
        s, p = heapq.heappop(ahead)
        if len(best) >= ef and -s < best[0][0]:
            break
        new = links[p][~seen[links[p]]]
        seen[new] = True
        for score, place in zip((points[new] @ query).tolist(), new.tolist(), strict=True):
            if len(best) < ef or score > best[0][0]:
                heapq.heappush(ahead, (-score, place))
                heapq.heappush(best, (score, place))
                if len(best) > ef:
                    heapq.heappop(best)
    return best


def _beams(asked: np.ndarray, points: np.ndarray, links: list[np.ndarray], starts: np.ndarray, ef: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """What _beam() finds for each query (scores and places, the best first), all queries of a small part a step at a time: each follows the links of the best point seen that it has not followed yet, until ef points seen are better."""
    scores = asked @ points.T
    order = np.argsort(-scores, axis=1, kind="stable")
    rank, places = np.empty_like(order), np.arange(len(points))
    np.put_along_axis(rank, order, places[None, :], axis=1)
    linked = np.array([np.r_[row, np.full(max(map(len, links)) - len(row), i)] for i, row in enumerate(links)], np.int64)
    live, seen = np.arange(len(asked)), np.zeros(scores.shape, bool)  # by rank: the first place is the query's best point
    seen[live[:, None], rank[:, starts]] = True
    ahead = seen.copy()
    while len(live):
        now = ahead[live]
        best = now.argmax(axis=1)
        on = now[np.arange(len(live)), best] & ((seen[live] & (places < best[:, None])).sum(axis=1) < ef)
        live, best = live[on], best[on]
        ahead[live, best] = False
        next_ = rank[live[:, None], linked[order[live, best]]]
        rows = live[:, None]
        ahead[rows, next_] |= ~seen[rows, next_]
        seen[rows, next_] = True
    first = np.argsort(~seen, axis=1, kind="stable")[:, :ef]
    return [(own[at[by]], at[by]) for own, at, by in zip(scores, order, (row[mark[row]] for row, mark in zip(first, seen, strict=True)), strict=True)]


def search(index: DataFrame, queries: DataFrame, k: int = 7, ef: int = 100, distance: str = "cosine") -> DataFrame:
    """qid, rank, id and score of about the k nearest points of each query (qid, query); a query isn't its own neighbour. Queries go to every part, a copy for each cell of parts that one task searches; what comes back are k rows for each cell and query. The index should be a written table: its rows are counted first."""
    kind = _kind(distance)

    def near(part: pd.DataFrame, qids: np.ndarray, raw_asked: np.ndarray) -> pd.DataFrame:
        part = part.sort_values("id", ignore_index=True)
        ids, raw = part["id"].to_numpy(), np.array(part["vector"].tolist(), float)
        points = _scaled(raw, kind)
        links = [np.searchsorted(ids, np.asarray(x, np.int64)) for x in part["links"]]
        starts = np.unique(np.linspace(0, len(ids) - 1, STARTS).astype(int))
        asked, wide, out = _asked(raw_asked, kind), max(ef, k + 1), []
        step = max(1, STEP // len(ids))
        for low in range(0, len(asked), step):
            some = asked[low : low + step]
            if len(ids) <= SMALL:
                found = _beams(some, points, links, starts, wide)
            else:
                found = [tuple(np.array(x) for x in zip(*_beam(q, points, links, starts, wide), strict=True)) for q in some]
            for q, (scores, places) in enumerate(found, low):
                other = ids[places] != qids[q]
                scores, places = scores[other], places[other]
                best = np.lexsort((ids[places], -scores))[:k]
                out.append((np.full(len(best), q), places[best], scores[best]))
        q, places, scores = (np.concatenate(x) for x in zip(*out, strict=True))
        if kind == "l2":
            scores = -np.sqrt(np.maximum(0.0, (raw_asked[q] ** 2).sum(axis=1) - 2 * scores))
        return pd.DataFrame({"qid": qids[q], "id": ids[places], "score": scores})

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out = pd.DataFrame({"qid": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if len(held) and len(asked):
            size = len(held["vector"][0])
            asked = asked.filter(pa.array(pc.fill_null(pc.equal(pc.list_value_length(asked["query"]), size), False).to_numpy()))
        if len(held) and len(asked):
            qids, raw = asked["qid"].to_numpy(), vectors.matrix(asked["query"], size)
            for _, part in held.to_pandas().groupby("part"):
                out = pd.concat([out, near(part, qids, raw)])
                out = out.sort_values(["qid", "score", "id"], ascending=[True, False, True]).groupby("qid").head(k)
        return pa.Table.from_pandas(out, preserve_index=False)

    facts = index.agg(F.count(F.lit(1)).alias("rows"), F.max("parts").alias("parts")).first()
    n, parts = queries.count(), facts["parts"] or 1
    blocks = max(1, -(-n // vectors.QUERY_ROWS))
    width = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = min(parts, max(-(-facts["rows"] // PART_ROWS), -(-width // blocks), 1))
    dealt = index.select(F.pmod("part", F.lit(cells)).cast("int").alias("cell"), "part", "id", "vector", "links")
    asked = queries.select(F.col("qid").cast("long").alias("qid"), F.col("query").cast("array<float>").alias("query")).where("qid IS NOT NULL AND query IS NOT NULL")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    each = vectors.crossed(dealt, asked, cells, blocks, run, "qid long, id long, score double")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("qid", "rank", "id", "score")
