"""Vector records: distances, exact top-k search, point ids, the latest record of each point."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries and points that one task holds, and numbers that it works on at once: the memory of a search is bounded by these, whatever the tables' sizes.
QUERY_ROWS, POINT_ROWS, LEAST_POINTS, AT_ONCE = 16_384, 65_536, 1024, 1 << 22
#: Squared lengths of vectors whose products are found by blocks; others, and vectors with numbers that aren't finite, are scored one by one.
_USUAL = (1e-100, 1e100)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def score(a: Column, b: Column, distance: str = "cosine") -> Column:
    """Larger is nearer: the dot product, the negated Euclidean distance, or else the cosine, which is 0 for a vector of zeros. Null for null vectors, null components and vectors of different lengths."""
    kind = distance.strip().lower()
    if kind == "dot":
        return dot(a, b)
    if kind in ("l2", "euclid", "euclidean"):
        return -F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)), F.lit(0.0), lambda s, x: s + x))
    length = norm(a) * norm(b)
    return F.when((length == 0) & (F.size(a) == F.size(b)), F.lit(0.0)).otherwise(F.try_divide(dot(a, b), length))


def crossed(points: DataFrame, queries: DataFrame, cells: int, blocks: int, run, shape: str) -> DataFrame:
    """run(arrow table of points, arrow table of queries) for each pair of a cell of points (column cell, from 0) and a block of queries (dealt by the hash of qid). No task holds more than one pair; a number of tasks is stated, as Spark would join small ones."""
    key = (F.col("cell") * blocks + F.col("block")).cast("int").alias("pair")
    tasks = min(4096, 2 * cells * blocks)
    left = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(key, *[c for c in points.columns if c != "cell"])
    right = queries.withColumns({"block": F.pmod(F.xxhash64("qid"), F.lit(blocks)), "cell": F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))}).select(key, *queries.columns)
    return left.repartition(tasks, "pair").groupBy("pair").cogroup(right.repartition(tasks, "pair").groupBy("pair")).applyInArrow(run, shape)


def matrix(column, size: int) -> np.ndarray:
    """A column of lists of that size as rows of doubles."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), size)


def _sum(terms: np.ndarray) -> np.ndarray:
    """Sums of rows from left to right, as dot() adds them: equal vectors have equal scores wherever they stand."""
    return np.cumsum(terms, axis=1)[:, -1] if terms.shape[1] else np.zeros(len(terms))


def _scores(q: np.ndarray, p: np.ndarray, kind: str) -> np.ndarray:
    """score() of rows of q and p."""
    if kind == "l2":
        return -np.sqrt(_sum((q - p) ** 2))
    if kind == "dot":
        return _sum(q * p)
    length = np.sqrt(_sum(q * q)) * np.sqrt(_sum(p * p))
    return np.where(length == 0, 0.0, np.divide(_sum(q * p), length, out=np.zeros(len(q)), where=length != 0))


def _rounded(scores: np.ndarray, decimals: int | None) -> np.ndarray:
    if decimals is None:
        return scores
    near = np.round(scores, decimals)
    return np.where(np.isfinite(near), near, scores)


def _leading(row: np.ndarray, key: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row (NaN first, as Spark orders it; then larger keys, then smaller ranks)."""
    order = np.lexsort((rank, -np.nan_to_num(key, nan=0.0, posinf=np.inf, neginf=-np.inf), ~np.isnan(key), row))
    sorted_ = row[order]
    first = np.searchsorted(sorted_, sorted_)
    return order[np.arange(len(order)) - first < k]


def _nearest(q: np.ndarray, own: np.ndarray, p: np.ndarray, codes: np.ndarray, rank: np.ndarray, k: int, kind: str, decimals: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of q and p, score and key of the k best points (codes, rank) of each query (own: the code of its id). Products of blocks tell which points may be among them; what counts is the score of each of those."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]

    def judged(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal held
        step = max(1, AT_ONCE // max(1, p.shape[1]))
        for low in range(0, len(i), step):
            a, b = i[low : low + step], j[low : low + step]
            other = own[a] != codes[b]
            a, b = a[other], b[other]
            found = _scores(q[a], p[b], kind)
            all_ = [np.concatenate(x) for x in zip(held, (a, b, found, _rounded(found, decimals)), strict=True)]
            best = _leading(all_[0], all_[3], rank[all_[1]], k)
            held = [x[best] for x in all_]

    def pairs(i: np.ndarray, j: np.ndarray) -> None:
        step = max(1, AT_ONCE // max(1, p.shape[1] * len(j))) if len(j) else len(i)
        for low in range(0, len(i), step):
            some = i[low : low + step]
            judged(np.repeat(some, len(j)), np.tile(j, len(some)))

    with np.errstate(all="ignore"):
        q2, p2 = (q * q).sum(axis=1), (p * p).sum(axis=1)
        usual = lambda x: (x == 0) | ((x > _USUAL[0]) & (x < _USUAL[1]))
        qs, ps = np.flatnonzero(usual(q2)), np.flatnonzero(usual(p2))
        pairs(np.flatnonzero(~usual(q2)), np.arange(len(p)))
        pairs(qs, np.flatnonzero(~usual(p2)))
        done = held
        held = [x[:0] for x in held]
        unit = lambda x, x2: np.divide(x, np.sqrt(x2)[:, None], out=np.zeros_like(x), where=x2[:, None] > 0)
        left, right = (unit(q[qs], q2[qs]), unit(p[ps], p2[ps])) if kind == "cosine" else (q[qs], p[ps])
        half = 0.5 * p2[ps] if kind == "l2" else np.zeros(len(ps))
        most = p2[ps].max(initial=0.0)
        size = {"cosine": np.ones(len(qs)), "dot": np.sqrt(q2[qs] * most), "l2": q2[qs] + most}[kind]
        room = 1e-11 * size + (0.0 if decimals is None else 4 * 10.0**-decimals * (1 + (size if kind == "l2" else 0)))
        wide = min(len(ps), 8192) or 1
        tall = max(1, AT_ONCE // wide)
        for top in range(0, len(qs), tall):
            mine, floor = slice(top, top + tall), np.full(len(qs[top : top + tall]), -np.inf)
            seen = None
            for low in range(0, len(ps), wide):
                near = left[mine] @ right[low : low + wide].T - half[low : low + wide]
                near[own[qs[mine]][:, None] == codes[ps[low : low + wide]][None, :]] = -np.inf
                top_k = near if near.shape[1] <= k else np.partition(near, near.shape[1] - k, axis=1)[:, -k:]
                seen = top_k if seen is None else np.concatenate([seen, top_k], axis=1)
                if seen.shape[1] >= k:
                    seen = np.partition(seen, seen.shape[1] - k, axis=1)[:, -k:]
                    floor = seen.min(axis=1)
                i, j = np.nonzero(near >= (floor - room[mine])[:, None])
                judged(qs[top + i], ps[low + j])
            done = [np.concatenate(x) for x in zip(done, held, strict=True)]
            held = [x[:0] for x in held]
    best = _leading(done[0], done[3], rank[done[1]], k)
    return tuple(x[best] for x in done)


def _searched(points: pa.Table, queries: pa.Table, k: int, kind: str, decimals: int | None) -> pa.Table:
    """qid, id, score and key of the k best of these points for each of these queries. Of points with one vector only those with the k + 1 least ids are looked at."""
    out = []
    sizes = lambda t: pc.list_value_length(t["v"]).to_numpy()
    size_q, size_p = sizes(queries), sizes(points)
    for size in np.intersect1d(size_q, size_p).tolist():
        asked, given = queries.filter(pa.array(size_q == size)), points.filter(pa.array(size_p == size))
        p = matrix(given["v"], size)
        rank = pc.rank(given["id"], tiebreaker="dense").to_numpy().astype(np.int64)
        if size:
            same = np.unique(np.ascontiguousarray(p).view(np.dtype((np.void, p.dtype.itemsize * size))).ravel(), return_inverse=True)[1].ravel()
            order = np.lexsort((rank, same))
            s, r = same[order], rank[order]
            new = np.r_[True, (s[1:] != s[:-1]) | (r[1:] != r[:-1])].cumsum()
            keep = np.sort(order[new - new[np.searchsorted(s, s)] <= k])
            given, p, rank = given.take(pa.array(keep)), p[keep], rank[keep]
        codes = pa.chunked_array([*given["id"].chunks, *asked["own"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        i, j, score, key = _nearest(matrix(asked["v"], size), codes[len(given) :], p, codes[: len(given)], rank, k, kind, decimals)
        out.append(pa.table({"qid": asked["qid"].take(pa.array(i)), "id": given["id"].take(pa.array(j)), "score": score, "key": key}))
    return pa.concat_tables(out) if out else pa.table({"qid": queries["qid"][:0], "id": points["id"][:0], "score": pa.array([], pa.float64()), "key": pa.array([], pa.float64())})


def top_k(queries: DataFrame, points: DataFrame, k: int = 7, distance: str = "cosine", id_col: str = "vec_id", vector_col: str = "embedding", decimals: int | None = None) -> DataFrame:
    """qid, rank, id and score of the k nearest points of each query (qid, query); a query isn't its own neighbour; ties go to the smaller id. Points without a score (see score) are nobody's neighbours. decimals: scores that are alike when rounded to so many are ties.

    Each query is compared with every point, cells of points with blocks of queries, by products of matrices; every pair of them keeps its k best a query, and a window has the k best of those.
    """
    kind = distance.strip().lower()
    kind = "l2" if kind in ("l2", "euclid", "euclidean") else kind if kind == "dot" else "cosine"
    whole = lambda df: df.where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    given = points.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL")
    kinds = {c: df.schema[name].dataType.simpleString() for c, df, name in (("qid", queries, "qid"), ("id", given, "id"))}
    asked = queries.select("qid", F.col("qid").try_cast(kinds["id"]).alias("own"), F.col("query").cast("array<double>").alias("v")).where("qid IS NOT NULL")
    n, m = queries.count(), points.count()
    blocks = max(1, -(-n // QUERY_ROWS))
    width = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, -(-m // POINT_ROWS), min(-(-width // blocks), -(-m // LEAST_POINTS)))
    dealt = whole(given).withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells)))

    def run(p: pa.Table, q: pa.Table) -> pa.Table:
        return _searched(p, q, k, kind, decimals)

    found = crossed(dealt, whole(asked), cells, blocks, run, f"qid {kinds['qid']}, id {kinds['id']}, score double, key double")
    best = Window.partitionBy("qid").orderBy(F.col("key").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("qid", "rank", "id", "score")


#: Fixed value: the namespace of URLs for name-based identifiers (RFC 4122).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(key: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The name-based identifier (version 5) of a text."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), key.cast("binary")))
    third = F.concat(F.lit("5"), F.substring(h, 14, 3))
    fourth = F.concat(F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), F.substring(h, 18, 3))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), third, fourth, F.substring(h, 21, 12))


def point_key(record_type: str = "record_type") -> Column:
    parts = [F.col(record_type), F.coalesce(F.nullif("id", F.lit("")), "placeholder"), F.col("filename"), F.col("image_link"), F.col("section_path"), F.col("page_repr")]
    return F.array_join(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), "||")


def collection_name(base: str = "final_embeddings", distance: str = "cosine", m: int = 16, ef: int = 100, on_disk: bool = False) -> str:
    """The name of a collection: what isn't usual is appended."""
    said = [distance.lower()] * (distance.lower() != "cosine") + [f"m{m}-ef{ef}"] * ((m, ef) != (16, 100)) + ["disk"] * on_disk
    return "_".join([base, *said])


def with_collection(existing: DataFrame, points: DataFrame, name: str, distance: str = "cosine", m: int = 16, ef: int = 100, on_disk: bool = False) -> DataFrame:
    """The collections there are (name, size, distance, m, ef, on_disk), and the one named if there is none of that name yet. Its size is that of a stored vector; without vectors it isn't made."""
    kind = distance.strip().lower()
    kind = "euclid" if kind in ("l2", "euclid", "euclidean") else kind if kind == "dot" else "cosine"
    settings = {"distance": kind, "m": m, "ef": ef, "on_disk": on_disk}
    new = points.where("dense IS NOT NULL").limit(1).select(F.lit(name).alias("name"), F.size("dense").alias("size"), *[F.lit(v).alias(k) for k, v in settings.items()])
    return existing.unionByName(new.join(existing.select("name"), "name", "left_anti").select(*existing.columns))


def records(finals: DataFrame, provider, source: str = "") -> DataFrame:
    """Points to store: final records with text, their point_id, source_file and dense vector. Embedding runs in tasks, an Arrow batch at a time."""
    @F.pandas_udf("array<float>")
    def embedded(texts: pd.Series) -> pd.Series:
        return pd.Series(provider.embed(texts.tolist()))

    names = {"text": "texts", "table_str": "tables_str", "table_unstr": "tables_unstr", "image_formula": "images_formula", "image_sum": "images_sum", "image_trans": "images_trans"}
    file = F.lit(None).cast("string")
    for kind, name in names.items():
        file = F.when(F.col("record_type") == kind, F.lit(f"{source}{name}_final.json")).otherwise(file)
    kept = finals.where(F.coalesce("text", F.lit("")).rlike(r"(?U)\S"))
    return kept.withColumn("point_id", uuid5(point_key())).withColumn("source_file", file).withColumn("dense", embedded("text")).drop("keyword")


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key. Rows are combined before the shuffle, one a key and task."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r"))
    return best.select(key, "r.*").select(*rows.columns)


def last_written(new: DataFrame) -> DataFrame:
    """One row of each point_id: the last in ord, if there is one, and in the order of the rows."""
    order = F.struct(*[F.col(c) for c in ("ord",) if c in new.columns], F.monotonically_increasing_id())
    return latest(new.withColumn("__at", order), "point_id", "__at").drop("__at")


def upserted(stored: DataFrame, new: DataFrame) -> DataFrame:
    """What is stored after `new` is written over it by point_id; of points that are new twice, the last one stays."""
    fresh = last_written(new)
    return stored.join(fresh.select("point_id"), "point_id", "left_anti").unionByName(fresh.select(*stored.columns))
