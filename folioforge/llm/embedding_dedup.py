"""Near-duplicate embeddings: PCA-ordered tiles, compared with early stopping.

Vectors are scaled to length one and turned to their principal axes, so that the leading dimensions hold most of what differs. Within a label they fall into cells of a grid over the first
axes whose width is the largest distance that a linked pair can have; only cells that touch are compared. A cell's vectors are dealt into tiles of bounded size, and one task compares
one pair of tiles: products of the leading dimensions first, then the rest in steps, while product + (suffix norm of one) * (suffix norm of the other) can still reach the threshold. What is left is verified by
the cosine of the vectors as they came, in double precision. A tile pair returns for each linked vector its number of links and one edge to its group in this pair: never the pairs themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.components import components
from folioforge.llm.support import bounded_batches, written

THRESHOLD = 0.93
#: Vectors of a tile; axes of the grid; dimensions after which a pair is looked at again.
TILE, AXES, STEPS = 2048, 2, (8, 16, 32)
SLACK = 1e-9


def _gram(vectors: DataFrame) -> np.ndarray:
    """The sum of the outer products of all vectors: each task sums its own, then entries are summed; d * d numbers reach the driver."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, some in pdf.groupby(pdf["unit"].str.len())["unit"]:
                x = np.stack(some.to_numpy())
                total[d] = total.get(d, 0) + x.T @ x
        for d, m in total.items():
            i, j = np.divmod(np.arange(d * d), d)
            yield pd.DataFrame({"d": d, "i": i, "j": j, "v": m.ravel()})

    cells = vectors.select("unit").mapInPandas(run, "d long, i long, j long, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    found = {}
    for d, m in cells.groupby("d"):
        gram = np.zeros((d, d))
        gram[m["i"], m["j"]] = m["v"]
        found[int(d)] = np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()
    return found


def _close(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b (unit vectors, in PCA order) whose product may reach the threshold: sums grow by dimensions, and what suffix norms rule out stops."""
    d = a.shape[1]
    stops = [s for s in STEPS if s < d] + [d]
    tail = lambda x, s: np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x[:, :s], x[:, :s])))
    sums = a[:, : stops[0]] @ b[:, : stops[0]].T
    i, j = np.nonzero(sums + np.outer(tail(a, stops[0]), tail(b, stops[0])) >= threshold - SLACK)
    value = sums[i, j]
    for low, high in zip(stops, stops[1:], strict=False):
        ta, tb, keep_i, keep_j, keep_v = tail(a, high), tail(b, high), [], [], []
        for lo in range(0, len(i), 1 << 16):
            ii, jj = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
            v = value[lo : lo + (1 << 16)] + np.einsum("ij,ij->i", a[ii, low:high], b[jj, low:high])
            ok = v + ta[ii] * tb[jj] >= threshold - SLACK
            keep_i.append(ii[ok]), keep_j.append(jj[ok]), keep_v.append(v[ok])
        i, j, value = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keep_i, int), (keep_j, int), (keep_v, float)))
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each row's group."""
    top = np.arange(n)
    while True:
        low = np.minimum(top[i], top[j])
        new = top.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == top).all():
            return top
        top = new


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] != 2], pdf[pdf["side"] != 1]
        same = len(left) == len(right) == len(pdf)
        node = pdf["node"].to_numpy()
        row = pd.Series(np.arange(len(pdf)), index=pdf.index)
        la, lb = row[left.index].to_numpy(), row[right.index].to_numpy()
        empty = pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "top": np.zeros(0, np.int64)})
        if not len(la) or not len(lb):
            return empty
        a, b = np.stack(left["axes"].to_numpy()), np.stack(right["axes"].to_numpy())
        i, j = _close(a, b, threshold)
        i, j = la[i], lb[j]
        if same:
            i, j = i[i < j], j[i < j]
        raw = np.stack(pdf["vector"].to_numpy())
        length = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        good = [np.einsum("ij,ij->i", raw[i[lo : lo + 65536]], raw[j[lo : lo + 65536]]) / (length[i[lo : lo + 65536]] * length[j[lo : lo + 65536]]) >= threshold for lo in range(0, len(i), 65536)]
        good = np.concatenate(good) if good else np.zeros(0, bool)
        i, j = i[good], j[good]
        if not len(i):
            return empty
        copies = pdf["copies"].to_numpy()
        links = np.zeros(len(pdf), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        top, has = _forest(len(pdf), i, j), links > 0
        return pd.DataFrame({"node": node[has], "links": links[has], "top": node[top[has]]})

    return run


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    Two rows link if their labels are equal and not null, their vectors have the same length, and their cosine is at least threshold. A vector that is null, empty, zero or has a null or non-finite component, or whose label is null, links with
    nothing: n_links 0, component_id its own id. Equal vectors of a label are one node and count as links of each other (repeated rows too). component_id is the least id of the component; null ids are passed over, and a component of null ids alone has none.
    kept says that a row's id is component_id. An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    wide = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), wide.alias("vector"))
    largest = F.array_max(F.transform("vector", F.abs))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    sound = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite & (largest > 0)
    # Squares of very large or small doubles leave their range, so lengths are taken after a shift of exponents, which changes no digit.
    shift = (-F.floor(F.log2(largest))).cast("int")
    half = F.floor(shift / 2).cast("int")
    scaled = F.transform("vector", lambda x: x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half))
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    rows = written(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    good = rows.where("sound")

    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = classes.select(F.monotonically_increasing_id().alias("node"), "label", "vector", "first", "copies")
    classes = classes.withColumn("scaled", scaled).withColumn("length", length)
    classes = written(classes.withColumn("unit", F.transform("scaled", lambda x: x / F.col("length"))), "vector-classes")

    axes = _gram(classes)
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    def turn(batches):
        for pdf in batches:
            turned = [u @ axes[len(u)] for u in pdf["unit"]]
            cells = [[int(np.floor(t[k] / width)) if k < len(t) else 0 for k in range(AXES)] for t in turned]
            yield pd.DataFrame({"node": pdf["node"], "label": pdf["label"], "copies": pdf["copies"], "vector": pdf["vector"], "axes": turned, "d": [len(t) for t in turned], "cell": cells})

    kind = vectors.schema[label_col].dataType.simpleString()
    shape = f"node long, label {kind}, copies long, vector array<double>, axes array<double>, d int, cell array<int>"
    turned = written(classes.select("node", "label", "copies", F.col("scaled").alias("vector"), "unit").mapInPandas(turn, shape), "turned")

    cells = written(turned.groupBy("label", "d", "cell").agg(F.count(F.lit(1)).alias("n")).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int")), "cells")
    steps = [[x, y] for x in (-1, 0, 1) for y in (-1, 0, 1)]
    near = cells.select("label", "d", "cell", "tiles", F.explode(F.array(*[F.array(*[F.lit(v) for v in s]) for s in steps])).alias("step"))
    near = near.withColumn("other", F.zip_with("cell", "step", lambda a, b: a + b))
    other = cells.select("label", "d", F.col("cell").alias("other"), F.col("tiles").alias("other_tiles"))
    near = written(near.join(other, ["label", "d", "other"]).select("label", "d", "cell", "tiles", "other", "other_tiles"), "near-cells")

    dealt = turned.join(near, ["label", "d", "cell"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("their", F.explode(F.sequence(F.lit(0), F.col("other_tiles") - 1)))
    mine, them = F.struct(F.col("cell").alias("c"), F.col("own").alias("t")), F.struct(F.col("other").alias("c"), F.col("their").alias("t"))
    side = F.when(mine == them, F.lit(0)).when(mine < them, F.lit(1)).otherwise(F.lit(2))
    paired = dealt.select("label", "d", F.least(mine, them).alias("low"), F.greatest(mine, them).alias("high"), side.alias("side"), "node", "copies", "vector", "axes")
    found = paired.groupBy("label", "d", "low", "high").applyInPandas(_compare(threshold), "node long, links long, top long")
    found = written(found, "links")

    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    place = components(found.select(F.col("node").alias("a"), F.col("top").alias("b")))
    classes = classes.select("node", "label", "vector", "first", "copies").join(sums, "node", "left").join(place, "node", "left").withColumn("place", F.coalesce("place", "node"))
    least = classes.groupBy("place").agg(F.min("first").alias("component"))
    classes = classes.join(least, "place").select("label", "vector", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = good.select("vec_id", "label", "vector").join(classes, ["label", "vector"]).select("vec_id", "n_links", F.col("component").alias("component_id"))
    out = out.unionByName(rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
