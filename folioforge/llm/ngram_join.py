"""Word n-gram Jaccard join, exact, by partitioning the universe of shingles (after Deng, Li, Wen and Feng).

A document is the set of its hashed five-word shingles. Sets of a size band share one partition of the universe into segments; a set's tokens in a segment, summed up, are one signature. If two sets have Jaccard similarity t or
more, they differ in at most H = (1 - t) / (1 + t) * (sum of sizes) tokens, so all but H of the segments that are not empty are equal in both. By the pigeonhole principle a set with more than H such
segments shares one of them with every partner.

Which segments a set puts into the index is decided by cost, the number of sets that have the same signature: the H + 1 rarest suffice, since all sets sort them alike (what one has ahead of the first shared one, the other lacks, and that can be H at most). Signatures that occur once
cost nothing; a set with H + 1 of them has no partner and leaves. So passages that many documents share are used only where nothing rarer is left. A set with too few segments for H + 1 adds each segment's one-deletion neighbourhood (it and its partner both do, or
one of them has enough), and one whose segments don't suffice even so, its single tokens. Nothing is capped or left out.

Sets that are equal are one node. Candidates whose parity sketches (one bit for each of SKETCH_BITS buckets of tokens: is their number odd?) differ in more than H bits differ in more than H tokens and are ruled out while lists are joined; the others are
verified on their whole sets.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.linking import connected
from folioforge.llm.secret_scan import text_buffers
from folioforge.llm.support import PRINT, bounded_batches, row_print, written

WORDS, SIMILAR = 5, 80
#: Tokens of a segment, on average, in the largest sets of a band.
PER_SEGMENT = 4
#: Bits of a set's parity sketch, a multiple of 64.
SKETCH_BITS = 1024
#: Bits of the sieve for signatures that occur more than once; its size is fixed, whatever the data.
SIEVE_BITS = 26
#: Rows of a list of ids (32 bytes each at most) up to which it is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 500_000

_U, _ALL = np.uint64, (1 << 64) - 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE, _FOLD_WORDS = 0x9E3779B97F4A7C55, _U(0xD6E8FEB86659FD93)
_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        p = np.empty(max(64, 2 * n), np.uint64)
        p[0] = 1
        np.multiply.accumulate(np.full(len(p) - 1, _BASE, np.uint64), out=p[1:])
        _POWERS[0] = p
    return _POWERS[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of each text, lower-cased in A-Z, and the number of the text that it is in."""
    ends, data = text_buffers(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_SPACE[data]
    before = np.concatenate([[False], solid[:-1]])
    before[ends[:-1][ends[:-1] < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(solid)
    word = np.cumsum((solid & ~before)[at]) - 1
    inside = at - starts[word]
    value = (_FOLD[data[at]].astype(np.uint64) + _U(1)) * _powers(int(inside.max()) + 1)[inside]
    first = np.flatnonzero(inside == 0)
    sums = np.add.reduceat(value, first)
    length = np.diff(np.concatenate([first, [len(at)]])).astype(np.uint64)
    return _mix(sums + length * _U(0xA24BAED4963EE407)), np.searchsorted(ends, starts, side="right") - 1


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of so many words; with fewer words, of the whole sequence; without words, none."""
    hashes, doc = word_hashes(texts)
    n = len(texts)
    cuts = np.searchsorted(doc, np.arange(n + 1))
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled = rolled * _FOLD_WORDS + hashes[k : k + len(rolled)]
    rolled = _mix(rolled)
    out = []
    for i in range(n):
        lo, hi = int(cuts[i]), int(cuts[i + 1])
        if hi - lo >= words:
            s = np.sort(rolled[lo : hi - words + 1])
            out.append(s if len(s) < 2 else s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif hi > lo:
            whole = np.full(1, hi - lo, np.uint64)
            for k in range(lo, hi):
                whole = whole * _FOLD_WORDS + hashes[k]
            out.append(_mix(whole ^ _U(0x5851F42D4C957F2D)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def difference(total: int, similar: int) -> int:
    """The most tokens in which two sets of `total` tokens together differ if 100 * common >= similar * union."""
    return (100 - similar) * total // (100 + similar)


def signatures(tokens: np.ndarray, band: int, most: int) -> tuple[np.ndarray, int]:
    """Signatures of a sorted set in a band, for partners from which it differs in `most` tokens at most; and how many of the rarest it must put into the index (-1: all)."""
    segments = (1 << (band + 1)) // PER_SEGMENT + 1
    at = ((tokens >> _U(32)) * _U(segments)) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    mixed = _mix(tokens + _U(0x632BE59BD9B4E019))
    sums = np.add.reduceat(mixed, first)
    place = at[first] * _U(0x9E3779B97F4A7C15) + _U((band + 1) * 0xC2B2AE3D27D4EB4F & _ALL)
    exact = _mix(sums ^ place)
    if len(exact) > most:
        return exact, most + 1
    size = np.diff(np.concatenate([first, [len(tokens)]]))
    segment = np.repeat(np.arange(len(first)), size)
    several = size[segment] > 1
    out = [exact, _mix((sums[segment] - mixed)[several] ^ place[segment][several])]
    if np.minimum(size, 2).sum() <= most:
        out.append(_mix(tokens ^ _U((band + 1) * 0x2545F4914F6CDD1D & _ALL)))
    return np.unique(np.concatenate(out)), -1


def indexed(tokens: np.ndarray, similar: int) -> list[tuple[np.ndarray, int]]:
    """The signatures of a set in its own band, for partners there, and in the next, if a larger partner can be in it."""
    n = len(tokens)
    band = n.bit_length() - 1
    largest = 100 * n // similar
    out = [signatures(tokens, band, difference(n + min(largest, (2 << band) - 1), similar))]
    if largest >= 2 << band:
        out.append(signatures(tokens, band + 1, difference(n + largest, similar)))
    return out


def sketch(tokens: np.ndarray) -> np.ndarray:
    """A bit for each bucket: whether an odd number of tokens fall into it. Two sketches differ in at most as many bits as the sets in tokens."""
    odd = np.bincount((_mix(tokens + _U(3)) % _U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))


def _few(ids: DataFrame) -> DataFrame:
    """Broadcast if there are few; else left to a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _described(docs: DataFrame, id_col: str, text_col: str, similar: int) -> DataFrame:
    """For each row: rid, print, doc_id, n, k1 and k2 (hashes of the set), and its signatures for two bands with what it must put into the index."""
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(f"`{text_col}`")
    plain = docs.select(F.monotonically_increasing_id().alias("rid"), row_print(id_col, text_col).alias("print"), F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                sets = shingle_sets(pc.fill_null(some.column(3), ""))
                keys = np.array([[len(s), _mix(s ^ _U(1)).sum(dtype=np.uint64) if len(s) else 0, _mix(s + _U(2)).sum(dtype=np.uint64) if len(s) else 0] for s in sets], np.uint64).reshape(-1, 3)
                found = [indexed(s, similar) if len(s) else [] for s in sets]
                none = (np.zeros(0, np.uint64), 0)
                a, b = [x[0] if x else none for x in found], [x[1] if len(x) > 1 else none for x in found]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), pa.array(keys[:, 0].astype(np.int64)), pa.array(_signed(keys[:, 1])), pa.array(_signed(keys[:, 2]))]
                    + [_lists([_signed(x[0]) for x in a]), pa.array([x[1] for x in a], pa.int32()), _lists([_signed(x[0]) for x in b]), pa.array([x[1] for x in b], pa.int32()), _lists([sketch(s) for s in sets])],
                    ["rid", "print", "doc_id", "n", "k1", "k2", "own", "own_need", "next", "next_need", "bits"],
                )

    return plain.mapInArrow(run, f"rid long, print {PRINT}, doc_id {kind}, n long, k1 long, k2 long, own array<long>, own_need int, next array<long>, next_need int, bits array<long>")


def _sieve(shared: DataFrame) -> np.ndarray:
    """A bit for each hash bucket that a signature of `shared` falls into: 2 ** SIEVE_BITS bits, gathered as words of 32."""
    bucket = F.col("key").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    words = shared.select(F.shiftright(bucket, 5).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(key & 31 as int))").alias("v")).groupBy("w").agg(F.bit_or("v").alias("v"))
    bits = np.zeros(1 << (SIEVE_BITS - 5), np.uint32)
    got = words.select("w", "v").toArrow()
    bits[got.column(0).to_numpy()] = got.column(1).to_numpy().astype(np.uint32)
    return bits


def _in(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bucket = keys & np.int64((1 << SIEVE_BITS) - 1)
    return (sieve[bucket >> 5] >> (bucket & 31).astype(np.uint32)) & np.uint32(1) > 0


def _selected(described: DataFrame) -> DataFrame:
    """key, node, n: what each set puts into the index."""
    spark = described.sparkSession
    bands = F.array(F.struct(F.col("own").alias("keys"), F.col("own_need").alias("need"), F.lit(0).alias("band")), F.struct(F.col("next").alias("keys"), F.col("next_need").alias("need"), F.lit(1).alias("band")))
    rows = described.select(F.col("rid").alias("node"), "n", F.explode(bands).alias("b")).select("node", "n", "b.keys", "b.need", "b.band").where("size(keys) > 0")
    counts = rows.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("cost")).where("cost > 1")
    shared = written(counts, "shared-signatures")
    sieve = spark.sparkContext.broadcast(_sieve(shared))

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            keys = lists.flatten().to_numpy(zero_copy_only=False)
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)
            hit = _in(sieve.value, keys)
            row, keys = row[hit], keys[hit]
            need, n = batch.column(3).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            node, band = batch.column(0).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False)
            columns = [pa.array(x[row]) for x in (node, n, band)] + [pa.array(keys), pa.array(size[row]), pa.array(need[row])]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "band", "key", "held", "need"])

    hits = rows.select("node", "n", "keys", "need", "band").mapInArrow(run, "node long, n long, band int, key long, held long, need int")
    costed = hits.join(shared, "key")
    each = costed.groupBy("node", "n", "band").agg(F.sort_array(F.collect_list(F.struct("cost", "key"))).alias("got"), F.first("held").alias("held"), F.first("need").alias("need"))
    take = F.when(F.col("need") < 0, F.size("got")).otherwise(F.col("need") - (F.col("held") - F.size("got"))).cast("int")
    return each.withColumn("take", take).where("take > 0").select("node", "n", F.explode(F.slice("got", F.lit(1), F.col("take"))).alias("s")).select(F.col("s.key").alias("key"), "node", "n")


def _sets(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame) -> DataFrame:
    """node and set (uint64, little endian) of nodes (node, print, k1). Texts are read again; only those asked for are cut."""
    asked = _few(nodes.select("print").distinct())
    texts = docs.select(row_print(id_col, text_col).alias("print"), F.col(f"`{text_col}`").alias("text")).join(asked, "print", "left_semi")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                sets = shingle_sets(pc.fill_null(some.column(1), ""))
                k1 = np.array([_mix(s ^ _U(1)).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(_signed(k1)), pa.array([s.tobytes() for s in sets], pa.binary())], ["print", "k1", "set"])

    cut = texts.mapInArrow(run, f"print {PRINT}, k1 long, set binary")
    found = cut.join(nodes, ["print", "k1"]).select("node", "set")
    return found.groupBy("node").agg(F.first("set").alias("set"))


def _verifier(sets: DataFrame, similar: int):
    def run(batches):
        for batch in batches:
            far, link = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                union = len(x) + len(y) - common
                far.append(1 - common / union)
                link.append(100 * common >= similar * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(link, pa.bool_())], ["a", "b", "far", "link"])

    def verify(pairs: DataFrame) -> DataFrame:
        one = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
        both = one.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
        return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, far double, link boolean")

    return verify


def _grouped(docs: DataFrame, id_col: str, text_col: str, similar: int) -> DataFrame:
    """rid, print, doc_id, n and place (the component, as a node) for each row."""
    bounded_batches(docs.sparkSession)
    described = written(_described(docs, id_col, text_col, similar), "signatures", "lz4")
    facts = described.select("rid", "print", "doc_id", "n", "k1", "k2")
    classes = facts.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(F.struct("rid", "print")).alias("one"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select("k1", "k2", "n", F.col("one.rid").alias("node"), F.col("one.print").alias("print")), "classes")
    rows = facts.join(classes.select("k1", "k2", "n", "node"), ["k1", "k2", "n"], "left").withColumn("node", F.coalesce("node", "rid"))
    rows = written(rows.select("rid", "print", "doc_id", "n", "node"), "nodes")

    copies = _few(rows.where("rid != node").select("rid"))
    chosen = written(_selected(described.join(copies, "rid", "left_anti")), "selected")
    several = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    chosen = written(chosen.join(several, "key", "left_semi"), "candidates")
    asked = written(classes.join(chosen.select("node").distinct(), "node", "left_semi").select("node", "print", "k1"), "asked")
    sets = written(_sets(docs, id_col, text_col, asked), "sets", "lz4")
    facts = described.join(_few(asked.select(F.col("node").alias("rid"))), "rid", "left_semi").select(F.col("rid").alias("node"), "n", "bits")

    def near(a: str, b: str) -> Column:
        sizes = F.lit(100) * F.least(f"{a}_n", f"{b}_n") >= F.lit(similar) * F.greatest(f"{a}_n", f"{b}_n")
        apart = [F.bit_count(F.element_at(f"{a}_bits", k + 1).bitwiseXOR(F.element_at(f"{b}_bits", k + 1))) for k in range(SKETCH_BITS // 64)]
        return sizes & (F.lit(100 + similar) * reduce(lambda x, y: x + y, apart) <= F.lit(100 - similar) * (F.col(f"{a}_n") + F.col(f"{b}_n")))

    place = connected(chosen.select("key", "node"), written(facts, "facts"), near, _verifier(sets, similar))
    return rows.join(place, "node", "left").select("rid", "print", "doc_id", "n", F.coalesce("place", "node").alias("place"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Rows link if 100 * common >= similar * union of their shingle sets; similar is a percentage of at least 50. Null, empty and blank texts have an empty set and link with nothing: component_id is their own doc_id. Repeated rows are equal sets. A null doc_id is passed
    over for component_id; a component of null ids alone has none. An empty table gives an empty result; other columns are ignored. Texts are taken whole.
    """
    rows = written(_grouped(docs, id_col, text_col, similar), "grouped")
    least = rows.where("n > 0").groupBy("place").agg(F.min("doc_id").alias("least"))
    named = rows.where("n > 0").join(least, "place").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    return named.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR) -> DataFrame:
    """The rows of docs, all columns as they are, whatever their names or types, with one of each component: the least doc_id, and of equal ids any one.

    Null, empty and blank texts have no words and stay, each row; rows alike in id and text are one component. A null id stays only where its component has no other. An empty table gives an empty one.
    """
    rows = written(_grouped(docs, id_col, text_col, similar), "grouped").where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "print")
    best = rows.groupBy("place").agg(F.min(order).alias("best"))
    marked = rows.join(best, "place").withColumn("stays", order == F.col("best"))
    prints = written(marked.groupBy("print").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows")), "marks")
    gone, twice = prints.where("NOT stays").select("print"), prints.where("stays AND rows > 1").select("print")
    name = next(x for x in (f"__print{k}" for k in range(len(docs.columns) + 1)) if x not in {c.lower() for c in docs.columns})
    left = docs.withColumn(name, row_print(id_col, text_col)).join(_few(gone.withColumnRenamed("print", name)), name, "left_anti")
    if not twice.isEmpty():  # rows alike in id and text, all of which would stay
        twice = _few(twice.withColumnRenamed("print", name))
        left = left.join(twice, name, "left_anti").unionByName(left.join(twice, name, "left_semi").dropDuplicates([name]))
    return left.drop(name)
