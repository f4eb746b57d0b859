"""Best-fit packing of documents into sequences by vectors of capacities.

A sequence has three capacities: tokens, documents, and attention cost (the sum of its pieces' squared lengths). A piece uses some of each, and its length says how much; so pieces of one length are alike, and what has to be planned is a table of at most
`cap` counts, however many documents there are. Lengths are taken from the longest down. Bins in which as much is left of each capacity are alike, too: a length chooses among those kinds of bins, under every constraint, the one with the least
residual norm or the largest weighted dot product, and fills bins of that kind with as many of its pieces as they hold. What comes of it is a list of steps: the pieces lo to hi - 1 of a length go into the bins from `bin` on, at one offset.

Spark does what grows: texts are encoded and cut where they are read, each piece with its rank among the pieces of its length in its task; counts' prefix sums over tasks make ranks of all, and a join by length and rank with the steps gives every piece its place.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.packing import REMEMBERED, STRETCH, Encoder
from folioforge.llm.support import bounded_batches, few, written

CAP, END, VOCABULARY = 2048, 0, "byte_bpe_50k.json"
#: Rows of the tables of counts (24 bytes each) and of steps (40 bytes) up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 500_000

#: How the vocabulary's pre-tokenizer splits a text. Fixed value: contractions and the order of the alternatives.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Between a character that isn't white space and a space before another such one, a text can always be cut.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def _odd() -> re.Pattern:
    """Characters whose classes Python doesn't share with the tokenizer: numbers that aren't digits, unassigned ones, separators that only Python calls white space. All from 65536 on are counted among them, as one range: others would be looked up one by one."""
    runs = []
    for c in range(1 << 16):
        if 0x1C <= c <= 0x1F or unicodedata.category(chr(c)) in ("No", "Nl", "Cn"):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return re.compile("[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs) + "\\U00010000-\\U0010ffff]")


class BytePieces(Encoder):
    """Ids (uint16, little endian) of texts by a byte-level vocabulary that keeps case and white space. The vocabulary's ids are the order of its merges, so they are ranks for a faster library; words with odd characters and texts with a special token go to the tokenizer itself."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        self.odd, of = _odd(), {x: b for b, x in enumerate(self.letters)}
        ranks = {bytes(of[x] for x in token): k for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        self.quick = tiktoken.Encoding(path, pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bytes:
        return np.array(self.quick.encode_ordinary(text), "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        if not self.odd.search(word):
            return self._plain(word)
        if word not in self.words:
            if len(self.words) >= REMEMBERED // 4:
                self.words.clear()
            self.words[word] = self._slow(word)
        return self.words[word]

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._slow(text)
        out, lo = [], 0
        while lo < len(text):
            cut = _SAFE.search(text, lo + STRETCH) if len(text) - lo > STRETCH else None
            hi = cut.start() if cut else len(text)
            part, lo = text[lo:hi], hi
            if self.odd.search(part):
                starts = [0, *[m.start() for m in _SAFE.finditer(part)], len(part)]
                out += [self._word(part[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
            else:
                out.append(self._plain(part))
        return b"".join(out)


_ENCODERS: dict[str, BytePieces] = {}


def byte_pieces(path: str | None) -> BytePieces:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, BytePieces(path))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END, cap: int = CAP, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part (of the scan), nth (among the pieces of its length in its part) and with_ids the ids (array<int>), for each piece of each row."""
    last = np.array([end], "<u2").tobytes()
    names = ["piece", "start", "length", "ids_crc32", "part", "nth"]

    def run(batches):
        tool, part, seen = byte_pieces(path), TaskContext.get().partitionId(), np.zeros(cap + 1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some, rows, own = batch.slice(lo, 1024), [], []
                at = []
                for i, text in enumerate(some.column(1).to_pylist()):
                    wide = np.frombuffer(tool.ids(text or "") + last, "<u2").astype("<u4")
                    high = (len(wide) - 1) % cap + 1
                    low = k = 0
                    while low < len(wide):
                        size = high - low
                        rows.append((k, low, size, zlib.crc32(wide[low:high]), part, int(seen[size])))
                        at.append(i)
                        seen[size] += 1
                        if with_ids:
                            own.append(wide[low:high].astype(np.int32))
                        low, high, k = high, high + cap, k + 1
                columns = [pa.array(x, pa.int32() if c == "piece" else pa.int64()) for c, x in zip(names, zip(*rows, strict=True), strict=True)] if rows else [pa.array([], pa.int64())] * 6
                if rows:
                    yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(at)), *columns] + [pa.array(own, pa.list_(pa.int32()))] * with_ids, ["doc_id", *names] + ["ids"] * with_ids)

    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, f"doc_id {kind}, piece int, " + ", ".join(f"{c} long" for c in names[1:]) + ", ids array<int>" * with_ids)


def fill(counts: dict[int, int], capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Steps (length, lo, hi, bin, offset) and the number of bins.

    rule: norm takes the kind of bin whose weighted residual, after the piece, is least; dot the one whose weighted dot product with the piece is largest, as a share of its own (1 where the piece fills it). Residuals are shares of the capacities.
    """
    scale = np.sqrt(np.array(weights, float)) / np.array(capacity, float)
    kinds: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # what is left, and runs of bins
    left, steps, bins = np.zeros((0, 3), np.int64), [], 0
    for size in sorted(counts, reverse=True):
        use, rank, many = np.array([size, 1, size * size], np.int64), 0, counts[size]
        if (use > capacity).any():
            raise ValueError(f"a piece of {size} tokens doesn't fit into an empty sequence")
        while rank < many:
            fit = np.flatnonzero((left >= use).all(axis=1))
            if len(fit):
                r, v = left[fit] * scale, use * scale
                k = fit[np.argmin(((r - v) ** 2).sum(axis=1)) if rule == "norm" else np.argmax((r @ v) / (r * r).sum(axis=1))]
                kind = tuple(left[k].tolist())
                first, held = kinds[kind][-1]
            else:
                kind, first, held = capacity, bins, many - rank
            each = min(kind[0] // size, kind[1], kind[2] // (size * size), many - rank)
            n = min(held, (many - rank) // each)
            for _ in range(each):
                steps.append((size, rank, rank + n, first, capacity[0] - kind[0]))
                kind = (kind[0] - size, kind[1] - 1, kind[2] - size * size)
                rank += n
            if len(fit):
                old = tuple(left[k].tolist())
                kinds[old][-1] = (first + n, held - n)
                if n == held:
                    kinds[old].pop()
                    if not kinds[old]:
                        del kinds[old]
                        left = np.delete(left, k, axis=0)
            else:
                bins += n
            if kind[0] > 0 and kind[1] > 0:
                if kind not in kinds:
                    kinds[kind] = []
                    left = np.vstack([left, np.array([kind], np.int64)])
                kinds[kind].append((first, n))
    return steps, bins


def plan(counts: dict[int, int], capacity: tuple[int, int, int]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Of the fillings by either rule, with tokens alone and with each capacity weighed by what is asked of it, the one with the fewest bins."""
    asked = np.array([sum(n * s for s, n in counts.items()), sum(counts.values()), sum(n * s * s for s, n in counts.items())], float) / np.array(capacity, float)
    scarce = tuple((asked / asked.max()).tolist()) if counts else (1.0, 1.0, 1.0)
    tried = [fill(counts, capacity, weights, rule) for weights in ((1.0, 0.0, 0.0), scarce) for rule in ("norm", "dot")]
    return min(tried, key=lambda x: x[1])


def best_fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, cap: int = CAP, most_docs: int | None = None, most_cost: int | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with_ids the ids themselves (array<int>).

    A document is its ids and the end id. Only one of more than cap ids is cut, into pieces of cap; its first piece may be shorter. A sequence has at most cap ids, most_docs pieces and most_cost of attention (sums of squared lengths); where these
    aren't given, they never bind. A null text counts as empty: its document is the end id alone. Repeated rows are documents of their own, null ids are kept, an empty table gives an empty result, and other columns are ignored.
    """
    spark = docs.sparkSession
    capacity = (cap, most_docs or cap, most_cost or cap * cap)
    each = written(pieces(docs, id_col, text_col, path, cap=cap, with_ids=with_ids), "pieces")
    counts = written(each.groupBy("part", "length").agg(F.count(F.lit(1)).alias("many")), "piece-counts")
    every = {r["length"]: r["many"] for r in counts.groupBy("length").agg(F.sum("many").alias("many")).collect()}  # cap rows at most
    steps = written(spark.createDataFrame(plan(every, capacity)[0], "length long, lo long, hi long, bin long, offset long"), "steps")

    before = counts.select("part", "length", (F.sum("many").over(Window.partitionBy("length").orderBy("part")) - F.col("many")).alias("before"))
    ranked = each.join(few(written(before, "ranks"), BROADCAST_ROWS), ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.join(few(steps, BROADCAST_ROWS), (ranked["length"] == steps["length"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return placed.select("doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("bin") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset", *["ids"] * with_ids)
