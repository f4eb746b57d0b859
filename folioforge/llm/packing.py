"""Packing: concatenate all documents' tokens and cut them into windows of one length.

Pass one encodes each document where it is read, writes its ids with the number of ids before it in its partition, and so gives each partition's total. The totals' prefix sums are the
partitions' places in the whole. Pass two reads the ids back: a document's global place is its partition's place plus its own, and every window that it touches gets a piece; those at the edges of a window are its boundary records.
No document is moved between tasks, and only totals (one number for each partition of the scan) are gathered.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.support import bounded_batches, written

WINDOW, END = 4096, 2
VOCABULARY = "word_bpe_49k.json"
#: Partitions of a scan up to which their totals (16 bytes each) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Pieces of text whose ids a worker remembers, and characters encoded together.
REMEMBERED, STRETCH = 400_000, 1 << 20

#: Characters for which lower(), the classes below and NFC surely agree with the tokenizer's own normalisation: ASCII and Latin 1 without white space that only some libraries see, general punctuation, the euro sign.
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7f\xa1-\xff‐-‧€]*")
_LETTER, _NUMBER = r"a-zªµºß-öø-ÿ", r"0-9²³¹¼-¾"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r {_LETTER}{_NUMBER}]+")


def _visible() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: itself if it is printable, else one from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder(dict):
    """Ids (uint16, little endian) of pieces of text, computed when they are first asked for.

    The vocabulary's merges never cross the pieces into which its pre-tokenizer splits a text, and white space is dropped; so a text's ids are its pieces' ids one after another, and a piece that has been seen needs
    no merging again. Texts with characters outside of _PLAIN are split at spaces, and words with such characters go to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than two bytes")
        self.model, self.letters = self.tokenizer.model, _visible()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        shown = piece if piece.isascii() and piece.isprintable() else "".join(self.letters[b] for b in piece.encode())
        ids = self[piece] = np.array([t.id for t in self.model.tokenize(shown)], "<u2").tobytes()
        return ids

    def _slow(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            return b"".join([self[x] for x in _PIECE.findall(word.lower())])
        if word not in self.words:
            if len(self.words) >= REMEMBERED // 4:
                self.words.clear()
            self.words[word] = self._slow(word)
        return self.words[word]

    def ids(self, text: str) -> bytes:
        if "<|" in text and any(s in text for s in self.special):
            return self._slow(text)
        out, lo = [], 0
        while lo < len(text):
            hi = len(text)
            if hi - lo > STRETCH:
                hi = text.find(" ", lo + STRETCH)
                hi = hi if hi > 0 else len(text)
            part, lo = text[lo:hi], hi
            if _PLAIN.fullmatch(part):
                out += [self[x] for x in _PIECE.findall(part.lower())]
            else:
                out += [self._word(w) for w in part.split(" ")]
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END) -> DataFrame:
    """doc_id, part (of the scan), before (ids before it in its part), n and ids (uint16, little endian, with the end id) for each row."""
    last = np.array([end], "<u2").tobytes()

    def run(batches):
        tool, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                ids = [tool.ids(t or "") + last for t in some.column(1).to_pylist()]
                n = np.array([len(x) // 2 for x in ids], np.int64)
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(np.full(len(n), part, np.int64)), pa.array(at), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "part", "before", "n", "ids"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, f"doc_id {kind}, part long, before long, n long, ids binary")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of all sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with_ids the ids themselves (array<int>).

    Sequences 0, 1, ... have `window` ids each but for the last, which is as long as what is left. A null text counts as empty: its document is the end id alone. White space has no ids, so the same holds for a blank text. Repeated rows are
    documents of their own, null ids are kept, an empty table gives an empty result, and other columns are ignored. Order is that of the scan.
    """
    table = written(encoded(docs, id_col, text_col, path), "ids")
    sums = table.groupBy("part").agg(F.sum("n").alias("total"))
    places = written(sums.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("place")), "places")
    few = places.count() <= BROADCAST_ROWS
    placed = table.join(F.broadcast(places) if few else places, "part").select("doc_id", (F.col("place") + F.col("before")).alias("at"), "n", "ids")

    def run(batches):
        for batch in batches:
            ids, starts, sizes, crcs, docs_, totals, seqs, offs, own = batch.column(3), [], [], [], [], [], [], [], []
            for i, (at, n) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                wide = np.frombuffer(ids[i].as_buffer(), "<u2").astype("<u4")
                low = 0
                while low < n:
                    off = (at + low) % window
                    high = min(n, low + window - off)
                    piece = wide[low:high]
                    docs_.append(i), starts.append(low), sizes.append(high - low), totals.append(n), seqs.append((at + low) // window), offs.append(off)
                    crcs.append(zlib.crc32(piece))
                    if with_ids:
                        own.append(piece.astype(np.int32))
                    low = high
            longs = [pa.array(x, pa.int64()) for x in (starts, sizes, crcs, totals, seqs, offs)]
            columns = [batch.column(0).take(pa.array(docs_, pa.int64())), *longs] + ([pa.array(own, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    bounded_batches(docs.sparkSession)
    return placed.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:7]) + (", ids array<int>" if with_ids else ""))
