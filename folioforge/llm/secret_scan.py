"""Secret scans with a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must contain, as AND and OR over three-byte strings, letter case folded. The texts of one Arrow batch are a segment
of the index: postings are built for the trigrams that any rule asks for, the queries are answered by intersecting and uniting postings, and only the documents found are
searched with the regular expression. A rule with no mandatory trigram searches all documents. A segment lives where its texts were read: nothing is shuffled, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from re import _constants as ops
from re import _parser as parser

from folioforge.llm.support import bounded_batches

ALL = True


@dataclass(frozen=True)
class Rule:
    """kind; pattern; the group that must have at least `least` characters (0: the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII


#: The base rules, in the order in which kinds are listed, then formats that vendors publish. Where a run's least length can stand in the pattern, it does: runs are as long as they can be, so the matches are the same.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

#: Strings that a stretch of a pattern may spell before it is cut, and members of a class that are spelled out.
SPELLED, MEMBERS = 64, 6


def _both(op: str, parts: list):
    """AND or OR of parts, without what says nothing."""
    flat = []
    for p in parts:
        flat += p[1] if isinstance(p, tuple) and p[0] == op else [p]
    if op == "or" and any(p is ALL for p in flat):
        return ALL
    flat = list(dict.fromkeys(p for p in flat if p is not ALL))
    return ALL if not flat else flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of(text: str):
    raw = text.lower().encode()
    return _both("and", [raw[i : i + 3] for i in range(len(raw) - 2)])


class _Reader:
    """Reads a parsed pattern from left to right. now: the strings that the stretch since the last cut may spell; found: what has been asked for before it."""

    def __init__(self):
        self.now, self.found = {""}, []

    def cut(self) -> None:
        self.found.append(_both("or", [_of(s) for s in sorted(self.now)]))
        self.now = {""}

    def spell(self, strings: set[str]) -> None:
        if len(self.now) * len(strings) > SPELLED:
            self.cut()
        self.now = {a + b for a in self.now for b in strings}

    def read(self, tree) -> None:
        for op, value in tree:
            if op is ops.LITERAL:
                self.spell({chr(value).lower()})
            elif op is ops.IN and (members := _members(value)):
                self.spell(members)
            elif op is ops.SUBPATTERN:
                self.read(value[3])
            elif op is ops.BRANCH and (spelled := [_spelled(x) for x in value[1]]) and all(spelled):
                self.spell(set().union(*spelled))
            elif op is ops.BRANCH:
                self.cut()
                self.found.append(_both("or", [query(x) for x in value[1]]))
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
                low, high, inner = value
                strings = _spelled(inner)
                if strings and (low, high) == (0, 1):
                    self.spell(strings | {""})
                elif strings and 0 < low <= 3:
                    for _ in range(low):
                        self.spell(strings)
                    if high != low:
                        self.cut()
                else:
                    self.cut()
                    if low:
                        self.found.append(query(inner))
            elif op is not ops.AT:
                self.cut()


def _members(items) -> set[str]:
    out: set[str] = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(chr(value).lower())
        elif op is ops.RANGE and value[1] - value[0] < MEMBERS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return set()
    return out if len(out) <= MEMBERS else set()


def _spelled(tree) -> set[str]:
    """All strings that a part may spell, or nothing if there are many."""
    r = _Reader()
    r.read(tree)
    return r.now if not r.found else set()


def query(tree):
    """What each match contains: bytes for a trigram, ('and' | 'or', parts), or ALL."""
    r = _Reader()
    r.read(tree)
    r.cut()
    return _both("and", r.found)


def trigram_query(rule: Rule):
    return query(parser.parse(rule.pattern, rule.flags))


def _trigrams(q) -> set[bytes]:
    return set() if q is ALL else {q} if isinstance(q, bytes) else set().union(*[_trigrams(p) for p in q[1]])


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: Bytes that are looked at together while a segment is indexed.
STEP = 1 << 20


class Index:
    """The rules, their queries and the table of the trigrams that they ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.regex = [re.compile(r.pattern, r.flags) for r in rules]
        self.queries = [trigram_query(r) for r in rules]
        self.grams = sorted(set().union(*[_trigrams(q) for q in self.queries]))
        self.table = np.zeros(1 << 24, dtype=np.uint16)
        for k, g in enumerate(self.grams):
            self.table[int.from_bytes(g, "big")] = k + 1

    def postings(self, data: np.ndarray, ends: np.ndarray) -> dict[bytes, np.ndarray]:
        """data: the texts' bytes one after another; ends: 0 and where each text ends."""
        n, seen = len(ends) - 1, []
        for lo in range(0, max(0, len(data) - 2), STEP):
            b = _FOLD[data[lo : lo + STEP + 2]].astype(np.uint32)
            hit = self.table[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
            at = np.flatnonzero(hit)
            doc = np.searchsorted(ends, at + lo, side="right") - 1
            inside = at + lo + 3 <= ends[doc + 1]
            seen.append(np.unique(hit[at[inside]].astype(np.int64) * n + doc[inside]))
        keys = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        gram = keys // max(n, 1)
        return {g: keys[gram == k + 1] % max(n, 1) for k, g in enumerate(self.grams)}

    def answer(self, q, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if q is ALL:
            return np.arange(n)
        if isinstance(q, bytes):
            return postings[q]
        parts = [self.answer(p, postings, n) for p in q[1]]
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if q[0] == "and" else np.union1d(out, p)
        return out

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its spans: start, number of the rule, end."""
        n = len(texts)
        ends, data = text_buffers(texts)
        postings = self.postings(data, ends)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        for k, (rule, regex) in enumerate(zip(self.rules, self.regex, strict=True)):
            for i in self.answer(self.queries[k], postings, n).tolist():
                for m in regex.finditer(texts[i].as_py()):
                    if not rule.least or len(m[rule.group]) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        return found


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins and the last ends, and all their bytes; texts has no nulls."""
    n = len(texts)
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if n == 0 or offsets is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, wide)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return ends - ends[0], raw


_INDEXES: dict[tuple, Index] = {}


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end of the whole match in code points, end exclusive, ordered by start and then by kind as listed, joined by commas. Matches of one rule don't overlap; spans of different rules may.
    Null text counts as empty; without spans, spans is empty and base_sha256 is that of the empty string. Whole texts are searched, however long. Repeated rows each give their row; an empty table gives an
    empty result; other columns are ignored.
    """
    rules = BASE + more
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        index = _INDEXES.get(rules) or _INDEXES.setdefault(rules, Index(rules))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = pc.fill_null(part.column(1), "")
                found = [sorted(x) for x in index.spans(texts)]
                name = lambda s: f"{rules[s[1]].kind}:{s[0]}:{s[2]}"
                count = lambda k: pa.array([sum(s[1] == k for s in x) for x in found], pa.int64())
                base = [hashlib.sha256(",".join(name(s) for s in x if s[1] < len(BASE)).encode()).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), count(0), count(1), count(2), pa.array(base, pa.string()), pa.array([",".join(map(name, x)) for x in found], pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    bounded_batches(docs.sparkSession)
    schema = f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(f"`{id_col}`", f"`{text_col}`").mapInArrow(run, schema)
