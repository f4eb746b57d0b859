"""Best fit: against the tokenizer, and plans against their constraints and a packing one by one."""

import random
import zlib

import numpy as np
import pytest
from conftest import SMALL

from folioforge.llm.best_fit import CAP, BytePieces, best_fit, fill, plan


@pytest.fixture(scope="module")
def tool():
    import public_tokenizers

    return BytePieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids(tool):
    rng = random.Random(5)
    parts = ["don't", " 'S", "we'll", "  ", "\n", " \n ", "\t", "\x1c", "\xa0", "\x85", "x", " naïve", "²", " ½", "Ⅷ", "१२", "हिन्दी", " 漢字", "😀", "_a_", "12", " 3", "--", ".\nThe", "<|endoftext|>", " ", "é"]
    texts = ["", " ", "a", "word " * 400_000, *["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(600)]]
    for t in texts:
        assert tool.ids(t) == tool._slow(t), t[:80]


def test_pieces_of_table(spark, tool):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source")
    odd = spark.createDataFrame([(None, "null id", "s"), (900_001, None, "s"), (900_002, "", None), (900_003, "long text " * 9000, "s"), (900_004, "twice", "s"), (900_004, "twice", "s")], docs.schema)
    got = best_fit(docs.union(odd), with_ids=True).collect()
    want = {}
    for r in docs.union(odd).collect():
        ids = [*np.frombuffer(tool._slow(r.text or ""), "<u2").tolist(), 0]
        want.setdefault(r.doc_id, []).append(ids)
    seen, places = {}, {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 and len(r.ids) == r.length
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, every in want.items():
        cut = []
        for ids in every:
            low, k = 0, 0
            while low < len(ids):
                high = low + (((len(ids) - 1) % CAP + 1) if k == 0 else CAP)
                cut.append((k, low, ids[low:high]))
                low, k = high, k + 1
        assert sorted(seen[doc_id]) == sorted(cut)
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1].tolist()] and sum(n for _, n in held) <= CAP
    assert len(places) <= 1.01 * sum(r.length for r in got) / CAP + 1


def check(steps, bins, counts, capacity):
    held, ranks = {}, {s: [] for s in counts}
    for size, lo, hi, first, offset in steps:
        ranks[size] += range(lo, hi)
        for i in range(hi - lo):
            b = held.setdefault(first + i, [0, 0, 0])
            assert b[0] == offset
            b[0], b[1], b[2] = b[0] + size, b[1] + 1, b[2] + size * size
    assert all(sorted(ranks[s]) == list(range(n)) for s, n in counts.items())
    assert sorted(held) == list(range(bins)) and all(x <= c for b in held.values() for x, c in zip(b, capacity, strict=True))


@pytest.mark.parametrize("capacity", [(100, 100, 10_000), (100, 3, 10_000), (100, 100, 2601), (100, 4, 4000)])
@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plans(capacity, rule):
    rng = random.Random(1)
    for _ in range(20):
        counts = {rng.randrange(1, 51): rng.randrange(1, 60) for _ in range(rng.randrange(0, 25))}
        for weights in ((1.0, 0.0, 0.0), (1.0, 0.5, 0.25)):
            steps, bins = fill(counts, capacity, weights, rule)
            check(steps, bins, counts, capacity)


def test_plan_is_best_fit_decreasing():
    """With tokens alone, as few bins as best fit, one piece after another."""
    rng = random.Random(2)
    for _ in range(20):
        counts = {rng.randrange(1, 101): rng.randrange(1, 30) for _ in range(30)}
        left = []
        for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            fit = [x for x in left if x >= s]
            if fit:
                left.remove(min(fit))
            left.append((min(fit) if fit else 100) - s)
        assert fill(counts, (100, 1000, 1 << 30), (1.0, 0.0, 0.0), "norm")[1] == len(left)
        assert plan(counts, (100, 1000, 1 << 30))[1] <= len(left)
    with pytest.raises(ValueError):
        fill({60: 1}, (100, 5, 3000), (1.0, 0.0, 0.0), "norm")


def test_constraints_and_empty(spark):
    docs = spark.createDataFrame([(i, "one two three " * (i % 5), 1) for i in range(200)], "doc_id long, text string, piece int")
    got = best_fit(docs, cap=64, most_docs=3, most_cost=1500).toPandas()
    each = got.assign(cost=got.length**2).groupby("sequence_id").agg({"length": "sum", "cost": "sum", "doc_id": "size"})
    assert each.length.max() <= 64 and each.cost.max() <= 1500 and each.doc_id.max() <= 3 and set(got.doc_id) == set(range(200))
    assert best_fit(docs.limit(0)).count() == 0
