"""Mixes, shards and near-duplicate vectors; the pipeline."""

import importlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioforge.llm.embedding_dedup import near_embeddings
from folioforge.llm.mixing import PASSES, SHARDS, SHARE, WEIGHTS, drawn, measured, mix_accounts, mixed_documents, mixture, permuted, targets
from folioforge.llm.sharding import shuffled_shards

DOCS = "doc_id long, text string, source string, sid int, slot int, size string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "x", len(t or "")) for i, t, s in rows], DOCS)


def documents(seed=1):
    rng = random.Random(seed)
    names = ["b", "a", None, "", "é", "z", "c"]
    rows = [(i, " ".join(f"w{i}.{k}" for k in range(rng.choice([0, 1, 3, 10, 200, 700]))), rng.choice(names + ["b"] * 6)) for i in range(250)]
    return rows + [(1000, None, "a"), (1001, "", "tiny"), (1002, "one two", "small"), (None, "null id here", "a"), (None, "null id here", "a")] + [(7, rows[7][1], rows[7][2])] * 3


def waterfill(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, out, free = SHARE * sum(sizes.values()), {}, set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > PASSES * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = float(PASSES * sizes[s])
            left -= out[s]
        free -= over
    return out


def test_targets(spark):
    rows = documents()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    got = {r["source"]: r["target"] for r in targets(measured(frame(spark, rows))).collect()}
    want = waterfill(dict(sizes))
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = documents()
    df = frame(spark, rows)
    got = mix_accounts(df).toPandas()
    assert len(got) == len(rows)
    assert Counter((None if np.isnan(i) else int(i), int(n)) for i, n in zip(got["doc_id"], got["size"], strict=True)) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    assert (got["taken"] <= 2 * got["size"]).all()
    for (size, target), g in got.groupby(["source_size", "target"]):
        assert abs(g["taken"].sum() - target) <= 65, (size, target)
    again = mix_accounts(df.repartition(3)).toPandas()
    key = ["doc_id", "size", "source_size", "taken"]
    assert got.sort_values(key)[key].reset_index(drop=True).equals(again.sort_values(key)[key].reset_index(drop=True))


def test_mixed_documents_have_the_words_taken(spark):
    df = frame(spark, documents()).where("doc_id IS NULL OR doc_id != 7")
    got = mixed_documents(df, df.columns, block_words=64).toPandas()
    assert list(got.columns) == df.columns and (got["n_chars"] == got["text"].str.len()).all()
    want = mix_accounts(df, block_words=64).toPandas()
    assert sum(len(t.split()) for t in got["text"]) == want["taken"].sum()
    full = {r["doc_id"]: (r["text"] or "").split() for r in df.collect()}
    for r in got.itertuples():
        key = None if np.isnan(r.doc_id) else int(r.doc_id)
        it = iter(full[key])
        assert all(w in it for w in r.text.split())


def test_counts_of_shards_are_multinomial(spark):
    """Ends rise to the number of slots, counts vary as binomial ones do, and each slot of a mix is in the shard that the draw gave it to."""
    numbers = [0, 1, 2, 63, 64, 65, 1000] + [16_000] * 60
    got = {r["sid"]: list(r["ends"]) for r in drawn(spark.createDataFrame(list(enumerate(numbers)), "sid long, slots long")).collect()}
    assert all(len(got[k]) == SHARDS and got[k][-1] == n and sorted(got[k]) == got[k] for k, n in enumerate(numbers))
    counts = np.array([np.diff([0, *got[k]]) for k in range(7, len(numbers))])
    want = 16_000 * (1 / SHARDS) * (1 - 1 / SHARDS)
    assert abs(counts.mean(0) - 16_000 / SHARDS).max() < 5 * (want / 60) ** 0.5 and 0.8 * want < counts.var() < 1.2 * want
    df = frame(spark, documents())
    sizes = measured(df).cache()
    aims = targets(sizes).cache()
    slots = {}
    for r in mixture(sizes, aims, block_words=16).select("sid", "slot", "shard").distinct().collect():
        slots.setdefault(r["sid"], {})[r["slot"]] = r["shard"]
    totals = [(sid, max(x) + 1) for sid, x in slots.items()]
    ends = {r["sid"]: list(r["ends"]) for r in drawn(spark.createDataFrame(totals, "sid int, slots long"), seed=8).collect()}
    assert len(totals) > 5 and all(x[j] == sum(e <= j for e in ends[sid]) for sid, x in slots.items() for j in x)
    accounts = mix_accounts(df).collect()
    assert all(sum(r["shard_words"]) == r["taken"] for r in accounts) and len({k for r in accounts for k, n in enumerate(r["shard_words"]) if n}) == SHARDS


def test_mix_keeps_columns_of_any_name(spark):
    schema = "doc_id long, text string, source string, n_chars long, `a.b` int, __print int, p int, q int, size int, sid int, copy int, row int, `new` int, __0 int"
    rows = [(1, "some words here", "a", 15, *range(10)), (2, "other words there, too", None, 22, *range(10, 20)), (3, None, "a", None, *range(10)), (4, " ", "a", 1, *range(10)), (2, "other words there, too", None, 22, *range(10, 20))]
    df = spark.createDataFrame(rows, schema)
    got = mixed_documents(df, df.columns)
    assert got.columns == df.columns
    assert {(r["doc_id"], r["a.b"], r["__print"], r["q"], r["copy"], r["new"], r["__0"]) for r in got.collect()} <= {(1, 0, 1, 3, 6, 8, 9), (2, 10, 11, 13, 16, 18, 19)}
    assert got.count() >= 2 and mixed_documents(df.limit(0), df.columns).count() == 0


def test_empty_mix(spark):
    assert mix_accounts(frame(spark, [])).count() == 0
    assert mix_accounts(frame(spark, [(1, None, "a"), (2, " ", None)])).agg(F.sum("taken"), F.count("*")).first()[:] == (0, 2)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 64, 65, 1000, 5003])
def test_permutations(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5), F.lit(n))).collect()]
    assert sorted(got) == list(range(n))
    assert n < 10 or got != list(range(n))


def test_shards(spark):
    rows = [(i, t, s) for i, t, s in documents()] + [(5000, "long " * 50_000, "a")]
    df = frame(spark, rows).repartition(3).cache()
    got = shuffled_shards(df, shards=7, seed=3, bucket_bytes=3000).collect()
    key = lambda r: str((r["doc_id"], zlib.crc32((r["text"] or "").encode()), r["text"] is None, r["source"], r["size"], r["sid"]))
    assert Counter(map(key, got)) == Counter(map(key, df.collect()))
    held = defaultdict(list)
    for r in got:
        held[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in held.values())
    assert set(held) == set(range(7)) and max(map(len, held.values())) - min(map(len, held.values())) <= 1
    place = lambda rows: sorted((key(r), r["shard"], r["slot"]) for r in rows)
    assert place(shuffled_shards(df, shards=7, seed=3, bucket_bytes=3000).collect()) == place(got)
    assert place(shuffled_shards(df, shards=7, seed=4, bucket_bytes=3000).collect()) != place(got)


def test_few_rows_and_none_in_shards(spark):
    assert sorted(r["shard"] for r in shuffled_shards(frame(spark, [(1, None, None), (2, "a", "b")]), shards=16).collect()) == [7, 15]
    assert shuffled_shards(frame(spark, [])).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, node int, first int"


def vectors(rng, d):
    out, base = [], rng.normal(size=(6, d))
    for i in range(160):
        v = base[rng.integers(6)] + rng.normal(size=d) * rng.choice([0.05, 0.2, 0.3, 1.0])
        out.append((i, [float(x) for x in np.float32(v * rng.choice([1, 3]))], int(rng.integers(3))))
    return out


@pytest.mark.parametrize(("d", "tile"), [(64, 2048), (64, 20), (5, 20), (1, 7)])
def test_near_embeddings(spark, d, tile):
    rng = np.random.default_rng(d + tile)
    rows = vectors(rng, d)
    rows += [(200 + i, rows[3][1], rows[3][2]) for i in range(30)] + [(3, rows[3][1], rows[3][2]), (None, rows[5][1], rows[5][2])]
    odd = [(300, None, 1), (301, [], 1), (302, [0.0] * d, 1), (303, [float("nan")] * d, 1), (304, [None] * d, 1), (305, [float("inf")] * d, 1), (306, rows[0][1], None), (307, [1.0] * (d + 1), 1)]
    got = near_embeddings(spark.createDataFrame([(*r, 1, 2) for r in rows + odd], VECTORS).repartition(3), tile=tile).collect()
    x = np.array([r[1] for r in rows])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = u @ u.T
    n = len(rows)
    linked = [(a, b) for a, b in combinations(range(n), 2) if rows[a][2] == rows[b][2] and cos[a, b] >= 0.93]
    count, top = Counter(), list(range(n))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in linked:
        count[a] += 1
        count[b] += 1
        top[find(a)] = find(b)
    least = {}
    for k in range(n):
        least[find(k)] = min((i for i in (least.get(find(k)), rows[k][0]) if i is not None), default=None)
    want = [(rows[k][0], count[k], least[find(k)], rows[k][0] == least[find(k)]) for k in range(n)] + [(i, 0, i, True) for i, _, _ in odd]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_numbers_that_are_still_outside_walk_on(spark):
    n = 5003  # 71 cells by 71, of which 38 are outside
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5), walk_steps=1)).collect()]
    assert got == [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))).collect()] and sorted(got) == list(range(n))


def test_vectors_of_very_large_and_small_doubles(spark):
    large, small, least = 1e200, 1e-200, 5e-324
    rows = [(1, [large, 0.0]), (2, [large, 1e190]), (3, [small, 0.0]), (4, [2 * small, 0.0]), (5, [1.0, 0.0]), (6, [0.0, large]), (7, [0.0, least]), (8, [1.7e308, 1.7e308]), (9, [0.0, 0.0]), (10, [large, float("nan")]), (11, [large, None])]
    got = near_embeddings(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (1, 6), 7: (1, 6), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (0, 11)}


def test_no_vectors(spark):
    assert near_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
    assert near_embeddings(spark.createDataFrame([(1, None, 1, 1, 1)], VECTORS)).collect()[0][:] == (1, 0, 1, True)


def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    now = docs
    for name, stage in pipeline.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns, name
        assert 0 < now.count()
        now = spark.createDataFrame(now.toArrow())
    assert pipeline.run(spark, SMALL).count() > 0


def test_stages_of_the_pipeline_on_odd_rows(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    extra = "`a.b` int, print int, __print0 int, p int, size int, m map<string,int>"
    read = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(40).collect()
    most = max(r["doc_id"] for r in read)
    good = next(r for r in read if r["lang"] == "en" and len(r["text"].split()) > 40 and not any(r["text"] == o["text"] for o in read if o is not r))
    rng = random.Random(3)
    words = [w for w in good["text"].split() if w.isalpha()]
    long_ = "\n".join(" ".join(rng.choices(words, k=200)) for _ in range(40))
    odd = [(None, " ".join(reversed(words)), "en", None, 1), (most + 1, None, None, None, None), (most + 2, "", "en", "x", 0), (most + 3, long_, "en", "x", len(long_))] + [tuple(good)] * 3
    rows = [(*r, 1, 2, 3, 4, 5, {"k": 6}) for r in [*map(tuple, read), *odd]]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(3)
    now, before = docs, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SMALL).toArrow())
        got = now.collect()
        assert now.columns == docs.columns and got, name
        assert all((r["a.b"], r["print"], r["__print0"], r["p"], r["size"], r["m"]) == (1, 2, 3, 4, 5, {"k": 6}) for r in got), name
        ids = Counter(r["doc_id"] for r in got)
        if name == "language_id":
            assert not {most + 1, most + 2} & set(ids) and all((r["text"] or "").strip() for r in got) and ids[None] == 1 and ids[most + 3] == 1 and ids[good["doc_id"]] == 4
        elif name == "line_dedup":
            assert ids[None] == ids[most + 3] == 1 and all(r["n_chars"] == len(r["text"]) for r in got)
        elif name == "ngram_jaccard_join":
            words = Counter(" ".join(r["text"].split()).lower() for r in got if r["text"].split())
            assert set(words.values()) == {1} and len(got) <= before
        else:
            assert set(ids.values()) <= {1, 2}
        before = len(got)
    assert pipeline.STAGES[-1][1](spark, now, SMALL).count() > 0


def test_stages_of_the_pipeline_on_an_empty_table(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0, name


def test_shards_of_columns_without_order(spark):
    docs = spark.createDataFrame([(i, "text", {"a": i}) for i in range(40)], "doc_id long, text string, extra map<string,int>").withColumn("v", F.parse_json(F.lit("1")))
    got = shuffled_shards(docs, shards=4).collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and all(r.extra == {"a": r.doc_id} for r in got)
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(4) for k in range(10)]
