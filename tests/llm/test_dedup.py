"""Exact, near-duplicate and line dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm.components import components
from folioforge.llm.exact_dedup import BLOCK_BYTES, label_duplicates
from folioforge.llm.line_dedup import EDITED, by_pieces, dedup_lines
from folioforge.llm.ngram_join import near_duplicates, shingle_sets, without_near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, rid string, key int, n int, node int"


def frame(spark, rows):
    """Rows of doc_id and text, with other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", "x", 1, 2, 3) for i, t in rows], SCHEMA)


def grouped(n, links):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in links:
        top[find(a)] = find(b)
    return [find(x) for x in range(n)]


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)]
    got = {r["node"]: r["place"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    at = {x: k for k, x in enumerate(ids)}
    want = grouped(len(ids), [(at[a], at[b]) for a, b in edges if a != b])
    assert set(got) == set(ids)
    assert all((got[a] == got[b]) == (want[at[a]] == want[at[b]]) for a, b in zip(ids, ids[1:] + ids[:1], strict=True))
    assert len(set(got.values())) == len(set(want))


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(spark, bits):
    long = "wörd and " * (BLOCK_BYTES // 2)
    texts = [None, "", " ", "a  b", "a b", "a\tb", "a b ", long, long + "x", long.replace(" ", "\n\n"), "b a", "x" * BLOCK_BYTES, "x" * (BLOCK_BYTES * 3), "x" * (BLOCK_BYTES * 3), "x" * (BLOCK_BYTES * 4)]
    rows = list(enumerate(texts)) + [(4, "a b"), (None, "a b"), (None, "only null"), (None, "only null")]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    ids = defaultdict(list)
    for i, t in rows:
        ids[norm(t)].append(i)
    got = label_duplicates(frame(spark, rows), key_bits=bits).collect()
    assert len(got) == len(rows)
    least = lambda t: min((i for i in ids[norm(t)] if i is not None), default=None)
    want = sorted(str((i, least(t), len(ids[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest())) for i, t in rows)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    kept = defaultdict(int)
    for r in got:
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}


def test_exact_dedup_of_nothing(spark):
    assert label_duplicates(frame(spark, [])).count() == 0


def words_of(text):
    return [w.decode(errors="replace") for w in re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def varied(rng):
    """Texts of all small sizes, in groups at all distances, some around one common passage."""
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 6)))
    passage = [word() for _ in range(25)]
    out = []
    for _ in range(45):
        base = [word() for _ in range(rng.choice([1, 2, 4, 5, 6, 7, 8, 9, 12, 16, 20, 30, 45, 70, 150]))]
        if rng.random() < 0.3:
            base = base + passage
        out.append(base)
        for _ in range(rng.randrange(0, 8)):
            new = list(out[-1] if rng.random() < 0.4 else base)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(new) + 1)
                what = rng.random()
                if what < 0.4:
                    new.insert(at, word())
                elif what < 0.7 and len(new) > 1:
                    new.pop(min(at, len(new) - 1))
                elif new:
                    new[min(at, len(new) - 1)] = word()
            out.append(new)
    return [" ".join(w.upper() if rng.random() < 0.1 else w for w in t).replace(" ", "\n", 1) for t in out]


def near_brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, grouped(len(rows), links)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    rng = random.Random(seed)
    texts = varied(rng) + [None, "", "  ", "one", "ONE", "one two"]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (3, texts[5])]
    sets, places = near_brute(rows)
    least = {}
    for (i, _), p in zip(rows, places, strict=True):
        least[p] = min((x for x in (least.get(p), i) if x is not None), default=None)
    want = sorted(str((i, len(s), least[p] if s else i)) for (i, _), s, p in zip(rows, sets, places, strict=True))
    df = frame(spark, rows).repartition(3)
    assert sorted(str(tuple(r)) for r in near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()) == want
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    assert kept.count() == len({p for s, p in zip(sets, places, strict=True) if s}) + sum(not s for s in sets)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_one_hot_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(base[: 60 + i % 3] + [f"x{i}"] + base[60 + i % 3 :])) for i in range(200)] + [(500 + i, " ".join(base[:40] + [f"y{i}-{k}" for k in range(80)])) for i in range(60)]
    sets, places = near_brute(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows)).collect()}
    assert len(set(got.values())) == len(set(places)) == 61


def test_shingles_have_sizes_of_the_definition():
    texts = ["", "a", "A  a", "a b c d", "a b c d e", "a b c d e a b c d e a", "ß" * 50 + "\x0b" + "ü é", "x " * 3000]
    got = shingle_sets(pa.array(texts))
    assert [len(x) for x in got] == [len(shingles(t)) for t in texts]
    assert all((np.diff(x.astype(object)) > 0).all() for x in got)


def edits(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def normal(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def line_brute(rows):
    """Texts that are left when lines are similar by edit distance alone, and the number of similar pairs."""
    where = defaultdict(list)
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            if normal(line):
                where[normal(line)].append((i, k))
    lines = list(where)
    most = lambda a, b: int(max(len(lines[a]), len(lines[b])) * EDITED)
    links = [(a, b) for a, b in combinations(range(len(lines)), 2) if abs(len(lines[a]) - len(lines[b])) <= most(a, b) and edits(lines[a], lines[b]) <= most(a, b)]
    places = grouped(len(lines), links)
    gone = set()
    for p in set(places):
        spots = sorted((s for k, x in enumerate(lines) if places[k] == p for s in where[x]), key=lambda s: (s[0] is None, s[0] or 0, s[1]))
        gone |= set(spots[1:])
    out = {}
    for i, t in set(rows):
        left = "\n".join(x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone) if t is not None else None
        if not any(s[0] == i for s in gone) or left.strip():
            out[i] = left
    return out, len(links)


@pytest.mark.parametrize("every", [False, True])
def test_line_dedup(spark, every):
    rng = random.Random(5)
    words = [f"word{k}" for k in range(200)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    pool = [line(rng.randrange(3, 60)) for _ in range(40)]
    pool += [x.replace("word1", "word9", 1) for x in pool[:25]] + [x.upper() + "." for x in pool[:10]] + [" ".join(pool * 3)]
    rows = [(i, "\n".join(rng.choice([*pool, "", "end", line(12)]) for _ in range(6))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, pool[0]), (None, pool[1] + "\nnew line stands here"), (0, rows[0][1])]
    want, links = line_brute(rows)
    got = dedup_lines(frame(spark, rows).repartition(3), every=every)
    assert links > 5
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert got.columns == [*SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", "), "lines", "kept_lines"]


def reworded(rng, line, share):
    """line with words replaced, about so much of its characters."""
    words, left = line.split(" "), int(len(line) * share)
    for _ in range(20):
        k = rng.randrange(len(words))
        if len(words[k]) <= left:
            left -= len(words[k])
            words[k] = "".join(rng.choice("abcdeinorst") for _ in words[k])
    return " ".join(words)


def scattered(rng, line, share):
    """line with so much of its characters changed, removed or added, anywhere."""
    new = list(line)
    for _ in range(int(len(line) * share)):
        k, what = rng.randrange(len(new)), rng.random()
        new[k : k + (what < 0.7)] = [] if what < 0.35 else [rng.choice("abcdeinorst")]
    return normal("".join(new))


def test_recall_of_lines_within_the_edits(spark):
    """Pairs of lines, one each edited from the other, against edit distance alone: nothing of what finds candidates is in the definition."""
    rng = random.Random(8)
    text = open(__file__, encoding="utf-8").read()
    vocabulary = sorted({w.lower() for w in re.findall(r"[A-Za-z_]{2,}", text)})
    found = {}
    for name, change, shares in (("words", reworded, (0.02, 0.05, 0.09)), ("scattered", scattered, (0.01, 0.02, 0.04))):
        pairs = []
        for k in range(300):
            one = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 9, 15, 30, 60, 120])))
            two = change(rng, one, shares[k % 3])
            if one != two and edits(one, two) <= int(max(len(one), len(two)) * EDITED):
                pairs.append((one, two))
        rows = [(2 * k + j, x) for k, pair in enumerate(pairs) for j, x in enumerate(pair)]
        stay = {r["doc_id"] for r in dedup_lines(frame(spark, rows).repartition(3)).collect()}
        assert len(pairs) > 200 and {2 * k for k in range(len(pairs))} <= stay
        found[name] = 1 - len([x for x in stay if x % 2]) / len(pairs)
    assert found["words"] >= 0.98 and found["scattered"] >= 0.9, found


def test_recall_on_the_table(spark):
    """Lines that go by default against those that go when all lines are joined by pieces, which is exact."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    left = lambda every: dedup_lines(docs, every=every).selectExpr("sum(kept_lines)").first()[0]
    lines = docs.selectExpr("sum(size(split(text, '\n')))").first()[0]
    fuzzy, exact = left(False), left(True)
    assert exact <= fuzzy and lines - fuzzy >= 0.9 * (lines - exact)


def test_line_dedup_keeps_columns_of_any_name(spark):
    schema = "doc_id long, text string, `a.b` int, __print int, p int, q int, gone int, row int, `left` int, new int, lines int, `key` int, __0 int"
    line = "one line that two of the documents have in common"
    rows = [(1, line, *range(11)), (2, line + "\nbut not this one here", *range(11, 22)), (2, line + "\nbut not this one here", *range(11, 22)), (None, None, *range(11))]
    got = dedup_lines(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["a.b"], r["__print"], r["p"], r["gone"], r["left"], r["key"], r["__0"], r["lines"], r["kept_lines"]) for r in got if r["doc_id"]) == [
        (1, line, 0, 1, 2, 4, 6, 9, 10, 1, 1), (2, "but not this one here", 11, 12, 13, 15, 17, 20, 21, 2, 1)]
    assert len(got) == 3


def test_lines_ruled_by_one_word(spark):
    """Rows of a table, half of whose tokens are bars."""
    rng = random.Random(4)
    name = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    lines = [" | ".join(name() for _ in range(rng.randrange(8, 14))) for _ in range(40)]
    lines += [x[:-1] + "!" for x in lines[::5]] + [x.replace(" | ", " | ", 1)[1:] for x in lines[::7]] + [lines[0][:40] + name() + lines[0][44:]]
    rows = [(i, x) for i, x in enumerate(lines)]
    want, links = line_brute(rows)
    assert links
    got = dedup_lines(frame(spark, rows).repartition(3))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want


def test_line_dedup_of_nothing(spark):
    assert dedup_lines(frame(spark, [])).count() == 0


def edits_brute(texts):
    """Numbers of the one-line texts that stay when lines within the edits allowed are similar, by edit distance alone."""
    stay, links = line_brute(list(enumerate(texts)))
    return set(stay), links


def test_every_line_within_the_edits(spark):
    """Edits of all kinds, at and around the number allowed, spread over lines of all small lengths; most are beyond the bits of the SimHash."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    texts = []
    for size in [3, 3, 4, 4, 5, 6, 8, 10, 13, 16, 20, 25, 30, 40, 60]:
        base = " ".join(word() for _ in range(size))
        texts.append(base)
        for more in (-1, 0, 0, 0, 1):
            new = list(base)
            for _ in range(max(1, int(len(base) * EDITED) + more)):
                k, what = rng.randrange(len(new)), rng.random()
                new[k : k + (what < 0.7)] = [] if what < 0.35 else [rng.choice("xyz")]
            texts.append("".join(new))
    rng.shuffle(texts)
    texts = [re.sub(" +", " ", x) for x in texts]
    stay, links = edits_brute(texts)
    assert links > 30
    got = {r["doc_id"] for r in dedup_lines(frame(spark, list(enumerate(texts))).repartition(3), every=True).collect()}
    assert got == stay


def test_query_misses_no_line_changed_all_over(spark, tmp_path):
    """Lines of which 5 to 9 % of the characters are changed all over have hardly three words in a row in common."""
    from folioforge.llm.queries import op2_line_dedup

    rng, texts = random.Random(4), []
    for share in (5, 6, 7, 8, 9):
        for _ in range(6):
            base = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(24))
            new = list(base)
            for k in rng.sample([k for k, c in enumerate(base) if c != " "], len(base) * share // 100):
                new[k] = "z"
            texts += [base, "".join(new)]
    frame(spark, list(enumerate(texts))).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r["doc_id"] for r in op2_line_dedup(spark, str(tmp_path)).collect()) == list(range(0, len(texts), 2))


def test_pieces_in_common_by_accident(spark):
    """Lines that have one piece in common, and nothing around it, need not be compared; those within the edits are."""
    rng, lines = random.Random(6), []
    for size in (29, 47, 99, 250, 1200):
        made = ["".join(rng.choice("abcdefghijklmnop é😀") for _ in range(size - 9)) for _ in range(6)]
        lines += ["nine char" + x for x in made]
        for x in made[:2]:
            new = list("nine char" + x)
            for k in range(9, 9 + 10 * (size // 10 - 1), 10):
                new[k] = "Z"
            lines.append("".join(new))
    rows = [(k, k, len(x), x) for k, x in enumerate(lines)]
    got = {frozenset(r) for r in by_pieces(spark.createDataFrame(rows, "node long, place long, n int, said string"), EDITED).collect()}
    assert got == {frozenset((k, k - 6)) for k in range(len(lines)) if k % 8 >= 6}


def test_rounds_and_tasks_of_the_join_follow_the_pieces(spark, monkeypatch):
    """Lines are read again in each round: few lines are joined in one, many in as many as are needed, and no task gets far more pieces than it can hold."""
    from folioforge.llm import line_dedup

    rng, rounds = random.Random(9), []
    lines = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(50, 420))) for _ in range(300)]
    lines += [x[:10] + "Z" + x[12:] for x in lines[:5]]
    rows = spark.createDataFrame([(k, k, len(x), x) for k, x in enumerate(lines)], "node long, place long, n int, said string").localCheckpoint()
    real = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name, **options: rounds.append(name) or real(df, name, **options))
    pairs = lambda: {frozenset(r) for r in by_pieces(rows, EDITED).collect()}
    want = {frozenset((k, 300 + k)) for k in range(5)}
    assert pairs() == want and len([x for x in rounds if x.startswith("pieces")]) == 1
    rounds.clear()
    monkeypatch.setattr(line_dedup, "ROUND_PIECES", 5000)
    monkeypatch.setattr(line_dedup, "TASK_PIECES", 300)
    assert pairs() == want and len([x for x in rounds if x.startswith("pieces")]) > 2


def test_thousands_of_rows_alike(spark):
    """Their bits must not add up in the same fields of a sum."""
    line = " ".join(f"word{k}" for k in range(20))
    rows = [(None, line)] * 3500 + [(1, line + "\nand another line here")]
    got = dedup_lines(frame(spark, rows).repartition(3)).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(1, line + "\nand another line here")]


def test_query_takes_lines_of_few_words(spark, tmp_path):
    from folioforge.llm.queries import op2_line_dedup

    rows = [(1, "end\n\nlong" + "x" * 50), (2, "end\n\nlong" + "x" * 50 + "\ntwo words"), (3, "two words\nENDE\n\nEND"), (4, "ende\n ")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["text"] for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: rows[0][1], 2: "\ntwo words", 3: "ENDE\n"}
