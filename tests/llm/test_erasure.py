"""Erasure: keys against the order of rows, and all files against a brute force."""

import datetime
import decimal
import hashlib
import math
import random
import uuid
import zlib
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioforge.llm.erasure import as_row, erase_masters, keyed, memcomparable, radix_levels, sorted_files, walked
from folioforge.llm.queries import table
from folioforge.llm.support import shared_folder

TABLES = {"clients": (0, 1, 9), "clicks": (3, 3, 5), "sales": (1, 1, 3), "sale_lines": (None, 0, 5)}


def test_keys():
    rng = random.Random(1)
    strings = [None, "", "\0", "\0\0", "a", "a\0", "a\0b", "ab", "é", "😀", "zz"]
    doubles = [None, float("-inf"), -2.5, -0.0, 0.0, 1e-300, 3.0, float("inf"), float("nan")]
    longs = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    days = [None, datetime.date(1969, 1, 1), datetime.date(2024, 2, 29)]
    times = [None, datetime.datetime(1950, 1, 1), datetime.datetime(2024, 1, 1, 0, 0, 0, 5)]
    sums = [None, decimal.Decimal("-12345678901234567890.12"), decimal.Decimal("0.01"), decimal.Decimal("99999999999999999999.99")]
    flags = [None, False, True]
    rows = [tuple(rng.choice(x) for x in (strings, doubles, longs, days, times, sums, flags, strings)) for _ in range(1500)]
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.date32(), pa.timestamp("us"), pa.decimal128(30, 2), pa.bool_(), pa.binary()]
    cols = [pa.array([x.encode() if k == pa.binary() and x is not None else x for x in c], k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    keys = memcomparable(cols).to_pylist()
    rank = lambda x: (0,) if x is None else (2,) if x != x else (1, x.encode() if isinstance(x, str) else x)
    want = [tuple(map(rank, r)) for r in rows]
    for _ in range(20_000):
        i, j = rng.randrange(len(rows)), rng.randrange(len(rows))
        assert (keys[i] < keys[j]) == (want[i] < want[j]) and (keys[i] == keys[j]) == (want[i] == want[j])
        assert keys[i] == keys[j] or not keys[j].startswith(keys[i])


@pytest.mark.parametrize("most", [40])
def test_ranks(spark, most):
    """A hot lead, long common prefixes and equal rows: buckets' first ranks are those of a sort."""
    rng = random.Random(2)
    rows = [("hot" if i % 3 else str(rng.randrange(40)), "same beginning " + rng.choice("abc"), rng.randrange(3), rng.choice([None, 7, 2**40 + i % 5])) for i in range(600)]
    df = spark.createDataFrame(rows, "lead string, text string, key int, first long")
    path = f"{shared_folder(spark)}/keys-{uuid.uuid4().hex}"
    keyed(df.select(as_row(df), "lead")).write.parquet(path)
    one = spark.read.parquet(path).select("key", F.lit(0).cast("long").alias("base"))
    keys = one.union(one.withColumn("base", F.lit(600).cast("long")).where(F.rand(1) < 0.5)).union(one.withColumn("base", F.lit(10_000).cast("long")).limit(0))
    keys.write.parquet(path + "-two")
    keys = spark.read.parquet(path + "-two")
    n = keys.where("base > 0").count()
    got = walked(keys, radix_levels(keys, [(600, most), (n, 2 * most), (0, 5)])).collect()
    order = sorted((r.base, bytes(r.key)) for r in got)
    starts = {}
    for r in got:
        assert r.parent is None and r.size <= 2 * most * (1 + (r.base > 0))
        starts.setdefault((r.first, r.size), []).append((r.base, bytes(r.key)))
    for (first, size), held in starts.items():
        assert sorted(held) == order[first : first + size]


def brute(rows, names, every=100, files=150):
    owner = {}
    for r in rows["sales"]:
        if r[0] is not None:
            owner[r[0]] = min((x for x in (owner.get(r[0]), r[1]) if x is not None), default=None)
    clicks = {}
    for r in rows["clicks"]:
        clicks[r[3]] = clicks.get(r[3], 0) + 1
    sums = {}
    for m, c in {(r[1], r[0]) for r in rows["clients"] if r[1] is not None}:
        sums[m] = sums.get(m, 0) + (clicks.get(c, 0) if c is not None else 0)
    masters = {m for m in sums if zlib.crc32(str(m).encode()) % every == 0} | ({min(sums, key=lambda m: (-sums[m], m))} if sums else set())
    gone = {r[0] for r in rows["clients"] if r[1] in masters} - {None}
    victims = {"clients": masters, "clicks": gone, "sales": gone, "sale_lines": {r[0] for r in rows["sales"] if r[1] in gone} - {None}}
    text = lambda v: "" if v is None else str(v)
    out = {}
    for name, (lead, victim, amount) in TABLES.items():
        of = (lambda r: owner.get(r[0])) if lead is None else (lambda r, k=lead: r[k])
        order = sorted(rows[name], key=lambda r: (zlib.crc32(text(of(r)).encode()), *[(0,) if v is None else (1, v.encode() if isinstance(v, str) else v) for v in r]))  # noqa: B023
        per = 1 + len(order) // files
        for k in range(0, len(order), per):
            held = order[k : k + per]
            left = [r for r in held if r[victim] not in victims[name]]
            if left:
                cents = sum(math.floor(100 * r[amount] + 0.5) for r in left if r[amount] is not None)
                out[name, k // per] = (len(left), len(held) - len(left), cents, len(left) < len(held), hashlib.sha256(",".join(text(r[0]) for r in left).encode()).hexdigest(), ",".join(names[name])), left
    return out


def compare(spark, frames, **options):
    rows = {n: [tuple(r) for r in df.collect()] for n, df in frames.items()}
    want = brute(rows, {n: df.columns for n, df in frames.items()}, **options)
    got = erase_masters(*frames.values(), **options).collect()
    assert {(r.table_name, r.file_no) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        facts, left = want[r.table_name, r.file_no]
        assert (r.n_rows, r.n_erased, r.cents, r.rewritten, r.ids_sha256, r.columns) == facts
        path = unquote(urlparse(r.path).path)
        assert [tuple(x.values()) for x in pq.ParquetFile(path).read().to_pylist()] == [tuple(x) for x in left]
        group = pq.ParquetFile(path).metadata
        low = [group.row_group(k).column(0).statistics for k in range(group.num_row_groups)]
        ids = [x[0] for x in left if x[0] is not None]
        assert not ids or (min(s.min for s in low if s.has_min_max), max(s.max for s in low if s.has_min_max)) == (min(ids), max(ids))
    return got


def test_whole_tables(spark):
    frames = {n: table(spark, SMALL, n) for n in TABLES}
    odd = frames["clicks"].limit(40)
    frames["clicks"] = frames["clicks"].union(odd).union(odd.withColumn("client_id", F.lit(None).cast("long")))
    compare(spark, frames, files=12)


def test_emptied_and_hot(spark):
    """One master with all clients: every file goes; and a table with one client only, of which a part goes."""
    frames = {n: table(spark, SMALL, n).limit(300) for n in TABLES}
    all_ = dict(frames, clients=table(spark, SMALL, "clients").withColumn("master_id", F.lit(5).cast("long")), clicks=frames["clicks"].where("client_id IS NOT NULL"))
    got = compare(spark, all_, files=3)
    assert not any(r.table_name in ("clients", "clicks") for r in got)
    empty = {n: df.limit(0) for n, df in frames.items()}
    assert compare(spark, empty) == []


def test_nested_and_clashing_columns(spark):
    df = spark.createDataFrame([(i % 4, {"a": i % 3}, [i], (i,), "x") for i in range(50)], "file int, key map<string,int>, row array<int>, at struct<id:int>, lead string")
    rows = df.select(as_row(df), F.lit(None).cast("string").alias("lead"))
    held = sorted_files({"all": rows, "none": rows.limit(0)}, f"{shared_folder(spark)}/nested-{uuid.uuid4().hex}", 7)["all"]
    assert held.file == "_file" and held.per_file == 8
    back = held.read(spark).orderBy("file", "at").collect()
    assert sorted(repr(r.row) for r in back) == sorted(map(repr, df.collect()))
    assert [r.file for r in back] == [k // 8 for k in range(50)] and [r.row.file for r in back] == sorted(r.file for r in df.collect())
