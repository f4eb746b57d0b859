"""Files that are cut anywhere: the same records as when one task reads them whole."""

import csv
import json
import random

import pytest

from folioforge.sources.files import json_records
from folioforge.sources.splitting import array_records, csv_records

SCHEMA = "a long, s string, more struct<x:array<string>,y:map<string,long>>"
TEXTS = ['"', "\\", "\\\\", '\\"', "],[", "{,}", "a,b", '","', "\n", " ", "", "é한 ", "\t", "[[[", "}}", "plain words, and more"]


@pytest.fixture(params=[151])
def small_blocks(spark, request):
    """Blocks of so few bytes that records, quotes and escapes are cut by them."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "20"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def records(rng, n):
    word = lambda: "".join(rng.choices(TEXTS, k=3))
    return [{"a": k, "s": word() if k % 7 else None, "more": {"x": [word() for _ in range(k % 3)], "y": {word(): k}}} for k in range(n)]


@pytest.mark.parametrize("shape", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_arrays_in_many_tasks(spark, tmp_path, small_blocks, shape):
    rng = random.Random(2)
    want = {f"f{k}.json": records(rng, n) for k, n in enumerate((0, 1, 25, 12))}
    for name, rows in want.items():
        (tmp_path / name).write_text(("﻿" if name == "f2.json" else "") + json.dumps(rows, **shape), encoding="utf-8")
    for lenient in (False, True):
        good, bad = array_records(spark, str(tmp_path), SCHEMA, lenient)
        got = {}
        for r in sorted(good.collect(), key=lambda r: r["ord"]):
            got.setdefault(r["path"].rsplit("/", 1)[1], []).append((r["ord"], r.asDict(True)))
        assert {n: [{k: v for k, v in row.items() if k in ("a", "s", "more")} for _, row in rows] for n, rows in got.items()} == {n: rows for n, rows in want.items() if rows}
        assert all([o for o, _ in rows] == list(range(len(rows))) for rows in got.values()) and bad.count() == 0
    whole = json_records(spark, str(tmp_path / "f3.json"), SCHEMA)[0]
    assert sorted(map(str, whole.collect())) == sorted(map(str, array_records(spark, str(tmp_path / "f3.json"), SCHEMA)[0].drop("path", "ord").collect()))


def test_one_file_has_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "one.json").write_text(json.dumps(records(random.Random(1), 50)))
    assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_broken_arrays_are_reported(spark, tmp_path, small_blocks):
    files = {"ok.json": '[{"a":1},{"a":2}]', "word.json": '[{"a":1},nonsense,{"a":3}]', "open.json": '[{"a":1},{"a":2}', "quote.json": '[{"a":1},{"s":"b}]', "object.json": '{"a":1}', "none.json": " \n", "empty.json": "", "blank.json": "[ \n ]"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, bad = array_records(spark, str(tmp_path), SCHEMA, lenient=True)
    name = lambda r: r["path"].rsplit("/", 1)[1]
    assert sorted((name(r), r["ord"], r["a"]) for r in good.collect()) == [("object.json", 0, 1), ("ok.json", 0, 1), ("ok.json", 1, 2), ("open.json", 0, 1), ("open.json", 1, 2), ("quote.json", 0, 1), ("word.json", 0, 1), ("word.json", 2, 3)]
    assert sorted((name(r), r["record"] or "") for r in bad.collect()) == [("object.json", ""), ("open.json", ""), ("quote.json", ""), ("quote.json", '{"s":"b}'), ("word.json", "nonsense")]
    for broken in ("word.json", "open.json", "object.json"):
        with pytest.raises(Exception, match="(?s)MALFORMED|malformed|not a JSON array"):
            array_records(spark, str(tmp_path / broken), SCHEMA)[0].collect()


def test_quoted_csv_in_many_tasks(spark, tmp_path, small_blocks):
    rng = random.Random(4)
    rows = [[str(k), "".join(rng.choices(['"', "\n", ",", "a b", "\n\n", "é", "'"], k=4)) + "x"] for k in range(60)]
    with open(tmp_path / "q.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows([["a", "the\nname"], *rows])
    good, bad = csv_records(spark, str(tmp_path), "a long, s string")
    assert [(r["ord"], str(r["a"]), r["s"]) for r in sorted(good.collect(), key=lambda r: r["ord"])] == [(k, *row) for k, row in enumerate(rows)]
    assert bad.count() == 0


def test_csv_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,s\n1,x\r\n\nword,y\n3,"open\n4,z\n')
    good, bad = csv_records(spark, str(tmp_path), "a long, s string")
    assert [(r["a"], r["s"]) for r in good.collect()] == [(1, "x")]
    assert sorted(r["record"] for r in bad.collect()) == ['3,"open\n4,z', "word,y"]
