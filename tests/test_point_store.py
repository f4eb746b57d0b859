"""The store of points against a dictionary, stages that parse once, answers that are kept."""

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioforge.operators.enrich import answered_and_kept
from folioforge.plans import registry
from folioforge.plans.pipeline import PipelineConfig, logs, stages
from folioforge.streaming.point_store import PointStore


def _batch(spark, rows):
    return spark.createDataFrame(rows, "point_id string, ord int, text string").coalesce(1)


def test_runs_are_merged_and_rows_stay(spark, tmp_path):
    store, want = PointStore(spark, str(tmp_path), fanout=3), {}
    for number in range(11):
        rows = [(f"p{k}", k % 2, f"{number}/{k}") for k in range(number, number + 4)] + [(None, 0, f"none {number}")] + [(f"p{number}", 5, f"last {number}")]
        want |= {r[0]: r[2] for r in sorted(rows, key=lambda r: r[1])}
        assert store.append(_batch(spark, rows), number)
    assert {r["point_id"]: r["text"] for r in store.read().collect()} == want and store.read().count() == len(want)
    assert [(r.name, r.level) for r in store.runs()] == [("0-8", 2), ("9-9", 0), ("10-10", 0)]
    assert {r["point_id"]: r["text"] for r in store.found(["p0", "p10", "none"]).collect()} == {k: want[k] for k in ("p0", "p10")}
    assert sum(r.rows for r in store.runs()) == 13 + 5 + 5 and all(r.seconds > 0 for r in store.runs())


def test_a_read_looks_at_runs_that_count_only(spark, tmp_path):
    store = PointStore(spark, str(tmp_path), fanout=2)
    for number in range(4):
        store.append(_batch(spark, [("a", 0, str(number)), (f"b{number}", 0, "x")]), number)
    assert all("/runs/0-3/" in f for f in store.read().inputFiles())
    before = sorted(store.read().collect())
    assert store.vacuum() == 6 and sorted(store.read().collect()) == before and store.vacuum() == 0
    assert [p.name for p in (tmp_path / "runs").iterdir()] == ["0-3"]


def test_what_failed_or_comes_again_changes_nothing(spark, tmp_path):
    store = PointStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no points"):
        store.read()
    store.append(_batch(spark, [("a", 0, "first")]), 3)
    assert not store.append(_batch(spark, [("a", 0, "again")]), 3) and not store.append(_batch(spark, [("a", 0, "older")]), 2)
    _batch(spark, [("z", 0, "half")]).write.parquet(f"{tmp_path}/runs/4-4")  # a run that no state names
    (tmp_path / "states" / "2").mkdir()  # a state that wasn't finished
    assert [r["text"] for r in store.read().collect()] == ["first"]
    assert store.append(_batch(spark, [("a", 0, "second")]), 4) and [r["text"] for r in store.read().collect()] == ["second"]
    assert store.append(_batch(spark, []), 5) and store.read().count() == 1
    wider = _batch(spark, [("c", 0, "new")]).withColumn("more", F.lit(1))
    store.append(wider, 6)
    assert {r["point_id"]: r["more"] for r in store.read().collect()} == {"a": None, "c": 1}


def test_sales_as_they_were_last(spark):
    got = registry.QUERIES["upsert_store"](spark, SMALL)
    names = got.columns
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["arrived_at", *[c for c in names if c != "arrived_at"]])
    want = duckdb.sql(f"SELECT {', '.join(names)} FROM '{SMALL}/sales.parquet' QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY {order}) = 1").fetchall()
    assert want and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_a_stopped_run_asks_only_what_has_no_good_answer(spark, tmp_path):
    class Counting:
        """Answers well, notes each call, and fails for one id while a file is there."""

        def __init__(self, folder):
            self.folder = str(folder)

        def answer(self, prompt, link, attempt):
            import os

            if link == "7" and os.path.exists(f"{self.folder}/broken"):
                raise RuntimeError("the service is down")
            with open(f"{self.folder}/calls", "a") as f:
                f.write(f"{link}\n")
            return "no" if link == "5" else '{"image_summary": "The drawing shows a tall furnace with two pipes that lead into a tank of water."}'

    shape = "doc_key string, family string, id string, instruction string, input string, image_link string"
    asked = spark.createDataFrame([("d", "images_trans", str(k), "say", "{}", str(k)) for k in range(12)], shape).coalesce(1)
    calls = lambda: open(f"{tmp_path}/calls").read().split() if (tmp_path / "calls").exists() else []
    (tmp_path / "broken").touch()
    with pytest.raises(Exception, match="service is down"):
        answered_and_kept(asked, Counting(tmp_path), str(tmp_path / "kept"), 1, 4)
    part = {r["id"]: r["p"] for r in asked.select("id", F.pmod(F.xxhash64("doc_key", "family", "id"), F.lit(4)).alias("p")).collect()}
    done = {i for i in part if part[i] < part["7"]}
    (tmp_path / "broken").unlink()
    (tmp_path / "calls").unlink(missing_ok=True)
    got = {r["id"]: r["ok"] for r in answered_and_kept(asked, Counting(tmp_path), str(tmp_path / "kept"), 1, 4).collect()}
    assert got == {str(k): k != 5 for k in range(12)}
    assert sorted(calls()) == sorted(i for i in part if i not in done or i == "5")
    (tmp_path / "calls").unlink()
    changed = asked.withColumn("input", F.when(F.col("id") == "3", '{"a": 1}').otherwise(F.col("input")))
    assert answered_and_kept(changed, Counting(tmp_path), str(tmp_path / "kept"), 1, 4).count() == 12
    assert sorted(calls()) == ["3", "5"]


def test_documents_are_parsed_once(spark, tmp_path):
    text = "# 1 적용범위\n<table><tr><th>a</th></tr><tr><td>1</td></tr></table>\n<img alt='x' src='n.png'>\nend"
    docs = spark.createDataFrame([(f"d{k}", "f", f"n{k}.md", text) for k in range(3)], "doc_key string, folder string, filename string, text string")
    made = stages(docs, PipelineConfig(), str(tmp_path / "made"))
    for df in (made.components, made.texts, made.payloads, made.results, made.finals, made.points, made.found):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan
    first = made.points.count()
    assert first and {r["kind"] for r in logs(made).collect()} >= {"heading"}
    pages = spark.createDataFrame([("d", 1, None), ("e", None, "no pages")], "doc_key string, page int, error string")
    assert [r["said"] for r in logs(made, pages).where("kind = 'ocr_error'").collect()] == ["e no pages"]
    assert stages(docs, PipelineConfig(), str(tmp_path / "made")).points.count() == first
    assert stages(docs.limit(0)).points.count() == 0
