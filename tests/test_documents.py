"""Rules on single documents, and the whole chain."""

import json
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import chunking, extraction, headings, mathtext
from folioforge.functions.markup import parsed
from folioforge.functions.tables import cell_texts, flattened, grid, is_structured
from folioforge.operators import ocr, qa, vectors
from folioforge.operators.providers import EchoLlm, HashedWords
from folioforge.plans.pipeline import PipelineConfig, answers, stages
from folioforge.sources import files
from folioforge.streaming import incremental


@pytest.mark.parametrize(
    ("given_", "want"),
    [
        (r"25^\circ C", "25°C"),
        (r"x_1^2", "x₁²"),
        (r"a^10", "a¹0"),
        (r"m^(-3)", "m⁻³"),
        (r"\frac{a}{\frac{b}{c}}", "[(a)/([(b)/(c)])]"),
        (r"\frac{a}", "frac{a}"),
        (r"\sqrt{x}", "√(x)"),
        (r"\delta", "Δ"),
        (r"sometimes", "some×"),
        (r"\sum(x)", "Σ(x)"),
        (r"sum x", "Σ x"),
        (r"\text{kg}/\text{t-p}", "kg/t-p"),
        (r"10 \text{m}^3", "10m³"),
        (r"\left( a \right)", "( a )"),
        (r"e^{-1} e^{+}", "e⁻¹ e⁺"),
        (r"go go go go", "go"),
    ],
)
def test_formulas(given_, want):
    assert mathtext.plain_math(given_) == want


def test_formula_tags():
    assert mathtext.without_formulas('<math>a_1</math> <math display="block">b_2</math>') == 'a₁ <math display="block">b₂</math>'


def test_headings():
    text, found = headings.outlined("1. 적용범위\n<p>1.2 a</p>\n1.2.3 b\n1.3.1 c\n7. d\n1.31 e\n#### 목적\n3) f\n5이상판단및조치기준")
    assert text.split("\n") == ["# 1 적용범위", "## 1.2 a", "### 1.2.3 b", "1.3.1 c", "7. d", "1.31 e", "#### 목적", "#### 3) f", "5이상판단및조치기준"]
    assert found[0] == (1, "1 적용범위") and len(found) == 5
    assert headings.outlined("가. x")[0] == "<p>가. x</p>"
    assert headings.with_formula_headings('<math display="block">4.3 r = 1</math>').startswith("## 4.3 r\n<math")


def test_tables():
    html = '<table><tr><th rowspan="2">a</th><th colspan="2">b</th></tr><tr><th>c</th><th>d</th></tr><tr><td>1</td><td>2<img alt="x"></td><td></td></tr></table>'
    assert not is_structured(html) and is_structured("<p>none</p>")
    g = grid(html)
    assert (g["n_rows"], g["n_cols"]) == (3, 3)
    assert flattened(g) == ["a > a: 1 | b > c: 2 (이미지: x) | b > d: "]
    assert cell_texts(html) == ["a", "b", "c", "d", "1", "2 (이미지: x)"]
    assert flattened(grid("<table><tr><th>a</th></tr></table>")) == []
    assert grid("<table><tr></tr></table>") is None
    assert flattened(grid('<table><tr><td colspan="x">1</td></tr></table>')) == ["col1: 1"]


def test_markup_is_written_as_it_was():
    html = '<p class="a">x &amp; y<br/><img alt="q"/></p><!--c--><ul><li>1</li></ul>'
    assert parsed(html).inner() == html
    assert parsed("<p>a<p>b</i></p>").inner() == "<p>a<p>b</p></p>"


def test_extraction():
    text = (
        "<!-- 페이지번호: 2, 파일명: F -->\n# 1 A\n### deep\n<table><tr><td>1</td></tr></table>\n<p>between</p><table><tr><td>2</td></tr></table><p><a href='components/t.png'>Table Snapshot</a></p>\n"
        '<table><tr><td><img src="lost.png"></td></tr></table>\nplain\n<math display="block">e</math>\n</math><img alt="equation-block snippet" src="e.png">\n## B\n<img alt="note" src="n.png">\nend'
    )
    found = extraction.extracted(text, "doc", "TP-030-030-100")
    table = found["tables"][0]
    assert (table["id"], table["section_path"], table["page"], table["image_link"]) == ("TB_STR_001", "1 A / deep", 2, "output/sanitize/doc/components/t.png")
    assert table["row_flatten"] == ["col1: 1"]
    assert found["special"][0]["placeholder"] == "COMPLEX_TABLE" and found["special"][0]["image_src"] == "lost.png"
    assert [x["id"] for x in found["images_summary"]] == ["IMG_SUM_001"] and found["images_translation"][0]["section_path"] == "1 A / B"
    assert "{{IMG_TR_001}}end" in found["text"]


def test_chunks():
    text = "<!-- 페이지번호: 1, 파일명: F -->\nintro\n# 1. a\nx\n<!-- 페이지번호: 2, 파일명: F -->\n## note\ny\n## 1.2 b\nz"
    got = chunking.chunks(text)
    assert [(c["section_path"], c["pages"], c["filename"]) for c in got] == [("", [1], "F"), ("1. a / note", [1, 2], "F"), ("1. a / 1.2 b", [2], "F")]
    strict = chunking.chunks("# 1 a\n## note\n## 1.2 b\n## 2.1 c", strict=True)
    assert [c["section_path"] for c in strict] == ["1 a", "1 a / 1.2 b", "2.1 c"]


def test_lists_and_text():
    html = '<ul><li>a<ol type="A"><li>b</li></ol></li></ul><hr><p>c <b>d</b></p><!-- k -->'
    assert chunking.readable(html) == "● a b\n  A. b\n\nc d\n\n<!-- k -->"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["abc ", "{{IMG_001}}", "x", "  ", "{{", "}}"]), max_size=40), st.integers(0, 20), st.integers(0, 25))
def test_windows_end_and_keep_placeholders(parts, size, overlap):
    text = "".join(parts)
    got = chunking.windows(text, size, overlap)
    if size:
        squeezed = lambda s: "".join(s.split())
        if overlap == 0:
            assert squeezed("".join(got)) == squeezed(text)
        for mark in set(chunking.PLACEHOLDER.findall(text)):
            assert any("{{" + mark + "}}" in g for g in got)
    else:
        assert got == [text]


def test_point_ids(spark):
    keys = ["", "a||b", "한글||x", "é" * 300]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(vectors.uuid5(F.col("k"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, k)) for k in keys]
    assert vectors.collection_name(distance="dot", m=32, on_disk=True) == "final_embeddings_dot_m32-ef100_disk"


def test_pages_of_ocr(spark):
    html = '<div data-label="Page-Header">h</div><div data-label="Text" data-bbox="[0,0,512,512]">t</div><div data-label="Figure" data-bbox="[100,100,200,200]">g</div><div data-label="Table" data-bbox="bad"><table></table></div>'
    pages = spark.createDataFrame([("d", "doc", 2, html, 1024, 2048), ("d", "doc", 1, None, 10, 10)], "doc_key string, stem string, page int, html string, width int, height int")
    made = ocr.assembled_pages(pages)
    assets = made.where("page = 2").first()["assets"]
    assert [(a["label"], a["bbox"]) for a in assets] == [("Figure", [85, 155, 215, 415]), ("Table", [0, 0, 16, 17])]
    text = ocr.assembled_documents(made).first()["text"]
    assert text.startswith("<h2>Page 1</h2>\n\n\n<hr/>\n\n<h2>Page 2</h2>\n<p>t</p>") and "Table snapshot" in text


def _write(tmp_path):
    doc = '<h2>Page 1</h2>\n<h1>1 Scope</h1>\nsome <b>words</b> here\n<table><tr><th>k</th><th>v</th></tr><tr><td>a</td><td>b</td></tr></table><p><a href="components/t.png">Table snapshot</a></p>\n<img alt="Figure snippet" src="components/i.png"/>\n<img alt="a note" src="components/n.png"/>\n'
    folder = tmp_path / "in" / "one"
    folder.mkdir(parents=True)
    (folder / "TP-030-010-020 One (Rev.1).md").write_text(doc)
    (tmp_path / "in" / "skip.txt").write_text("x")
    return str(tmp_path / "in")


def test_from_files_to_answers(spark, tmp_path):
    docs = files.markdown(spark, _write(tmp_path))
    assert [(r["folder"], r["filename"]) for r in docs.collect()] == [("one", "TP-030-010-020 One (Rev.1).md")]
    assert files.markdown(spark, str(tmp_path / "none")).count() == 0
    made = stages(docs, PipelineConfig(chunk_size=80, chunk_overlap=10))
    finals = {r["id"]: r for r in made.finals.collect()}
    assert {"TB_STR_001", "TB_STR_001#1", "TB_STR_001#summary"} <= set(finals)
    assert finals["TB_STR_001#1"]["text"] == "[문서: One] [경로: 1 Scope] k: a | v: b"
    assert any(k.startswith("TEXT_002#c") for k in finals)
    assert made.payloads.count() == 3 and made.results.where("ok").count() == 1
    (tmp_path / "q.csv").write_text("﻿Question,x\nwhat is k?,1\n ,2\n")
    asked = qa.numbered(files.questions(spark, str(tmp_path / "q.csv")))
    got = {r["qid"]: r for r in answers(asked, made.points, PipelineConfig(llm=EchoLlm(), embedder=HashedWords(), top_k=2)).collect()}
    assert got["1"]["answer"] and "[1] type=" in got["1"]["evidence"] and (got["2"]["answer"], got["2"]["evidence"]) == ("", "")
    with pytest.raises(ValueError):
        files.questions(spark, str(tmp_path / "q.csv"), "other")


def test_files_that_arrive(spark, tmp_path):
    root, out = _write(tmp_path), str(tmp_path / "points")
    incremental.upserting(incremental.arriving(spark, root), lambda d: stages(d).points, out, str(tmp_path / "c")).awaitTermination()
    first = incremental.stored(spark, out).count()
    (tmp_path / "in" / "one" / "two.md").write_text("# 1 b\ntext")
    incremental.upserting(incremental.arriving(spark, root), lambda d: stages(d).points, out, str(tmp_path / "c")).awaitTermination()
    assert 0 < first < incremental.stored(spark, out).count()


def test_lenient_and_strict_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "x"}]')
    (tmp_path / "b.json").write_text("[broken")
    good, bad = files.json_records(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")], "id string", lenient=True)
    assert [r["id"] for r in good.cache().collect()] == ["x"] and bad.count() == 1


def test_scores_of_odd_vectors(spark):
    """A vector of zeros scores 0, one that is null, short or holds a null has no score and is nobody's neighbour; nothing divides by zero."""
    points = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0]), (6, [1.0, None]), (7, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    asked = points.where("vec_id IN (1, 3, 4)").selectExpr("vec_id AS qid", "embedding AS query")
    got = {(r["qid"], r["rank"]): (r["id"], r["score"]) for r in vectors.top_k(asked, points, 5).collect()}
    assert got == {(1, 1): (2, 1.0), (1, 2): (3, 0.0), (1, 3): (7, -1.0), (3, 1): (1, 0.0), (3, 2): (2, 0.0), (3, 3): (7, 0.0)}
    assert {r["qid"] for r in vectors.top_k(asked, points, 5, "l2").collect()} == {1, 3}


def test_boxes_of_any_numbers(spark):
    raw = ["[0, 0, 1e12, 512]", "[-1e300, 512, 1024, 1e300]", "[1, 2]", "nonsense", None, "[null, 0, 512, 512]", "[1e12, 1e12, 1e12, 1e12]"]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(raw)], "k int, raw string")
    got = {r["k"]: list(r["b"]) for r in df.select("k", ocr.scaled_box(F.col("raw"), F.lit(1000), F.lit(2000)).alias("b")).collect()}
    assert got[0] == [0, 0, 1000, 1000] and got[1] == [0, 1000, 1000, 2000] and got[5] == [0, 0, 500, 1000]
    assert got[2] == got[3] == got[4] == [0, 0, 0, 1]
    assert got[6][2:] == [1000, 2000]


def test_a_good_answer_ends_the_attempts(spark, tmp_path):
    from folioforge.operators.enrich import answered

    class Late:
        """Good from the attempt on that the payload names; notes each call."""

        def answer(self, prompt, link, attempt):
            wanted = int(link)
            with open(f"{tmp_path}/calls", "a") as f:
                f.write(f"{link}:{attempt}\n")
            return '{"image_summary": "The drawing shows a tall furnace with two pipes that lead into a tank of water."}' if attempt >= wanted else "no"

    rows = [("d", "images_trans", str(k), "say", "{}", str(k)) for k in (1, 2, 3, 9)]
    asked = spark.createDataFrame(rows, "doc_key string, family string, id string, instruction string, input string, image_link string").coalesce(1)
    got = {r["id"]: (r["attempt"], r["ok"]) for r in answered(asked, Late(), 3).collect()}
    assert got == {"1": (1, True), "2": (2, True), "3": (3, True), "9": (3, False)}
    assert sorted(open(f"{tmp_path}/calls").read().split()) == ["1:1", "2:1", "2:2", "3:1", "3:2", "3:3", "9:1", "9:2", "9:3"]


def test_the_last_write_of_a_point_stays(spark):
    stored = spark.createDataFrame([("a", 0, "old"), ("b", 0, "old")], "point_id string, ord int, text string")
    new = spark.createDataFrame([("a", 1, "first"), ("c", 5, "x"), ("a", 3, "last"), ("a", 2, "second"), ("c", 5, "y")], "point_id string, ord int, text string").coalesce(1)
    assert {r["point_id"]: r["text"] for r in vectors.upserted(stored, new).collect()} == {"a": "last", "b": "old", "c": "y"}
    assert {r["point_id"]: r["text"] for r in vectors.upserted(stored.drop("ord"), new.drop("ord")).collect()} == {"a": "second", "b": "old", "c": "y"}


@pytest.mark.parametrize("unit", ["mm", "KW", "m/s", "kg/t-p", "g/1000", "C/Hr", "Ton-Slag", "mmAq", "ton-pig", "kcal", "cal/mol"])
def test_units_in_formulas(unit):
    assert mathtext.without_formulas(f"<math>5 \\text{{ {unit} }}</math>").replace(" ", "") == f"5{unit}"


def test_logs_and_time(spark, tmp_path):
    from folioforge.plans.pipeline import logs

    made = stages(files.markdown(spark, _write(tmp_path)))
    kinds = [r["kind"] for r in logs(made).collect()]
    assert kinds.count("answer") == 2 and kinds.count("missing_heading") == 6
    done = spark.createDataFrame([("a", 0.5, 1.0), ("b", 0.25, 2.0)], "qid string, embed_seconds double, answer_seconds double")
    assert tuple(qa.time_sums(done).first()) == (2, 0.75, 3.0) and tuple(qa.time_sums(done.limit(0)).first()) == (0, 0.0, 0.0)


def test_a_collection_is_made_once(spark):
    points = spark.createDataFrame([("p", None), ("q", [1.0, 2.0])], "point_id string, dense array<float>")
    none = spark.createDataFrame([], "name string, size int, distance string, m int, ef int, on_disk boolean")
    first = vectors.with_collection(none, points, "c", "L2", on_disk=True)
    assert [tuple(r) for r in first.collect()] == [("c", 2, "euclid", 16, 100, True)]
    assert vectors.with_collection(first, points, "c").count() == 1
    assert vectors.with_collection(none, points.limit(0), "c").count() == 0


def test_written_and_read_again(spark, tmp_path):
    rows = spark.createDataFrame([(k, "가\"\n" if k % 2 else None, f"s{k % 2}") for k in range(300)], "k long, said string, split string").repartition(3)
    files.export_json(rows.orderBy("k"), str(tmp_path / "one"))
    parts = list((tmp_path / "one").glob("part-*"))
    got = json.loads(parts[0].read_text())
    assert len(parts) == 1 and [r["k"] for r in got] == list(range(300)) and got[0]["said"] is None and got[1]["said"] == "가\"\n"
    files.export_json(rows.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "none").glob("part-*"))) == []
    files.write_json(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).select("k", "said").exceptAll(rows.select("k", "said")).count() == 0
    files.write_split(rows, str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split" / "split=s1")).count() == 150
    files.write_answers(rows.where("said IS NOT NULL").select("said", "k"), str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, multiLine=True, escape='"')
    assert back.count() == 150 and {r[0] for r in back.collect()} == {"가\"\n"}
    (tmp_path / "a" / "components").mkdir(parents=True)
    (tmp_path / "a" / "components" / "i.png").write_bytes(b"png")
    assert [(r["rel"], bytes(r["content"])) for r in files.assets(spark, str(tmp_path / "a")).collect()] == [("components/i.png", b"png")]


def test_components_are_gathered(spark, tmp_path):
    for name, data in (("a", {"tables": [{"id": "TB_STR_001"}, {"id": "TB_UNSTR_001"}, {"id": "x", "component_type": "table_unstructured"}], "texts": [{"id": "TEXT_001", "text": "t"}]}), ("b", {"images_summary": [{"id": "i", "component_type": "image_formula"}, {"id": "j"}], "images_translation": [{"id": "k"}]})):
        (tmp_path / name).mkdir()
        (tmp_path / name / "components.json").write_text(json.dumps(data))
        (tmp_path / name / "other.json").write_text("[]")
    got = {r["id"]: (r["split"], r["ord"]) for r in files.gathered(spark, str(tmp_path)).collect()}
    assert got == {"TB_STR_001": ("tables_str", 1), "TB_UNSTR_001": ("tables_unstr", 2), "x": ("tables_unstr", 3), "TEXT_001": ("texts", 1), "i": ("images_formula", 1), "j": ("images_sum", 2), "k": ("images_trans", 1)}
