"""The quick ways through plain markup and formulas against the slow ones."""

import random
import re
import time

from folioforge.functions import chunking, markup, mathtext, tables


def shown(node):
    return (node.name, node.attrs, [shown(x) if isinstance(x, markup.Node) else (str(x), x.kind) for x in node.children])


def test_plain_markup_is_parsed_as_the_parser_does(monkeypatch):
    parts = ["<td>", "</td>", "<tr>", "</tr>", "<table>", '<img alt="x"/>', '<img src="b">', "<br>", "</br>", "<p/>", "</p>", " ", "\n ", "text", "a > b", "&lt;", "<!-- c -->", '<TD CLASS="q">', "<td a=1>", "<pre> </pre>", "<", '<td a="" a="2">', "<title>a", "\x00"]
    rng, plain = random.Random(2), markup._plain
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    quick = [shown(markup.parsed(t)) for t in texts]
    assert sum(plain(t) is not None for t in texts) > 300
    monkeypatch.setattr(markup, "_plain", lambda html: None)
    assert quick == [shown(markup.parsed(t)) for t in texts]


def test_patterns_that_cannot_match_are_left_out(monkeypatch):
    rng, signs = random.Random(3), [*mathtext._NEEDED, *"\\{}^ 23_m", "\\text{", "}^3", "Kg", "\u212a", "\u017f", "\\CIRC", "{C}"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    quick = [mathtext.plain_math(t) for t in texts]
    monkeypatch.setattr(mathtext, "_ALIKE", re.compile(""))
    assert quick == [mathtext.plain_math(t) for t in texts]


def test_a_table_is_parsed_once(monkeypatch):
    """By documents.flattened, for both questions asked of it."""
    calls = []
    monkeypatch.setattr(markup, "_plain", lambda html, plain=markup._plain: calls.append(html) or plain(html))
    tree = markup.parsed("<table><tr><th>a</th></tr><tr><td>b</td></tr></table>")
    assert tables.is_structured(tree) and tables.flattened(tables.grid(tree)) == ["a: b"] and len(calls) == 1


def test_windows_of_texts_with_many_placeholders():
    """Time in proportion to the text; no placeholder is cut."""
    text = "said. {{IMG_SUM_001}} " * 20_000
    began = time.perf_counter()
    found = chunking.windows(text, 60, 30)
    assert time.perf_counter() - began < 20 and all(x.count("{{") == x.count("}}") for x in found)


def test_batches_of_windows_are_bounded(spark):
    from folioforge.plans.registry import QUERIES

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    QUERIES["chunk_placeholder"](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == 8 << 20


def test_rows_of_small_files_are_dealt(spark):
    """Every task takes part in Python's work, and a box is read once for all of its numbers, where the plan uses it (the filter that Spark adds to an explode and the explode itself)."""
    from folioforge.plans.registry import QUERIES, dealt
    from folioforge.plans import rules  # noqa: F401

    assert dealt(spark.range(100).coalesce(1)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    for name in ("table_spans", "frac_sqrt_math", "page_boxes", "digit_ratio_filter"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" in plan and plan.count("from_json") <= 3
