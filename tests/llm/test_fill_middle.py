"""Fill in the middle: against a cut of lists of units in Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.llm import fill_middle as fm

DOCS = "doc_id long, text string, n string, form map<string,int>, p int, row int"


def cut(doc_id, text, unit):
    units = [m[0] for m in re.finditer(unit if unit == "." else f"(?:{unit}|.)", text or "", re.S)]
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    x, y = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if not text or any(z in text for z in fm.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text or ""
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("unit", [".", r"\S+\s*", r"[^\n]*\n"])
def test_cuts(spark, unit):
    rng = random.Random(3)
    texts = [None, "", "x", "a<M>b", "<", "<P", "é😀\n" * 5000, "word " * 9000, "\n\n", "<S", "𝒳" * 4096, "y" * 8192] + ["".join(rng.choice("ab <PSM>\n😀é") for _ in range(rng.randrange(60))) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[7]), (None, "null id"), (None, None), (5, "other text")]
    docs = spark.createDataFrame([(i, t, "n", {"a": 1}, 2, 3) for i, t in rows], DOCS)
    made = fm.fill_in_middle(docs, unit=unit)
    assert made.columns == ["doc_id", "text", "p", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", fm.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(repr((i, t, *cut(i, t, unit))) for i, t in rows)
    assert sorted(repr((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got) == want
    assert all(r.back == (r.text or "") for r in got)


def test_odd_tables(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        fm.fill_in_middle(spark.createDataFrame([], DOCS), unit="a*")
    with pytest.raises(ValueError):
        fm.fill_in_middle(spark.createDataFrame([], DOCS), sentinels=("<P>", "P><", "<M>"))
