"""Fill-in-middle transformation by relational units.

A unit is a match of a pattern (a character, a word with its space, a line); whatever the pattern leaves over is a unit for each character, so the units of a text are the text. Texts are matched by runs of many units, which are exploded with
their positions; window sums over a document's runs tell how many units and characters stand before each. A request for a cut names a unit, so it meets the one run that holds it in a join by ordinal; what is left of it is counted in that run
alone. The offsets of a document's cuts are aggregated into one row, which meets the text in the only join that moves it, and substring does the rest.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.support import row_key, written

#: What marks prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred documents, from which on they stay plain; of those that are cut, up to which the suffix comes first.
PLAIN_FROM, SPM_BELOW = 90, 20
#: Units of a run: of single characters, and of other patterns, whose matching is nested.
RUN, NESTED_RUN = 4096, 256


def _patterns(unit: str) -> tuple[str, str, int]:
    """Java patterns of one unit and of a run of them, and the run's units."""
    if unit == ".":
        return "(?s).", f"(?s).{{1,{RUN}}}", RUN
    if re.fullmatch(unit, ""):
        raise ValueError(f"the unit {unit!r} matches an empty text")
    return f"(?s)(?:{unit}|.)", f"(?s)(?:{unit}|.){{1,{NESTED_RUN}}}", NESTED_RUN


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """No sentinel may end as another begins or stand in another: else an output could be read in two ways."""
    for a in sentinels:
        for b in sentinels:
            if not a or (a is not b and a in b) or any(b.startswith(a[k:]) for k in range(1, len(a))):
                raise ValueError(f"sentinels {a!r} and {b!r} overlap")
    return sentinels


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits for a document: the first groups of eight digits of a sha256. A null doc_id has no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut_offsets(texts: DataFrame, unit: str = ".", seed: int = 1) -> DataFrame:
    """p, q, n (units) and, for cuts 0 and 1, before_k (characters before the run), chars_k (characters of the run) and inside_k (units of the run before the cut), for each (p, q) with a text that isn't empty.

    texts: p, q, doc_id, text; rows with the same p and q are the same.
    """
    one, run, most = _patterns(unit)
    matched = texts.select("p", "q", "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(run), F.lit(0))).alias("pos", "run"))
    units = F.length("run") if unit == "." else F.regexp_count("run", F.lit(one))
    sized = matched.select("p", "q", "doc_id", "pos", F.length("run").cast("long").alias("chars"), units.cast("long").alias("units"))
    once = sized.groupBy("p", "q", "pos").agg(F.max("doc_id").alias("doc_id"), F.max("chars").alias("chars"), F.max("units").alias("units"))

    whole = Window.partitionBy("p", "q")
    before = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0).cast("long")) for c in ("chars", "units")}
    summed = written(once.withColumns(sums | {"n": F.sum("units").over(whole)}), "runs")

    h = draws(F.col("doc_id"), seed)
    ends = [F.pmod(x, F.col("n") + 1) for x in h[:2]]
    asked = summed.where("pos = 0").select("p", "q", F.posexplode(F.array(F.least(*ends), F.greatest(*ends))).alias("cut", "unit"))
    asked = asked.withColumn("pos", F.expr(f"cast((greatest(unit, 1L) - 1) div {most} AS int)"))
    met = asked.join(summed, ["p", "q", "pos"]).withColumn("inside", F.col("unit") - F.col("units_before"))
    of = lambda k, c, name: F.max(F.when(F.col("cut") == k, F.col(c))).alias(f"{name}_{k}")
    return met.groupBy("p", "q").agg(F.max("n").alias("n"), *[of(k, c, name) for k in (0, 1) for c, name in (("chars_before", "before"), ("chars", "chars"), ("inside", "inside"))])


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    part = lambda k: F.get(parts, F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = ".", seed: int = 1, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All rows and columns of docs, with n (units), form (plain, psm or spm), prefix_chars and middle_chars (null if plain) and output.

    unit is a pattern that Java reads with (?s). A null text counts as empty; empty texts and texts with a sentinel stay plain. A null id draws as if it had no digits. Rows alike in id and text have the same cuts; all are kept. Texts are cut
    whole, whatever their length. An empty table gives an empty result. Input columns named as a new one are replaced; others keep their names, whatever they are.
    """
    p_mark, s_mark, m_mark = _checked(sentinels)
    one = _patterns(unit)[0]
    own = [c for c in docs.columns if c.lower() not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = row_key(id_col, text_col)
    offsets = cut_offsets(docs.select(*key, F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")), unit, seed)

    row = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in own if c != text_col]).alias("row")
    whole = docs.select(row, F.col(f"`{text_col}`").alias("given"), F.col(f"`{id_col}`").alias("id"), *key)
    placed = whole.join(offsets.hint("shuffle_hash"), ["p", "q"], "left").withColumn("text", F.coalesce("given", F.lit("")))

    def cut(k: int) -> Column:
        if unit == ".":
            return F.col(f"before_{k}") + F.col(f"inside_{k}")
        held = F.regexp_extract_all(F.substr("text", F.col(f"before_{k}") + 1, F.col(f"chars_{k}")), F.lit(one), F.lit(0))
        return F.col(f"before_{k}") + F.length(F.array_join(F.slice(held, F.lit(1), F.col(f"inside_{k}").cast("int")), ""))

    h = draws(F.col("id"), seed)
    marked = F.lit(False)
    for s in sentinels:
        marked = marked | F.contains("text", F.lit(s))
    form = F.when((F.col("text") == "") | marked | (h[2] % 100 >= PLAIN_FROM), "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    placed = placed.withColumns({"form": form, "x": cut(0).cast("int"), "y": cut(1).cast("int")})
    prefix, middle, suffix = F.substr("text", F.lit(1), F.col("x")), F.substr("text", F.col("x") + 1, F.col("y") - F.col("x")), F.substr("text", F.col("y") + 1)
    psm = F.concat(F.lit(p_mark), prefix, F.lit(s_mark), suffix, F.lit(m_mark), middle)
    spm = F.concat(F.lit(s_mark), suffix, F.lit(p_mark), prefix, F.lit(m_mark), middle)
    new = {
        "n": F.coalesce("n", F.lit(0)).cast("long"),
        "form": F.col("form"),
        "prefix_chars": F.when(F.col("form") != "plain", F.col("x").cast("long")),
        "middle_chars": F.when(F.col("form") != "plain", (F.col("y") - F.col("x")).cast("long")),
        "output": F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")),
    }
    return placed.select(*[F.col("given").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in own], *[v.alias(c) for c, v in new.items()])


def fill_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    made = fill_in_middle(docs.select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
