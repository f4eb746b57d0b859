"""Queries over single rules, with rows that take every branch, and SQL that works out what must come of them.

Texts are composed of a row's values; which case a row takes follows from its key. The SQL lists the same cases in the same order and fills the same values in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import documents, enrich, finalize, ocr, qa, vectors
from folioforge.plans.registry import ORACLES, QUERIES, dealt, query, table

_LOW, _HIGH = "₀₁₂₃₄₅₆₇₈₉", "⁰¹²³⁴⁵⁶⁷⁸⁹"

#: Formulas and what becomes of them, by rule. @ is a digit, ⌄ and ⌃ the same one lowered and raised.
FORMULAS = (
    (r"\\alpha @", "α @"),
    (r"@^\circ C", "@°C"),
    (r"@ ^ { \circ } \text{C}", "@°C"),
    (r"@^{\circ}\mathrm{C}", "@°C"),
    (r"@ ^\circ", "@°"),
    (r"x_@1", "x⌄1"),
    (r"m^( -@ )", "m⁻⌃"),
    (r"m^(+@)", "m+⌃"),
    (r"m^(−@)", "m⁻⌃"),
    (r"m^-@", "m⁻⌃"),
    (r"m^@0", "m⌃0"),
    (r"a<sub> @ </sub>b<SUP>-@</SUP>", "a⌄b⁻⌃"),
    (r"\sum(x@)", "Σ(x@)"),
    (r"\sum( )@", "Σ@"),
    (r"\sum x@", "Σ Σ x@"),
    (r"sum ( x@ )", "Σ(x@)"),
    (r"sum x@", "Σ x@"),
    (r"consum x@", "consum x@"),
    (r"\frac{a@}{b}", "[(a@)/(b)]"),
    (r"\frac{a@}", "frac{a@}"),
    (r"\sqrt{\frac{1}{@}}", "√([(1)/(@)])"),
    (r"\text{ abc@ }", "abc@"),
    (r"a ext{x@}", "a x@"),
    (r"a&amp;@", "a    @"),
    (r"@N m³", "@Nm³"),
    (r"\begin{aligned}x@\end{aligned}", "\nx@\n"),
    (r"\begin{array}{l}x@\end{array}", "\nx@\n"),
    (r"\boxed{ x@ }", "x@"),
    (r"\underline{x@}", "x@"),
    (r"a@ . . . . b", "a@ ...b"),
    (r"go go go x@", "go x@"),
    (r"go go x@", "go go x@"),
    (r"\left( a@ \right)", "( a@ )"),
    (r"x\\@", "x\n@"),
    (r"e^{-@}", "e⁻⌃"),
    (r"e^{ ( @ ) }", "e⌃"),
    (r"@e^{+}", "@e⁺"),
    (r"@Na^+", "@Na⁺"),
    (r"@Cl^-", "@Cl⁻"),
    (r"\foo@", "foo@"),
)
#: The table of signs, in its order; letter case doesn't count, so a later sign that differs in case alone is never reached.
SIGNS = (
    *((rf"a@ \{name} b", f"a@ {sign} b") for name, sign in (
        ("ell", "ℓ"), ("Delta", "Δ"), ("delta", "Δ"), ("mu", "μ"), ("eta", "η"), ("Phi", "Φ"), ("alpha", "α"), ("beta", "β"), ("pi", "π"), ("lambda", "λ"), ("sigma", "Σ"), ("varepsilon", "ϵ"), ("rho", "ρ"), ("uparrow", "↑"),
        ("downarrow", "↓"), ("leftrightarrow", "↔"), ("rightarrow", "→"), ("nightarrow", "→"), ("to", "→"), ("pm", "±"), ("%", "%"), ("times", "×"), ("cdot", "·"), ("dots", "…"), ("le", "≤"), ("ge", "≥"), ("sim", "~"),
        ("circ", "◯"), ("triangle", "△"), ("square", "□"), ("div", "÷"), ("approx", "≒"), ("arrow", "→"), ("quad", "     "),
    )),
    *((f"a@ {name} b", f"a@ {sign} b") for name, sign in (("rightarrow", "→"), ("nightarrow", "→"), ("ightarrow", "→"), ("arrow", "→"), ("narrow", "narrow"), ("times", "×"), ("&Gt;", ">"), (r"\text\{\textbraceleft\}", "{"), (r"\text\{\textbraceright\}", "}"))),
)
SIGNS = tuple((g.replace("\\circ", "x\\circ"), w.replace("◯", "x◯")) for g, w in SIGNS)
#: Units; the space before them goes.
UNITS = (
    *((rf"@ \text{{{name}}}", f"@{unit}") for name, unit in (
        ("kg/cm", "kg/cm"), ("Kg/cm", "kg/cm"), ("Kcal/m", "kcal/m"), ("Gcal", "Gcal"), ("mm", "mm"), ("KW", "KW"), ("m/s", "m/s"), ("m", "m"), ("kg", "kg"), ("kg/t-p", "kg/t-p"), ("kg/T-P", "kg/t-p"), ("g/1000", "g/1000"),
        ("C/Hr", "C/Hr"), ("m/sec", "m/sec"), ("sec", "sec"), ("min", "min"), ("min/day", "min/day"), ("h", "h"), ("Hr", "Hr"), ("kg/t", "kg/t"), ("T/D", "T/D"), ("cal/mol", "cal/mol"), ("kcal/g", "kcal/g"), ("mol", "mol"),
        ("min/Hr", "min/Hr"), ("Ton", "Ton"), ("ton", "Ton"), ("cm", "cm"), ("T-P", "T-P"), ("Ton-Slag", "Ton-Slag"), ("N m", "Nm"), ("mmAq", "mmAq"), ("Max", "Max"), ("ton-pig", "ton-pig"), ("kcal", "kcal"), ("g", "g"),
    )),
    *((rf"@ \text{{{name}}} ^ {power}", f"@{unit}") for name, power, unit in (
        ("m", 3, "m³"), ("T/D/m", 3, "T/D/m³"), ("m", 2, "m²"), ("cm", 2, "cm²"), ("kg/cm", 2, "kg/cm²"), ("g/Nm", 3, "g/Nm³"), ("g/cm", 2, "g/cm²"), ("Kcal/m", 2, "kcal/m²"), ("Nm", 3, "Nm³"), ("N m", 3, "Nm³"), ("Nm", 2, "Nm²"), ("N m", 2, "Nm²"),
    )),
    (r"@ \text{m}^3", "@m³"),
    (r"@ m^ 3", "@m³"),
    (r"@ g/cm^ 2", "@g/cm²"),
    (r"@ \text{ } b", "@b"),
    (r"@ \mu\text{m}", "@ μm"),
    (r"@ \text{kg}/\text{t-p}", "@kg/t-p"),
    (r"@ \mathrm{cm} ^ {2}", "@cm²"),
    *((rf"@ \mathrm{{{name}}}", f"@{unit}") for name, unit in (("Kg", "kg"), ("mm", "mm"), ("O", "O"), ("cm", "cm"))),
    ("@&lt;1", "@<1"),
)


def _nth(cases, key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in cases]), (F.pmod(key, F.lit(len(cases))) + 1).cast("int"))


def _nth_sql(cases, key: str) -> str:
    shown = ", ".join("'" + c.replace("'", "''") + "'" for c in cases)
    return f"([{shown}])[CAST({key} % {len(cases)} + 1 AS BIGINT)]"


def _formulas(name: str, pairs) -> None:
    def run(spark, sf_dir) -> DataFrame:
        given = F.replace(_nth([g for g, _ in pairs], F.col("p_partkey")), F.lit("@"), (F.col("p_size") % 10).cast("string"))
        return dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", documents.plain_math(given).alias("said"))

    QUERIES[name] = run
    ORACLES[name] = f"""SELECT p_partkey, replace(replace(replace(said, '@', d), '⌄', translate(d, '0123456789', '{_LOW}')), '⌃', translate(d, '0123456789', '{_HIGH}')) AS said
        FROM (SELECT p_partkey, (p_size % 10)::VARCHAR AS d, {_nth_sql([w for _, w in pairs], 'p_partkey')} AS said FROM part)"""


_formulas("formula_rules", FORMULAS)
_formulas("formula_signs", SIGNS)
_formulas("formula_units", UNITS)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '<p>see x_' || d || '</p>' || chr(10) || CASE WHEN p_size <= 30 THEN '## 4.' || p_size || ' r' || chr(10) ELSE '' END
    ELSE '<p>see x' || translate(d, '0123456789', '{_LOW}') || '</p>' || chr(10) END || '<math display="block">4.' || p_size || ' r = 1</math>' AS said FROM (SELECT *, (p_size % 10)::VARCHAR AS d FROM part)""")
def formula_headings(spark, sf_dir):
    text = F.concat(F.lit("<p>see <math>x_"), (F.col("p_size") % 10).cast("string"), F.lit('</math></p>\n<math display="block">4.'), _s("p_size"), F.lit(" r = 1</math>"))
    return dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", documents.outlined(text, F.col("p_partkey") % 2 == 0)["text"].alias("said"))


@query("""SELECT p_partkey, n, CASE n WHEN 1 THEN 'k > k: ' || p_name || ' (이미지: i' || p_size || ') | v > a: ' || p_size || ' | v: (이미지: x / y)' ELSE 'k > k: w' || p_size || ' | v > a: w' || p_size || ' | v: z' END AS said
    FROM part, (VALUES (1), (2)) t(n)""")
def table_spans(spark, sf_dir):
    cells = F.concat(F.lit("<tr><td>"), "p_name", F.lit('<img alt="i'), _s("p_size"), F.lit('"/></td><td> '), _s("p_size"), F.lit(' </td><td><img alt="x"/><img alt="y"/></td></tr><tr><td colspan="2">w'), _s("p_size"), F.lit("</td><td>z</td></tr>"))
    html = F.concat(F.lit('<table><tr><th>k</th><th colspan="2">v</th></tr><tr><th>k</th><th>a</th><th></th></tr>'), cells, F.lit("</table>"))
    flat = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", F.posexplode(documents.flattened(html)["rows"]).alias("k", "said"))
    return flat.select("p_partkey", (F.col("k") + 1).alias("n"), "said")


def _scanned(spark, sf_dir) -> DataFrame:
    """A document for each nation: a table of uneven rows, tables one after another (with a paragraph between in odd ones), a table without snapshot, a formula in two lines and a described figure."""
    even, name, k = F.col("n_nationkey") % 2 == 0, F.col("n_name"), _s("n_nationkey")
    text = F.concat(
        F.lit("<!-- 페이지번호: "), (F.col("n_nationkey") + 1).cast("string"), F.lit(", 파일명: TP-030-0"), F.when(even, "30-100").otherwise("10-020"), F.lit(" F -->\n# 1 "), name,
        F.lit('\n<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table><p><a href="components/u.png">Table snapshot</a></p>\n<table><tr><td>'), k,
        F.lit("</td></tr></table>"), F.when(even, "").otherwise("<p>between</p>"), F.lit('<table><tr><td>y</td></tr></table><p><a href="components/s.png">TABLE SNAPSHOT</a></p>\n'),
        F.lit('<table><tr><td><img src="q.png" alt="q"/></td></tr></table>\nplain\n## 1.1 eq\n<p><math display="block">x = '), k,
        F.lit('\n+ 1</math></p><img alt="Equation-Block snippet" src="f.png"/>\n<p>desc <b>x</b></p><ul class="c"><li>a <i>b</i></li></ul><img alt="Figure snippet" src="g.png"/>\n'),
    )
    return documents.extracted(table(spark, sf_dir, "nation").select(name.alias("doc_key"), F.lit("d").alias("folder"), text.alias("text")))


@query("""SELECT n_name AS doc_key, id, split, n_nationkey + 1 AS page, '1 ' || n_name || CASE WHEN split LIKE 'images%' THEN ' / 1.1 eq' ELSE '' END AS section_path, 'output/sanitize/d/' || link AS image_link,
    id <> 'TB_STR_001' OR n_nationkey % 2 = 0 AS substituted, CASE id WHEN 'TB_STR_001' THEN 'col1: ' || n_nationkey WHEN 'IMG_SUM_001' THEN 'x = ' || n_nationkey || chr(10) || '+ 1' WHEN 'IMG_SUM_002' THEN 'desc <b>x</b><ul><li>a b</li></ul>' ELSE '' END AS said
    FROM nation, (VALUES ('TB_STR_001', 'tables_str', 'components/s.png'), ('TB_UNSTR_001', 'tables_unstr', 'components/u.png'), ('IMG_SUM_001', 'images_formula', 'f.png'), ('IMG_SUM_002', 'images_sum', 'g.png')) v(id, split, link)""")
def component_rows(spark, sf_dir):
    said = F.coalesce("description", F.array_join("row_flatten", "+"))
    return documents.components(_scanned(spark, sf_dir)).select("doc_key", "id", "split", F.col("page").cast("long").alias("page"), "section_path", "image_link", "substituted", said.alias("said"))


@query("SELECT n_name AS doc_key, n_nationkey % 2 = 0 AS special, CASE WHEN n_nationkey % 2 = 0 THEN 'COMPLEX_TABLE' ELSE '' END AS names, n_nationkey % 2 = 0 AS stands FROM nation")
def image_tables(spark, sf_dir):
    found = _scanned(spark, sf_dir)
    return found.select("doc_key", (F.size("special") > 0).alias("special"), F.array_join("special.placeholder", ",").alias("names"), F.col("text").contains("{{COMPLEX_TABLE}}").alias("stands"))


@query("""SELECT conv_id, turn, role || ' x' || repeat(chr(10), 2) || 'a b' || repeat(chr(10), 2) || 'T ' || turn || repeat(chr(10), 2) || 'tail' || repeat(chr(10), 2) || 'end' || chr(10) || '<!-- note -->' || repeat(chr(10), 2) || '● i j' || chr(10) || '  A. j' AS said FROM conversations""")
def html_reading(spark, sf_dir):
    html = F.concat(F.lit("<p>"), "role", F.lit(" <b>x</b></p><section> a \n b </section><h2>T "), _s("turn"), F.lit('</h2><hr/><span>tail</span><br/>end<!-- note --><ul><li>i<ol type="A"><li>j</li></ol></li></ul>'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", documents.readable(html).alias("said"))


@query("""SELECT n_name AS doc_key, strict, id, replace(path, '@', n_name) AS section_path, replace(replace(said, '@', n_name), '~', chr(10)) AS said FROM nation, (VALUES
    (true, 'TEXT_001', '1 @', '# 1 @~x'), (true, 'TEXT_002', '1 @ / 1.1 a', '## 1.1 a~y~## note~z'), (true, 'TEXT_003', '1 @ / 1.1 a / 1.1.2 b', '### 1.1.2 b~w'), (true, 'TEXT_004', '3.1 c', '## 3.1 c~v'),
    (false, 'TEXT_001', '1 @', '# 1 @~x'), (false, 'TEXT_002', '1 @ / note', '## 1.1 a~y~## note~z'), (false, 'TEXT_003', '1 @ / note / 1.1.2 b', '### 1.1.2 b~w'), (false, 'TEXT_004', '1 @ / 3.1 c', '## 3.1 c~v')) v(strict, id, path, said)""")
def chunk_strict(spark, sf_dir):
    text = F.concat(F.lit("# 1 "), "n_name", F.lit("\nx\n## 1.1 a\ny\n## note\nz\n### 1.1.2 b\nw\n## 3.1 c\nv"))
    docs = table(spark, sf_dir, "nation").select(F.col("n_name").alias("doc_key"), text.alias("text"))
    both = [documents.chunked(docs, strict).withColumn("strict", F.lit(strict)) for strict in (True, False)]
    return both[0].unionByName(both[1]).select("doc_key", "strict", "id", "section_path", F.col("text").alias("said"))


def _parts(spark, sf_dir, split: Column, **more: Column) -> DataFrame:
    """Components made of parts, with the columns of components()."""
    empty = {"filename": "string", "section_path": "string", "image_link": "string", "row_flatten": "array<string>", "table_html": "string", "full_html": "string", "description": "string"}
    given = {"id": F.lit("X_001")} | {c: F.lit(None).cast(kind) for c, kind in empty.items()} | more
    return table(spark, sf_dir, "part").select(_s("p_partkey").alias("doc_key"), "p_partkey", "p_size", "p_name", split.alias("split"), *[c.alias(n) for n, c in given.items()])


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'protected_term' WHEN p_partkey % 2 = 0 AND p_size % 3 = 0 THEN 'digit_ratio' END AS skip_reason, CASE WHEN p_size % 3 = 0 THEN 0.5 ELSE 0.25 END::DOUBLE AS digit_share FROM part""")
def skipped_reasons(spark, sf_dir):
    rows = F.array("p_name", F.when(F.col("p_size") % 10 == 0, "품질 영향\n인자 x").otherwise("x"))
    html = F.concat(F.lit("<table><tr><td>"), _s("p_size"), F.lit("</td><td>"), F.when(F.col("p_size") % 3 == 0, " 1,0 00 ").otherwise("a"), F.lit("</td><td></td><td>b</td><td>"), F.when(F.col("p_size") % 10 == 5, "공정영향인자").otherwise("c"), F.lit("</td></tr></table>"))
    judged = enrich.judged_tables(_parts(spark, sf_dir, F.when(F.col("p_partkey") % 2 == 0, "tables_str").otherwise("tables_unstr"), row_flatten=rows, table_html=html))
    return judged.select("p_partkey", "skip_reason", F.col("digit_only_ratio").alias("digit_share"))


@query("""SELECT p_partkey, family, CASE family WHEN 'images_sum' THEN '{"image_link":"' || link || '",' || around WHEN 'images_trans' THEN '{"description":"' || p_name || '","image_link":"' || link || '","section_path":""}'
      WHEN 'tables_str' THEN '{"row_flatten":["k: ' || p_name || '"],"filename":"f","image_link":"' || link || '",' || around ELSE '{"section_path":"","filename":"f","image_link":"' || link || '",' || around END AS input
    FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN '"context_before":"a b","context_after":"c ' || p_name || '"}' ELSE '"context_before":"","context_after":""}' END AS around FROM (
      SELECT p_partkey, p_size, p_name, (['images_sum', 'images_formula', 'images_trans', 'tables_str', 'tables_unstr'])[CAST(p_partkey % 5 + 1 AS BIGINT)] AS family, CASE WHEN p_size % 2 = 0 THEN 'out/d/components/i.png' ELSE 'out/d/i.png' END AS link FROM part))
    WHERE family <> 'images_formula'""")
def payload_rows(spark, sf_dir):
    family = _nth(("images_sum", "images_formula", "images_trans", "tables_str", "tables_unstr"), F.col("p_partkey"))
    link = F.when(F.col("p_size") % 2 == 0, "out/d/components/i.png").otherwise("out/d/i.png")
    parts = _parts(spark, sf_dir, family, filename=F.lit("f"), image_link=link, row_flatten=F.when(family == "tables_str", F.array(F.concat(F.lit("k: "), "p_name"))), description=F.col("p_name"), table_html=F.lit("<table><tr><td>t</td></tr></table>"))
    texts = parts.select("doc_key", F.concat(F.lit("a <!-- {{X_001}} -->b {{X_001}} c "), "p_name").alias("text"))
    return enrich.payloads(parts, texts).select(F.col("doc_key").cast("long").alias("p_partkey"), "family", "input")


_TRIES = ("@", "a b c d e @", "x₂ @", "ж @", "@ long enough for an image that has been described well, as it says", "漢 @", "a b c d 5 @ long enough for an image that has been described well, as it says")


@query(f"""SELECT p_partkey, bad OR length(trim(s)) < 60 AS summary_again, bad AS translation_again FROM (SELECT p_partkey, s, regexp_matches(s, '(?:[A-Za-z가-힣]\\s+){{4,}}[A-Za-z가-힣]') OR regexp_matches(s, '[\\x{{2070}}-\\x{{209F}}\\x{{4e00}}-\\x{{9fff}}А-Яа-яЁё\\x{{0600}}-\\x{{06FF}}]') AS bad
    FROM (SELECT p_partkey, replace({_nth_sql(_TRIES, 'p_partkey')}, '@', p_name) AS s FROM part))""")
def weak_answers(spark, sf_dir):
    said = F.replace(_nth(_TRIES, F.col("p_partkey")), F.lit("@"), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", tx.needs_another_try(said, "images_sum").alias("summary_again"), tx.needs_another_try(said, "images_trans").alias("translation_again"))


@query("""SELECT p_partkey, id, component_type, said FROM (SELECT p_partkey, p_size, p_name, CASE WHEN p_partkey % 2 = 0 THEN '[문서: F] [경로: 1 s] ' ELSE '' END AS b, p_partkey % 7 <> 0 AS shown FROM part), LATERAL (
      SELECT 'X_001' AS id, NULL AS component_type, CASE WHEN b = '' THEN p_name || chr(10) || 'size: ' || p_size ELSE b || '[''' || p_name || ''', ''size: ' || p_size || ''']' END AS said
      UNION ALL SELECT 'X_001#1', 'table_row', b || p_name UNION ALL SELECT 'X_001#2', 'table_row', b || 'size: ' || p_size
      UNION ALL SELECT 'X_001#summary', 'table_summary', b || 'last ' || p_size || '.end.' WHERE p_partkey % 3 = 0) WHERE shown""")
def final_tables(spark, sf_dir):
    known = F.col("p_partkey") % 2 == 0
    rows = F.array("p_name", F.concat(F.when(F.col("p_partkey") % 7 == 0, "품질영향 인자 ").otherwise(""), F.lit("size: "), _s("p_size")))
    parts = _parts(spark, sf_dir, F.lit("tables_str"), filename=F.when(known, "TP-030-010-020 F (Rev.1).md"), section_path=F.when(known, "1 s"), row_flatten=rows).withColumn("component_type", F.lit(None).cast("string"))
    answers = parts.where("p_partkey % 3 < 2").select("doc_key", "id", F.lit("tables_str").alias("family"), F.explode(F.array(F.lit(2), F.lit(1))).alias("ord"), "p_partkey", "p_size")
    last = F.array(F.concat(F.lit("last "), _s("p_size"), F.lit(".")), F.lit("end."))
    said = F.when(F.col("p_partkey") % 3 == 1, F.array(F.lit("漢字漢字漢字漢字"))).when(F.col("ord") == 2, last).otherwise(F.array(F.lit("first.")))
    done = finalize.structured(parts, finalize.last_summaries(answers.withColumn("summary", said), "tables_str"))
    return done.select(F.col("doc_key").cast("long").alias("p_partkey"), "id", "component_type", F.col("text").alias("said"))


@query("""SELECT p_partkey, record_type, said FROM (SELECT p_partkey, 'table_unstr' AS record_type, CASE p_partkey % 4 WHEN 0 THEN 's ' || p_size WHEN 1 THEN '<table>' || p_size || '</table>' ELSE 'No Description' END AS said FROM part
    UNION ALL SELECT p_partkey, 'image_formula', CASE p_partkey % 3 WHEN 0 THEN p_name ELSE 'No Description' END FROM part)""")
def final_fallbacks(spark, sf_dir):
    turn = F.col("p_partkey") % 4
    html = F.when(turn < 2, F.concat(F.lit("<table>"), _s("p_size"), F.lit("</table>"))).when(turn == 2, "")
    parts = _parts(spark, sf_dir, F.lit("tables_unstr"), full_html=html)
    answers = parts.where("p_partkey % 4 != 2").select("doc_key", "id", F.lit("tables_unstr").alias("family"), F.when(F.col("p_partkey") % 4 == 0, F.array(F.concat(F.lit(" s "), _s("p_size")))).otherwise(F.array(F.lit("  "))).alias("summary"))
    images = _parts(spark, sf_dir, F.lit("images_formula"), description=F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, ""))
    done = finalize.unstructured(parts, finalize.last_summaries(answers, "tables_unstr")).unionByName(finalize.formulas(images))
    return done.select(F.col("doc_key").cast("long").alias("p_partkey"), "record_type", F.col("text").alias("said"))


@query("""SELECT p_partkey, family, CASE p_partkey % 5 WHEN 0 THEN 'own ' || p_size WHEN 1 THEN 'bare ' || p_size WHEN 3 THEN CASE family WHEN 'image_trans' THEN p_name ELSE '漢字漢字漢字漢字' END END AS said
    FROM part, (VALUES ('image_sum'), ('image_trans')) v(family) WHERE p_partkey % 5 IN (0, 1, 3)""")
def final_images(spark, sf_dir):
    turn, size, done = F.col("p_partkey") % 5, _s("p_size"), []
    for family in ("images_sum", "images_trans"):
        parts = _parts(spark, sf_dir, F.lit(family), image_link=F.lit("a/components/i.png"), description=F.col("p_name"))
        named = lambda link, said: parts.select("doc_key", "id", F.lit(family).alias("family"), link.alias("image_link"), said.alias("summary"), "p_partkey")  # noqa: B023, E731
        own = named(F.when(turn == 2, "another.png").otherwise(F.lit("a/components/i.png")), F.array(F.when(turn == 0, F.concat(F.lit("own "), size)).when(turn == 3, "漢字漢字漢字漢字").otherwise(" "))).where("p_partkey % 5 != 1")
        bare = named(F.when(turn == 0, "").otherwise(F.lit(None).cast("string")), F.array(F.lit("bare "), size)).where("p_partkey % 5 < 2")
        done.append(finalize.images(parts, own.unionByName(bare), family))
    return done[0].unionByName(done[1]).select(F.col("doc_key").cast("long").alias("p_partkey"), F.col("record_type").alias("family"), F.col("text").alias("said"))


@query("""SELECT p_partkey, 'S' || repeat(chr(10), 2) || '질문: ' || p_name || repeat(chr(10), 2) || '답은 다섯 문장을 넘기지 말고, 주어진 자료에 없으면 없다고 밝혀라.' || repeat(chr(10), 2) || CASE WHEN p_partkey % 3 = 0 THEN '(컨텍스트 없음)' ELSE '[컨텍스트 1] 종류: text | 파일: y.json' || chr(10) || 't' || p_size || repeat(chr(10), 2) || '[컨텍스트 2] ' || chr(10) || 'u' END AS prompt,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '[1] type=text | file=y.json | score=' || p_size || '.2500' || chr(10) || 't' || p_size || repeat(chr(10), 2) || '[2] score=0.5000' || chr(10) || 'u' END AS evidence FROM part""")
def question_prompts(spark, sf_dir):
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("qid"), F.col("p_name").alias("question"), "p_size")
    none = F.lit(None).cast("string")
    held = lambda rank, kind, file, score, text: F.struct(F.lit(rank).alias("rank"), kind.alias("record_type"), file.alias("source_file"), score.cast("double").alias("score"), text.alias("text"))
    both = F.array(held(2, none, F.lit(""), F.lit(0.5), F.lit("u")), held(1, F.lit("text"), F.lit("x/y.json"), F.col("p_size") + 0.25, F.concat(F.lit("t"), _s("p_size"))))
    contexts = asked.where("qid % 3 != 0").select(_s("qid").alias("qid"), F.explode(both).alias("c")).select("qid", "c.*")
    return qa.prompts(asked.select("qid", "question"), contexts, "S").select(F.col("qid").cast("long").alias("p_partkey"), "prompt", "evidence")



@query("""SELECT p_partkey, CASE WHEN wide THEN 0 ELSE greatest(0, x0 - 15) END AS x0, greatest(0, y0 - 45) AS y0, CASE WHEN wide THEN w ELSE least(w, x1 + 15) END AS x1, least(900, y1 + 15) AS y1 FROM (
    SELECT p_partkey, p_partkey % 5 = 0 AS wide, w, greatest(0, trunc(b[1] * w / 1024)::BIGINT) AS x0, greatest(0, trunc(b[2] * 900 / 1024)::BIGINT) AS y0, least(w, trunc(b[3] * w / 1024)::BIGINT) AS x1, least(900, trunc(b[4] * 900 / 1024)::BIGINT) AS y1 FROM (
      SELECT p_partkey, p_size * 20 + 100 AS w, CASE WHEN p_partkey % 4 = 3 THEN [0, 0, 1, 1] WHEN p_partkey % 4 = 2 THEN [-5.5, p_size, 1e12, 2000] ELSE [p_size * 7.5, p_size, 600.25 + p_size, 700] END::DOUBLE[] AS b FROM part))""")
def page_boxes(spark, sf_dir):
    size = _s("p_size")
    raw = F.when(F.col("p_partkey") % 8 == 3, "[1, 2").when(F.col("p_partkey") % 8 == 7, "[1, 2, 3]").when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("[-5.5, "), size, F.lit(", 1e12, 2000]")))
    raw = raw.otherwise(F.concat(F.lit("["), (F.col("p_size") * 7.5).cast("string"), F.lit(", "), size, F.lit(", "), (F.col("p_size") + 600.25).cast("string"), F.lit(", 700]")))
    stem = F.when(F.col("p_partkey") % 5 == 0, "TP-030-010-030 x").otherwise("TP-030-010-031 x")
    html = F.concat(F.lit('<div data-label="Figure" data-bbox="'), raw, F.lit('">cap</div>'))
    pages = dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select(_s("p_partkey").alias("doc_key"), stem.alias("stem"), F.lit(1).alias("page"), html.alias("html"), (F.col("p_size") * 20 + 100).cast("int").alias("width"), F.lit(900).alias("height"))
    boxes = ocr.assembled_pages(pages).select(F.col("doc_key").cast("long").alias("p_partkey"), F.explode("assets.bbox").alias("b"))
    return boxes.select("p_partkey", *[F.element_at("b", k + 1).cast("long").alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))])


@query("""SELECT n_name AS doc_key, '<h2>Page 1</h2>' || chr(10) || '<p>' || n_name || '</p>' || repeat(chr(10), 2) || '<b>t</b>' || repeat(chr(10), 2) || 'cap<img src="components/S_p001_block_04.png" alt="Figure snippet"/>' || repeat(chr(10), 2)
      || '<table><tr><td>' || n_nationkey || '</td></tr></table><p><a href="components/S_p001_table_01.png">Table snapshot</a></p>' || repeat(chr(10), 2) || '<hr/>' || repeat(chr(10), 2)
      || '<h2>Page 2</h2>' || chr(10) || '<math display="block">x</math><img src="components/S_p002_block_01.png" alt="Text snippet"/>' AS said FROM nation""")
def ocr_documents(spark, sf_dir):
    first = F.concat(F.lit('<div data-label="Page-Header">gone</div><div data-label="Text">'), "n_name", F.lit('</div><div data-label="Title"><b>t</b></div><div data-label="Figure">cap</div><div data-label="Table"><table><tr><td>'), _s("n_nationkey"), F.lit("</td></tr></table></div>"))
    pages = F.array(F.struct(F.lit(2).alias("page"), F.lit('<div data-label="Text"><math display="block">x</math></div>').alias("html")), F.struct(F.lit(1).alias("page"), first.alias("html")))
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("doc_key"), F.lit("S").alias("stem"), F.explode(pages).alias("p")).select("doc_key", "stem", "p.*", F.lit(100).alias("width"), F.lit(100).alias("height"))
    return ocr.assembled_documents(ocr.assembled_pages(rows)).select("doc_key", F.col("text").alias("said"))


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def files_not_done(spark, sf_dir):
    keyed = lambda name: table(spark, sf_dir, name).select(_s("doc_id").alias("doc_key"))
    return ocr.without_done(keyed("documents"), keyed("labels")).select(F.col("doc_key").cast("long").alias("doc_id"))


@query("""SELECT conv_id AS point_id, turn, said FROM (SELECT conv_id, turn, 'new ' || role AS said FROM conversations WHERE conv_id % 2 = 0 UNION ALL SELECT conv_id, turn, 'old ' || role FROM conversations WHERE conv_id % 2 = 1 AND turn = 0)
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""")
def upsert_points(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("point_id"), "turn", "role")
    stored = said.where("turn = 0").select("point_id", "turn", F.concat(F.lit("old "), "role").alias("said"))
    new = said.where("point_id % 2 = 0").select("point_id", "turn", F.concat(F.lit("new "), "role").alias("said"), F.col("turn").alias("ord"))
    return vectors.upserted(stored, new).select("point_id", "turn", "said")


@query("SELECT n_name AS doc_key, split, CASE split WHEN 'texts' THEN 2 ELSE 1 END AS n FROM nation, (VALUES ('tables_str'), ('tables_unstr'), ('images_formula'), ('images_sum'), ('texts')) v(split)")
def split_rows(spark, sf_dir):
    found = _scanned(spark, sf_dir)
    texts = documents.chunked(found.select("doc_key", documents.cleaned(F.col("text")).alias("text")))
    return documents.with_texts(documents.components(found), texts).groupBy("doc_key", "split").agg(F.count(F.lit(1)).alias("n"))
