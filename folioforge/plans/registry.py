"""The named queries over the engine's operators, and the SQL that each must agree with.

The tables have no scanned documents, so markup is made from rows inside of a query; the SQL computes what must come out without that detour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.functions.arrow import bounded_batches
from folioforge.operators import documents, enrich, finalize, graph_index, qa, vectors
from folioforge.sources import external, files, splitting
from folioforge.streaming.point_store import PointStore

QUERIES: dict = {}
ORACLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to all tasks before a Python stage: a small file, or a shuffle of few bytes, is a task or two otherwise, however many rows it has."""
    context = df.sparkSession.sparkContext
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir, "cosine", "vec_id < 10")


def _nearest(spark: SparkSession, sf_dir: str, distance: str, asking: str = "vec_id % 20 = 0") -> DataFrame:
    points = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = points.where(asking).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))
    return vectors.top_k(asked, points, 5, distance, decimals=12).select("qid", F.col("rank").cast("long").alias("rank"), "id")


_NEAREST = """
    SELECT qid, rank, id FROM (
      SELECT q.vec_id AS qid, p.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {score}, p.vec_id) AS rank
      FROM embeddings q JOIN embeddings p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 5"""
_A, _B = "q.embedding::DOUBLE[]", "p.embedding::DOUBLE[]"


@query(_NEAREST.format(score=f"round(list_cosine_similarity({_A}, {_B}), 12) DESC"))
def topk_cosine(spark, sf_dir):
    return _nearest(spark, sf_dir, "cosine")


@query(_NEAREST.format(score=f"round(list_dot_product({_A}, {_B}), 12) DESC"))
def topk_dot(spark, sf_dir):
    return _nearest(spark, sf_dir, "dot")


@query(_NEAREST.format(score=f"round(list_distance({_A}, {_B}), 12)"))
def topk_l2(spark, sf_dir):
    return _nearest(spark, sf_dir, "l2")


@query("SELECT vec_id AS qid, true AS found FROM embeddings WHERE vec_id % 20 = 0 AND embedding IS NOT NULL")
def graph_recall(spark, sf_dir):
    """Does a search of the graphs find, over all queries, nine in ten of the five nearest that the exact search finds?"""
    every = table(spark, sf_dir, "embeddings")
    asked = every.where("vec_id % 20 = 0 AND embedding IS NOT NULL").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))
    path = files.new_folder(spark, "graphs")
    graph_index.graph_index(every, part_rows=250).write.parquet(path)
    near = graph_index.search(spark.read.schema(graph_index.SHAPE).parquet(path), asked, 5, 40).select("qid", "id")
    exact = vectors.top_k(asked, every, 5).select("qid", "id")
    hits = exact.join(near.withColumn("hit", F.lit(1)), ["qid", "id"], "left").agg((F.sum("hit") >= 0.9 * F.count(F.lit(1))).alias("found"))
    return asked.select("qid").crossJoin(F.broadcast(hits))


@query("""
    SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point_id
    FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(lang || '||' || doc_id || '||' || source || '||||||')) AS h FROM documents)""")
def point_id_uuid5(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("record_type"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("filename"))
    none = F.lit(None).cast("string")
    rows = rows.select("*", none.alias("placeholder"), none.alias("image_link"), none.alias("section_path"), none.alias("page_repr"))
    return rows.select("doc_id", vectors.uuid5(vectors.point_key()).alias("point_id"))


@query("SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def upsert_latest(spark, sf_dir):
    return vectors.latest(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", "turn", "role", "text")


@query()
def upsert_store(spark, sf_dir):
    """Sales as they arrived, a month a batch (those without a time in the first one, early and late ones in the nearest), upserted by sale_id into a store that merges its runs; then each sale as it was last."""
    sales = table(spark, sf_dir, "sales")
    month = F.year("arrived_at") * 12 + F.month("arrived_at") - (2024 * 12 + 1)
    order = F.struct("arrived_at", *[c for c in sales.columns if c != "arrived_at"])
    rows = sales.withColumns({"point_id": F.col("sale_id").cast("string"), "ord": order, "batch": F.coalesce(F.greatest(F.lit(0), F.least(F.lit(4), month)), F.lit(0))})
    store = PointStore(spark, files.new_folder(spark, "sales"), fanout=3)
    for batch in range(5):
        store.append(rows.where(F.col("batch") == batch).drop("batch"), batch)
    return store.read().select(*sales.columns)


@query()
def upsert_external(spark, sf_dir):
    """Clients, then the changes of their city and balance, upserted into an external store a request of many points at a time; each client as it was last, by seq (of equal ones, and of repeated clients, by time, city and balance)."""
    shape = lambda seq, at: [F.col("client_id").cast("string").alias("point_id"), F.struct(seq.cast("long").alias("seq"), F.col(at).alias("at"), "city", "balance").alias("ord"), "city", "balance"]
    store = external.FolderStore(files.new_folder(spark, "clients"))
    for points in (table(spark, sf_dir, "clients").select(*shape(F.lit(0), "updated_at")), table(spark, sf_dir, "client_changes").select(*shape(F.col("seq"), "valid_at"))):
        external.write_points(points, store, request=4096)
    return store.read(spark).select(F.col("point_id").cast("long").alias("client_id"), "city", "balance")


@query()
def array_files(spark, sf_dir):
    """Items, exported as one JSON array and read again by many tasks: item_id, name, brand, kind, size and price by place."""
    items = table(spark, sf_dir, "items").select("item_id", "name", "brand", "kind", "size", "price")
    path = files.new_folder(spark, "items")
    files.export_json(items, path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return splitting.array_records(spark, path, schema)[0].drop("path", "ord")


@query(r"""
    SELECT doc_id, CASE WHEN p > 1 THEN array_to_string(t[greatest(p - 15, 1):p - 1], ' ') ELSE '' END AS said_before, array_to_string(t[p + 1:p + 15], ' ') AS said_after
    FROM (SELECT doc_id, t, list_position(t, '{{IMG_SUM_001}}') AS p FROM (
      SELECT doc_id, list_filter(string_split_regex(text || ' {{IMG_SUM_001}} ' || text, '[ \t\n\r\f\v]+'), lambda x: x <> '') AS t FROM documents))""")
def context_window(spark, sf_dir):
    said = F.concat("text", F.lit(" <!-- page --> {{IMG_SUM_001}} "), "text")
    window = tx.context_window(said, F.lit("IMG_SUM_001"), enrich.IMAGE_WINDOW)
    return table(spark, sf_dir, "documents").select("doc_id", window.alias("w")).select("doc_id", F.col("w.before").alias("said_before"), F.col("w.after").alias("said_after"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) AS said FROM documents")
def ws_normalize(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.collapsed(F.col("text")).alias("said"))


@query(r"SELECT conv_id, turn, rtrim(text, chr(10)) || chr(10) || '끝말' AS said FROM conversations")
def noise_lines(spark, sf_dir):
    text = F.concat(F.lit("이하 여백\n- 끝 -\n"), F.rtrim(F.col("text"), F.lit("\n")), F.lit("\n뒷장  계속\n끝말\n"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.without_noise(text).alias("said"))


@query(r"""SELECT conv_id, turn, 'before' || chr(10) || '<!-- 페이지번호: 2, 파일명: f -->' || chr(10) || '# 3 kept ' || role || chr(10) || 'turn ' || turn AS said FROM conversations""")
def section_drop(spark, sf_dir):
    text = F.concat(F.lit("before\n# 1 목적\n해당 사항\n없음\n<!-- 페이지번호: 2, 파일명: f -->\n## 2 해당없음\nbody\n# 3 kept "), "role", F.lit("\nturn "), F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.without_empty_sections(text).alias("said"))


@query(r"""
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS n, said FROM (
      SELECT doc_id, k, regexp_replace(regexp_replace(substr(text, CAST(k * 150 + 1 AS BIGINT), 200), '^[ \t\n\r\f\v]+', ''), '[ \t\n\r\f\v]+$', '') AS said
      FROM (SELECT doc_id, text, unnest(generate_series(0, CAST(ceil(greatest(length(text) - 200, 0) / 150.0) AS BIGINT))) AS k FROM documents WHERE length(text) > 0)) WHERE said <> ''""")
def chunk_fixed(spark, sf_dir):
    bounded_batches(spark)
    cut = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(documents.windows("text", F.lit(200), F.lit(50))).alias("k", "said"))
    return cut.select("doc_id", (F.col("k") + 1).cast("long").alias("n"), "said")


@query()
def chunk_placeholder(spark, sf_dir):
    bounded_batches(spark)
    text = F.regexp_replace("text", r"\. ", ". {{IMG_SUM_001}} ")
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(documents.windows(text, F.lit(60), F.lit(30))).alias("k", "said"))


def _nation_tables(spark, sf_dir) -> DataFrame:
    """A table of nations for each region, as HTML."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    row = F.concat(F.lit("<tr><td>"), F.col("n_nationkey").cast("string"), F.lit("</td><td>"), "n_name", F.lit("</td></tr>"))
    rows = nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    html = F.concat(F.lit('<table><tr><th rowspan="1">key</th><th>name</th></tr>'), "rows", F.lit("</table>"))
    return region.join(rows, "r_regionkey").select("r_regionkey", "r_name", html.alias("html"))


@query("""SELECT r_name, structured, n, said FROM (
    SELECT r_name, true AS structured, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS n, 'key: ' || n_nationkey || ' | name: ' || n_name AS said FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def table_flatten(spark, sf_dir):
    flat = _nation_tables(spark, sf_dir).select("r_name", documents.flattened("html").alias("t")).select("r_name", "t.structured", F.posexplode("t.rows").alias("k", "said"))
    return flat.select("r_name", "structured", (F.col("k") + 1).cast("long").alias("n"), "said")


@query("""SELECT l_orderkey, count(*) FILTER (l_quantity <= 25) + count(*) AS digits, 2 * count(*) AS cells, (count(*) FILTER (l_quantity <= 25) + count(*)) / (2.0 * count(*)) >= 0.8 AS skipped FROM lineitem GROUP BY l_orderkey""")
def digit_ratio_filter(spark, sf_dir):
    cell = F.when(F.col("l_quantity") <= 25, F.concat(F.col("l_quantity").cast("string"), F.lit(" %"))).otherwise(F.concat(F.lit("n"), F.col("l_quantity").cast("string")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("<tr><td>"), cell, F.lit("</td><td>1,000</td></tr>")).alias("row"))
    html = rows.groupBy("l_orderkey").agg(F.concat(F.lit("<table>"), F.array_join(F.collect_list("row"), ""), F.lit("</table>")).alias("table_html"))
    counted = enrich.numeric_share(dealt(html))
    return counted.select("l_orderkey", F.col("digit_only_cells").cast("long").alias("digits"), F.col("total_cells").cast("long").alias("cells"), (F.col("digit_only_ratio") >= tx.ratio(80)).alias("skipped"))


@query("SELECT p_partkey, '[(' || p_size || ')/([(a)/(' || p_partkey || ')])] √(√(x)) ×Δ' AS said FROM part")
def frac_sqrt_math(spark, sf_dir):
    tex = F.concat(F.lit("\\frac{"), F.col("p_size").cast("string"), F.lit("}{\\frac{a}{"), F.col("p_partkey").cast("string"), F.lit("}} \\sqrt{\\sqrt{x}} \\times\\Delta"))
    return dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", documents.plain_math(tex).alias("said"))


def _outlined(text: Column) -> Column:
    return documents.outlined(text, F.lit(False))["text"]


@query("SELECT doc_id, '<i>' || source || ' & ' || lang || '&lt;b> &amp;' || doc_id || '&#60; &' AS said FROM documents")
def entity_decode(spark, sf_dir):
    text = F.concat(F.lit("&lt;i&gt;"), "source", F.lit(" &amp; "), "lang", F.lit("&amp;lt;b&gt; &amp;amp;"), F.col("doc_id").cast("string"), F.lit("&#60; &"))
    return table(spark, sf_dir, "documents").select("doc_id", _outlined(text).alias("said"))


@query("SELECT p_partkey, p_name || translate(p_size::VARCHAR, '0123456789', '₀₁₂₃₄₅₆₇₈₉') || 'x⁻' || translate(p_partkey::VARCHAR, '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') || '+' AS said FROM part")
def sub_and_sup(spark, sf_dir):
    html = F.concat("p_name", F.lit("<sub> "), F.col("p_size").cast("string"), F.lit(" </sub>x<SUP>-"), F.col("p_partkey").cast("string"), F.lit("+</sup>"))
    return dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")).select("p_partkey", _outlined(html).alias("said"))


@query("""SELECT conv_id, k, CASE WHEN k % 3 = 1 THEN cur WHEN k % 3 = 2 THEN up || ' / ' || cur ELSE upper2 || ' / ' || up || ' / ' || cur END AS path FROM (
    SELECT conv_id, row_number() OVER w AS k, turn || ' ' || role AS cur, lag(turn || ' ' || role) OVER w AS up, lag(turn || ' ' || role, 2) OVER w AS upper2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""")
def section_path(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    line = lambda t, i: F.concat(F.repeat(F.lit("#"), (i % 3 + 1).cast("int")), F.lit(" "), t["turn"].cast("string"), F.lit(" "), t["role"], F.lit("\nsaid"))
    docs = turns.select(F.col("conv_id").cast("string").alias("doc_key"), F.array_join(F.transform("turns", line), "\n").alias("text"))
    return documents.chunked(docs).select(F.col("doc_key").cast("long").alias("conv_id"), F.col("ord").cast("long").alias("k"), F.col("section_path").alias("path"))


@query("SELECT r_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS n, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) || '. ' || n_name AS said FROM nation JOIN region ON n_regionkey = r_regionkey")
def list_render(spark, sf_dir):
    item = F.concat(F.lit("<li> "), "n_name", F.lit("</li>"))
    lists = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", item.alias("i")))), lambda x: x["i"]), "\n").alias("items"))
    rows = table(spark, sf_dir, "region").join(lists, "r_regionkey").select("r_name", F.posexplode(documents.list_lines(F.concat(F.lit("<ol>"), "items", F.lit("</ol>")))).alias("k", "said"))
    return rows.select("r_name", (F.col("k") + 1).cast("long").alias("n"), "said")


@query()
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", documents.cleaned(F.col("html")).alias("said"))


@query("""SELECT p_partkey, 'see ' || CASE WHEN s_name IS NULL THEN '[이미지 있음]' ELSE '[이미지 참고] ' || s_name END || ' and {{T#1}}' AS said FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""")
def placeholder_resolve(spark, sf_dir):
    key = lambda c: F.concat(F.lit("IMG_TR_"), F.col(c).cast("string"))
    link = F.create_map(key("p_partkey"), F.lit("")).alias("placeholders")
    contexts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("qid"), F.lit(1).alias("rank"), F.concat(F.lit("see {{"), key("p_partkey"), F.lit("}} and {{T#1}}")).alias("text"), link)
    none = F.lit(None).cast("string")
    points = table(spark, sf_dir, "supplier").select(key("s_suppkey").alias("id"), none.alias("image_link"), F.col("s_name").alias("point_id"), F.lit("image_trans").alias("record_type"), none.alias("component_type"), F.col("s_name").alias("original"), F.lit(None).cast("array<string>").alias("original_rows"), none.alias("text"))
    return qa.resolved(contexts, points).select(F.col("qid").cast("long").alias("p_partkey"), F.col("text").alias("said"))


def _nation_documents(spark, sf_dir) -> DataFrame:
    """A document for each region: headings, its table with a snapshot, a broken table, a formula and an image."""
    text = F.concat(
        F.lit("<!-- 페이지번호: 3, 파일명: TP-030-010-020 Region -->\n# 1 "), "r_name", F.lit("\n"), "html", F.lit('<p><a href="components/t.png">Table snapshot</a></p>\ntext after\n'),
        F.lit('<table><tr><td colspan="2">a</td></tr><tr><td>b</td></tr></table><p><a href="u.png">table Snapshot</a></p>\n## 1.1 more\n'),
        F.lit('<math display="block">x</math><img alt="Equation-Block snippet" src="f.png"/>\n<p>shown</p><img alt="Figure snippet" src="components/i.png"/>\n<img alt="a note" src="n.png"/>\nlast\n'),
    )
    return _nation_tables(spark, sf_dir).select(F.col("r_name").alias("doc_key"), F.lower("r_name").alias("folder"), text.alias("text"))


@query("""SELECT split, 5 AS n FROM (VALUES ('tables_str'), ('tables_unstr'), ('images_formula'), ('images_sum'), ('images_trans')) v(split)""")
def split_counts(spark, sf_dir):
    counts = documents.split_counts(documents.components(documents.extracted(_nation_documents(spark, sf_dir))))
    return counts.select("split", F.col("n").cast("int").alias("n"))


@query("""SELECT r_name AS doc_key, '<!-- 페이지번호: 3, 파일명: TP-030-010-020 Region -->' || chr(10) || '# 1 ' || r_name || chr(10) || '{{TB_STR_001}}' || chr(10) || 'text after' || chr(10) || '{{TB_UNSTR_001}}' || chr(10)
    || '## 1.1 more' || chr(10) || '{{IMG_SUM_001}}' || chr(10) || '{{IMG_SUM_002}}' || chr(10) || '{{IMG_TR_001}}last' || chr(10) AS said FROM region""")
def placeholder_text(spark, sf_dir):
    return documents.extracted(_nation_documents(spark, sf_dir)).select("doc_key", F.col("text").alias("said"))


@query("""SELECT doc_key, id, section_path, page_list, mentions FROM (
    SELECT r_name AS doc_key, 'TEXT_001' AS id, '1 ' || r_name AS section_path, '3' AS page_list, 'TB_STR_001=output/sanitize/' || lower(r_name) || '/components/t.png,TB_UNSTR_001=output/sanitize/' || lower(r_name) || '/u.png' AS mentions FROM region
    UNION ALL SELECT r_name, 'TEXT_002', '1 ' || r_name || ' / 1.1 more', '3', 'IMG_SUM_001=output/sanitize/' || lower(r_name) || '/f.png,IMG_SUM_002=output/sanitize/' || lower(r_name) || '/components/i.png,IMG_TR_001=output/sanitize/' || lower(r_name) || '/n.png' FROM region)""")
def chunk_by_heading(spark, sf_dir):
    found = documents.extracted(_nation_documents(spark, sf_dir))
    chunks = documents.chunked(found.select("doc_key", documents.cleaned(F.col("text")).alias("text")))
    texts = documents.with_placeholders(chunks, documents.components(found))
    said = F.array_join(F.sort_array(F.transform(F.map_entries("placeholders"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return texts.select("doc_key", "id", "section_path", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("page_list"), said.alias("mentions"))


@query("""SELECT doc_key, id, said FROM (
    SELECT r_name AS doc_key, 'TB_STR_001#' || row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS id, '[문서: Region] [경로: 1 ' || r_name || '] key: ' || n_nationkey || ' | name: ' || n_name AS said FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT r_name, 'TB_STR_001#summary', '[문서: Region] [경로: 1 ' || r_name || '] one.two.' FROM region)""")
def finalize_join(spark, sf_dir):
    parts = documents.components(documents.extracted(_nation_documents(spark, sf_dir)))
    results = parts.where("split = 'tables_str'").select("doc_key", F.col("split").alias("family"), "id", F.array(F.lit("one."), F.lit("two.")).alias("summary"))
    done = finalize.structured(parts, finalize.last_summaries(results, "tables_str"))
    return done.where("id != 'TB_STR_001'").select("doc_key", "id", F.col("text").alias("said"))


@query(r"""SELECT doc_id, n, said FROM (SELECT doc_id, unnest(generate_series(1, len(s))) AS n, unnest(s) AS said FROM (
    SELECT doc_id, list_filter(string_split(text, '. '), lambda x: trim(x, chr(10) || chr(9) || chr(13) || chr(11) || chr(12) || ' ') <> ''
      AND NOT regexp_matches(x, '[\x{4e00}-\x{9fff}\x{0400}-\x{04FF}\x{0600}-\x{06FF}\x{2070}-\x{209F}]') AND NOT regexp_matches(x, '(?:[A-Za-z가-힣]\s+){4,}[A-Za-z가-힣]')) AS s FROM documents))""")
def sentence_filter(spark, sf_dir):
    kept = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.good_sentences(F.split("text", r"\. "))).alias("k", "said"))
    return kept.select("doc_id", (F.col("k") + 1).cast("long").alias("n"), "said")


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN source WHEN 2 THEN '' ELSE '' END AS said, doc_id % 4 = 0 AS ok,
    CASE doc_id % 4 WHEN 0 THEN NULL ELSE 'invalid_output' END AS reason FROM documents""")
def template_conform(spark, sf_dir):
    turn = F.col("doc_id") % 4
    raw = F.when(turn == 0, F.concat(F.lit('```json\n{" table_summary ": ["'), "source", F.lit('", "漢字", ], }\n```')))
    raw = raw.when(turn == 1, F.concat(F.lit('so: {"table_summary": "'), "source", F.lit('", "x": 1} done'))).when(turn == 2, F.lit('{"other": []}')).otherwise(F.lit("no json"))
    judged = enrich.validated(table(spark, sf_dir, "documents").select("doc_id", F.lit("tables_str").alias("family"), raw.alias("raw_response")))
    return judged.select("doc_id", F.array_join("summary", "+").alias("said"), "ok", "reason")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti(spark, sf_dir):
    named = lambda df: df.select(F.col("doc_id").cast("string").alias("doc_key"), F.lit("tables_str").alias("family"), F.lit("TB_STR_001").alias("id"))
    left = enrich.not_yet_answered(named(table(spark, sf_dir, "documents")), named(table(spark, sf_dir, "labels")))
    return left.select(F.col("doc_key").cast("long").alias("doc_id"))


@query("SELECT s_suppkey, 'TP-030-010-020 ' || s_name || ' v1' AS shown, s_name || ' v1' AS short FROM supplier")
def prefix_name(spark, sf_dir):
    name = F.concat(F.lit("in/TP-030-010-020  "), "s_name", F.lit(" v1 (Rev.2).md"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", tx.display_name(name).alias("shown"), tx.prefix_name(name).alias("short"))


@query("""SELECT o_orderkey, '<!-- 페이지번호: 1, 파일명: f -->' || chr(10) || '# 1. 적용범위' || chr(10) || '# 1 ' || o_orderstatus || chr(10) || '## 1.2 ' || o_orderpriority || chr(10) || '7. no' || chr(10) || '### 가. x' || chr(10) || 'ηCO H₂' AS said,
    ['1. 적용범위', '2. 목적', '3. 중점관리 항목', '4. 조업기준', '5. 이상판단 및 조치기준', '6. 기술이론'] AS missing FROM orders""")
def heading_levels(spark, sf_dir):
    text = F.concat(F.lit("lost<h2>Page 1</h2>\n<h1>1 "), "o_orderstatus", F.lit("</h1><p>1.2. "), "o_orderpriority", F.lit("</p>\n7. no\n가. x\nη_{CO} H<sub>2</sub>"))
    done = documents.sanitized(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_key"), F.lit("f.md").alias("filename"), text.alias("text")))
    return done.select(F.col("doc_key").alias("o_orderkey"), F.col("text").alias("said"), F.col("missing_titles").alias("missing"))
