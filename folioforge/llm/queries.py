"""The queries of this subpackage: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.best_fit import best_fit
from folioforge.llm.embedding_dedup import near_embeddings
from folioforge.llm.erasure import erase_masters
from folioforge.llm.exact_dedup import label_duplicates
from folioforge.llm.fill_middle import fill_digests
from folioforge.llm.language_id import identify
from folioforge.llm.line_dedup import dedup_lines
from folioforge.llm.mixing import mix_accounts
from folioforge.llm.ngram_join import near_duplicates
from folioforge.llm.packing import packed
from folioforge.llm.secret_scan import scan_secrets
from folioforge.llm.sharding import shuffled_shards
from folioforge.llm.url_filter import judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "lines", "kept_lines", "text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).drop("print", "host")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same evidence for web pages: declared in the markup, suffix and host of the address, models fitted on documents."""
    from folioforge.llm.language_id import fitted

    weights = fitted(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    declared = F.regexp_extract("html", r"""(?i)<html[^>]*\slang=["']?([a-z]+)""", 1)
    shown = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", declared.alias("declared"), shown.alias("shown"))
    found = identify(pages, id_col="page_id", text_col="shown", declared_col="declared", host_col=None, url_col="url", weights=weights)
    return found.withColumnRenamed("doc_id", "page_id").drop("print")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_duplicates(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_accounts(table(spark, sf_dir, "documents"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shuffled_shards(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_digests(table(spark, sf_dir, "documents"))


def op12_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return erase_masters(*[table(spark, sf_dir, name) for name in ("clients", "clicks", "sales", "sale_lines")])


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_source_mix": op7_source_mix,
    "op8_shard": op8_shard,
    "op9_packing": op9_packing,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_fill_middle": op11_fill_middle,
    "op12_erasure": op12_erasure,
    "op13_best_fit": op13_best_fit,
    "language_id_pages": language_id_pages,
}

#: Groups of linked rows: every row reaches itself and what its links reach. The SQL spells all pairs out and is for small tables.
_REACHED = """
        reached(id, other) AS (SELECT id, id FROM every UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
        least AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"""

ORACLES = {
    "op1_ngram_jaccard_join": rf"""
        WITH RECURSIVE said AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        every AS (SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
          ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM said),
        each AS (SELECT id, len(s) AS n, unnest(s) AS g FROM every),
        links AS (SELECT x.id AS a, y.id AS b FROM each x JOIN each y ON x.g = y.g AND x.id <> y.id GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),{_REACHED}
        SELECT id AS doc_id, len(s) AS n_shingles, component_id FROM every JOIN least USING (id)""",
    "op4_url_filter": r"""
        WITH RECURSIVE parts AS (
          SELECT page_id, coalesce(html, '') AS html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        ruled AS (SELECT *, '.' || host AS h, CASE WHEN h LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN h LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
          WHEN h LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN h LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
          CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled FROM parts),
        named AS (SELECT host AS a, unnest(list_concat(
          regexp_extract_all(html, '(?i)(?:href|src|action)[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["'']?[\x20\x09-\x0D]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''<>\x20\x09-\x0D]+)', 1),
          regexp_extract_all(html, '(?i)[a-z0-9._%+-]@([a-z0-9-]+(?:\.[a-z0-9-]+)+)', 1))) AS said FROM parts),
        links AS (SELECT a, translate(said, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b, count(*) AS n FROM named WHERE a <> '' AND a <> b GROUP BY 1, 2),
        weighed AS (SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS forth, n / sum(n) OVER (PARTITION BY b) AS back FROM links),
        seeds AS (SELECT host, count(*) FILTER (ruled = 'allow') / count(*) AS good, count(*) FILTER (ruled = 'block') / count(*) AS bad FROM ruled WHERE host <> '' GROUP BY host
          UNION ALL SELECT a, 0, 0 FROM links UNION ALL SELECT b, 0, 0 FROM links),
        nodes AS (SELECT host, max(good) AS good, max(bad) AS bad FROM seeds GROUP BY host),
        arcs AS (SELECT host AS u, host AS v, good, bad, 0.0::DOUBLE AS forth, 0.0::DOUBLE AS back FROM nodes UNION ALL SELECT a, b, 0, 0, forth, 0 FROM weighed UNION ALL SELECT b, a, 0, 0, 0, back FROM weighed),
        ranks AS (SELECT 0 AS k, host, good * (1 - 0.85::DOUBLE) AS trust, bad * (1 - 0.85::DOUBLE) AS distrust FROM nodes
          UNION ALL SELECT k + 1, v, sum(good) * (1 - 0.85::DOUBLE) + sum(trust * forth) * 0.85::DOUBLE, sum(bad) * (1 - 0.85::DOUBLE) + sum(distrust * back) * 0.85::DOUBLE FROM ranks JOIN arcs ON host = u WHERE k < 80 GROUP BY k, v),
        ended AS (SELECT host, distrust - trust >= 0.5 * (1 - 0.85::DOUBLE) AS bad FROM ranks WHERE k = 80)
        SELECT page_id, r.host, path, rule, coalesce(ruled, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict FROM ruled r LEFT JOIN ended e ON r.host = e.host""",
    "op5_exact_dedup": r"""
        WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM norm""",
    "op10_embedding_dedup": rf"""
        WITH RECURSIVE every AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
        sound AS (SELECT * FROM every WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
        links AS (SELECT x.id AS a, y.id AS b FROM sound x JOIN sound y ON x.label = y.label AND len(x.v) = len(y.v) AND x.id <> y.id WHERE list_cosine_similarity(x.v, y.v) >= 0.93),{_REACHED}
        SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = e.id) AS n_links, component_id, id = component_id AS kept FROM every e JOIN least USING (id)""",
    "op11_fill_middle": r"""
        WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, length(t) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h, [('0x' || h[8 * k + 1:8 * k + 8])::BIGINT FOR k IN [0, 1, 2, 3]] AS d FROM documents),
        cut AS (SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS x, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS y,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 90 THEN 'plain' WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (SELECT *, substring(t, 1, x) AS p, substring(t, x + 1, y - x) AS m, substring(t, y + 1) AS s FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256, sha256(t) AS restored_sha256
        FROM parts""",
}
