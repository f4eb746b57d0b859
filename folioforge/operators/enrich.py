"""Payloads for a model, its answers, and what of them is valid."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators.documents import cell_texts
from folioforge.operators.providers import LlmProvider
from folioforge.sources.files import file_system

IMAGE_WINDOW, TABLE_WINDOW, NUMERIC_SHARE, ATTEMPTS = 15, 20, 0.3, 3
#: What each family asks for; a parameter of payloads().
INSTRUCTIONS = {
    "tables_str": "Summarise the table in Korean, 4 to 8 sentences; keep numbers, units and terms as they are. Answer with JSON: {\"table_summary\": [...]}.",
    "tables_unstr": "Summarise the image of a table in Korean, 3 to 6 sentences; use only values that it shows. Answer with JSON: {\"table_summary\": [...]}.",
    "images_trans": "Say the description in Korean, in one paragraph; keep terms, numbers and units. Answer with JSON: {\"image_summary\": \"...\"}.",
    "images_sum": "Describe the image in Korean, 5 to 7 sentences; guess nothing. Answer with JSON: {\"image_summary\": [...]}.",
}
FAMILIES = tuple(INSTRUCTIONS)
KEYS = {"tables_str": "table_summary", "tables_unstr": "table_summary", "images_trans": "image_summary", "images_sum": "image_summary"}


def folder_of(link: Column) -> Column:
    """The document's folder: what stands before the first `components` in a link."""
    return F.regexp_extract(F.coalesce(link, F.lit("")), r"^(.*?)(?:^|/)components(?:/|$)", 1)


def numeric_share(parts: DataFrame) -> DataFrame:
    """parts with total_cells, digit_only_cells and digit_only_ratio of their tables."""
    cells = parts.withColumn("__cells", cell_texts(F.coalesce("table_html", F.lit(""))))
    counted = cells.withColumn("total_cells", F.size("__cells")).withColumn("digit_only_cells", F.size(F.filter("__cells", tx.is_numeric_cell))).drop("__cells")
    return counted.withColumn("digit_only_ratio", F.when(F.col("total_cells") > 0, F.col("digit_only_cells") / F.col("total_cells")).otherwise(F.lit(0.0)))


def judged_tables(parts: DataFrame, threshold: float = NUMERIC_SHARE) -> DataFrame:
    """Structured and unstructured tables with skip_reason: protected_term, digit_ratio (structured ones only) or null."""
    tables = parts.where(F.col("split").isin("tables_str", "tables_unstr"))
    texts = F.concat(F.coalesce("row_flatten", F.array().cast("array<string>")), F.filter(F.array("table_html", "full_html"), lambda x: x.isNotNull()))
    heavy = (F.col("split") == "tables_str") & (F.col("total_cells") > 0) & (F.col("digit_only_ratio") >= tx.ratio(threshold))
    return numeric_share(tables).withColumn("skip_reason", F.when(tx.has_protected(texts), "protected_term").when(heavy, "digit_ratio"))


def skipped_tables(judged: DataFrame) -> DataFrame:
    """The audit of structured tables that are left out."""
    left = judged.where((F.col("split") == "tables_str") & F.col("skip_reason").isNotNull())
    return left.select("doc_key", "id", "filename", "section_path", "page", "image_link", F.round("digit_only_ratio", 4).alias("digit_only_ratio"), "digit_only_cells", "total_cells", "skip_reason")


def payloads(parts: DataFrame, texts: DataFrame, threshold: float = NUMERIC_SHARE, instructions: dict[str, str] | None = None) -> DataFrame:
    """doc_key, family, id, instruction, input (a JSON string, keys in order) and image_link. texts: doc_key and the cleaned text.

    What is skipped goes before texts are joined, and each document's text is joined once for all its components.
    """
    said = {**INSTRUCTIONS, **(instructions or {})}
    tables = judged_tables(parts, threshold).where("skip_reason IS NULL").select(*parts.columns)
    images = parts.where(F.col("split").isin("images_sum", "images_trans"))
    all_ = tables.unionByName(images).join(texts.select("doc_key", F.col("text").alias("__text")), "doc_key", "left")
    window = F.when(F.col("split").startswith("tables"), tx.context_window(F.col("__text"), F.col("id"), TABLE_WINDOW)).otherwise(tx.context_window(F.col("__text"), F.col("id"), IMAGE_WINDOW))
    known = F.when(folder_of(F.col("image_link")) != "", window).otherwise(F.struct(F.lit("").alias("before"), F.lit("").alias("after")))
    all_ = all_.withColumn("__w", known)
    empty = lambda c: F.coalesce(c, F.lit(""))
    around = [F.col("__w.before").alias("context_before"), F.col("__w.after").alias("context_after")]
    inputs = {
        "tables_str": F.struct(F.coalesce("row_flatten", F.array().cast("array<string>")).alias("row_flatten"), "filename", "image_link", *around),
        "tables_unstr": F.struct(empty("section_path").alias("section_path"), "filename", "image_link", *around),
        "images_trans": F.struct(empty("description").alias("description"), empty("image_link").alias("image_link"), empty("section_path").alias("section_path")),
        "images_sum": F.struct(empty("image_link").alias("image_link"), *around),
    }
    keep = {"ignoreNullFields": "false"}
    given, told = F.lit(None).cast("string"), F.lit(None).cast("string")
    for family in FAMILIES:
        given = F.when(F.col("split") == family, F.to_json(inputs[family], keep)).otherwise(given)
        told = F.when(F.col("split") == family, F.lit(said[family])).otherwise(told)
    return all_.select("doc_key", F.col("split").alias("family"), "id", told.alias("instruction"), given.alias("input"), "image_link")


def prompt(instruction: str, given: str) -> str:
    shown = json.dumps(json.loads(given), ensure_ascii=False, indent=2)
    return f"{instruction}\n\n입력:\n{shown}\n\n지정한 형식의 JSON 객체 하나만 답하라."


def answered_json(c: Column) -> Column:
    """The JSON of an answer: all of it, or what its outermost braces hold; null if neither can be read."""
    bare = tx.without_trailing_commas(tx.clean_response(c))
    whole, inner = F.try_parse_json(bare), F.try_parse_json(F.regexp_extract(bare, r"(?s)(\{.*\})", 1))
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    return F.when(F.coalesce(is_object(whole), F.lit(False)), whole).when(F.coalesce(is_object(inner), F.lit(False)), inner)


def validated(results: DataFrame) -> DataFrame:
    """results (family, raw_response) with summary (array<string>) and ok: whether the answer has the form that its family asks for, good sentences only, and, for images, says enough."""
    key = F.when(F.col("family").startswith("tables"), "table_summary").otherwise("image_summary")
    is_list = F.col("family") != "images_trans"
    parsed = results.withColumn("__v", answered_json(F.coalesce("raw_response", F.lit("")))).withColumn("__m", F.try_variant_get("__v", "$", "map<string,variant>"))
    entries = F.filter(F.map_entries("__m"), lambda e: F.trim(e["key"]) == key)
    value = F.when(F.size(entries) > 0, F.element_at(entries, F.when(F.size(entries) > 0, F.size(entries)).otherwise(1))["value"])
    parsed = parsed.withColumn("__x", value).withColumn("__kind", F.coalesce(F.schema_of_variant("__x"), F.lit("")))
    many = F.try_variant_get("__x", "$", "array<variant>")
    strings = F.transform(F.filter(many, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.try_variant_get(v, "$", "string"))
    one = F.try_variant_get("__x", "$", "string")
    one = F.when(tx.is_bad_sentence(one), F.lit("")).otherwise(one)
    as_list, as_text = F.col("__kind").startswith("ARRAY"), F.col("__kind") == "STRING"
    none = F.array().cast("array<string>")
    summary = F.when(is_list & as_list, tx.good_sentences(strings)).when(as_text, F.array(one)).otherwise(none)
    ok = (is_list & as_list) | (~is_list & as_text)
    judged = parsed.withColumn("summary", F.coalesce(summary, none))
    joined = F.array_join("summary", " ")
    again = F.when(F.col("family") == "images_sum", tx.needs_another_try(joined, "images_sum")).when(F.col("family") == "images_trans", tx.needs_another_try(joined, "images_trans")).otherwise(F.lit(False))
    reason = F.when(F.coalesce("raw_response", F.lit("")) == "", "empty_response").when(~ok, "invalid_output").when(again, "weak_image_summary")
    return judged.withColumn("reason", reason).withColumn("ok", reason.isNull()).drop("__v", "__m", "__x", "__kind")


def answered(asked: DataFrame, provider: LlmProvider, attempts: int = ATTEMPTS) -> DataFrame:
    """asked with the first good answer, or else the last of so many attempts, and which one it was. What has a good answer isn't asked again. Answers come from tasks; a lost task asks again."""
    shape = "doc_key string, family string, id string, instruction string, input string, image_link string, attempt int, raw_response string, ok boolean"
    names = [part.split(" ")[0] for part in shape.split(", ")]

    def asking(attempt: int):
        def run(batches):
            for pdf in batches:
                out = pdf.copy()
                for k in range(len(out)):
                    if not out.at[k, "ok"]:
                        out.at[k, "raw_response"] = provider.answer(prompt(out.at[k, "instruction"], out.at[k, "input"]), out.at[k, "image_link"], attempt)
                        out.at[k, "attempt"] = attempt
                yield out

        return run

    rows = asked.withColumns({"attempt": F.lit(0), "raw_response": F.lit(None).cast("string"), "ok": F.lit(False)})
    for attempt in range(1, attempts + 1):
        rows = validated(rows.select(*names).mapInPandas(asking(attempt), shape))
    order = F.struct((~F.col("ok")).alias("bad"), "attempt")
    columns = ["input", "image_link", "attempt", "raw_response", "summary", "ok", "reason"]
    best = rows.groupBy("doc_key", "family", "id").agg(F.min_by(F.struct(*columns), order).alias("r"))
    return best.select("doc_key", "family", "id", "r.*")


def not_yet_answered(asked: DataFrame, results: DataFrame) -> DataFrame:
    """Payloads without a result; documents' components of one name are told apart by their document."""
    return asked.join(results.select("doc_key", "family", "id").distinct(), ["doc_key", "family", "id"], "left_anti")


def answers_kept(asked: DataFrame, path: str) -> DataFrame | None:
    """Of the answers below path, the best of each payload that is asked: a good one, else one of the last attempts. None if there are none yet."""
    files, where = file_system(asked.sparkSession, path)
    if not files.exists(where):
        return None
    shape = "doc_key string, family string, id string, input string, image_link string, attempt int, raw_response string, summary array<string>, ok boolean, reason string, part int"
    rows = asked.sparkSession.read.schema(shape).parquet(path).drop("part")
    keys = ["doc_key", "family", "id", "input"]
    rows = rows.join(asked.select(*keys).distinct(), keys, "left_semi")
    order = F.struct((~F.col("ok")).alias("bad"), (-F.col("attempt")).alias("tried"), "raw_response")
    return rows.groupBy("doc_key", "family", "id").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys[:3]]), order).alias("r")).select("doc_key", "family", "id", "r.*")


def answered_and_kept(asked: DataFrame, provider: LlmProvider, path: str, attempts: int = ATTEMPTS, parts: int = 16) -> DataFrame:
    """As answered(), with all answers kept below path: a run that was stopped and starts again asks only what has no good answer there, also if the payload of an id has changed since.

    Payloads are asked in `parts` by their key, and what a part has got is kept as soon as it is done, so what a stop can lose is one part's. asked is read for each part: it should be a written table.
    """
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("doc_key", "family", "id"), F.lit(parts)) == part)
        known = answers_kept(mine, path)
        left = mine if known is None else not_yet_answered(mine, known.where("ok"))
        if not left.isEmpty():
            answered(left, provider, attempts).write.mode("append").parquet(f"{path}/part={part}")
    found = answers_kept(asked, path)
    return answered(asked, provider, attempts) if found is None else found
