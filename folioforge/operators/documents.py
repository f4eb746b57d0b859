"""Stages over whole documents: normalise, extract components, read, chunk.

A document is the unit of work and is never split; documents are dealt evenly before the Python stages. Each stage is one Arrow pass, and everything after it is native.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import chunking, extraction, headings, mathtext
from folioforge.functions import text as tx
from folioforge.functions.arrow import arrow

#: Fixed value: documents that explain formulas.
FORMULA_DOCS = "조업공정식해설"
_PLACE = "section_path string, filename string, page int"
_TABLE = f"array<struct<id string, placeholder string, component_type string, row_flatten array<string>, table_html string, snapshot_html string, full_html string, image_link string, {_PLACE}, substituted boolean>>"
_IMAGE = f"array<struct<id string, placeholder string, component_type string, description string, full_html string, image_link string, {_PLACE}, substituted boolean>>"
_SPECIAL = "array<struct<placeholder string, full_html string, image_src string, filename string, page int, substituted boolean>>"




@arrow("struct<text:string,headings:array<struct<level:int,title:string>>>")
def outlined(text: pd.Series, special: pd.Series) -> pd.DataFrame:
    """Formulas and headings of each text."""
    out = []
    for t, formulas in zip(text, special, strict=True):
        t = t or ""
        if formulas:
            t = headings.with_formula_headings(t)
        t = t.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
        out.append(headings.outlined(mathtext.without_formulas(mathtext.raised(t))))
    return pd.DataFrame({"text": [t for t, _ in out], "headings": [[{"level": a, "title": b} for a, b in h] for _, h in out]})


def sanitized(docs: DataFrame) -> DataFrame:
    """docs (doc_key, filename, text) with text normalised, headings, and missing_titles."""
    stem = F.regexp_replace("filename", r"(?<=.)\.[^.]+$", "")
    done = docs.withColumn("__o", outlined(tx.with_markers(F.coalesce("text", F.lit("")), F.col("filename")), tx.compact(stem).contains(FORMULA_DOCS)))
    titles = F.transform("__o.headings", lambda h: h["title"])
    return done.withColumn("text", tx.with_first_heading(tx.eta_co(F.col("__o.text")), titles)).withColumn("headings", F.col("__o.headings")).withColumn("missing_titles", tx.missing_titles(titles)).drop("__o")




def extracted(docs: DataFrame) -> DataFrame:
    """doc_key, text with placeholders, and arrays tables, images_summary, images_translation, special for each document (doc_key, folder, text)."""
    shape = f"doc_key string, text string, tables {_TABLE}, images_summary {_IMAGE}, images_translation {_IMAGE}, special {_SPECIAL}"

    def run(batches):
        for pdf in batches:
            found = [extraction.extracted(t or "", f or "", k or "") for k, f, t in zip(pdf["doc_key"], pdf["folder"], pdf["text"], strict=True)]
            yield pd.DataFrame({"doc_key": pdf["doc_key"]} | {c: [x[c] for x in found] for c in ("text", "tables", "images_summary", "images_translation", "special")}, index=pdf.index)

    return docs.select("doc_key", "folder", "text").mapInPandas(run, shape)


@arrow("string")
def readable(html: pd.Series) -> pd.Series:
    return html.map(lambda t: chunking.readable(t or ""))


@arrow("array<string>")
def list_lines(html: pd.Series) -> pd.Series:
    from folioforge.functions.markup import Node, parsed

    return html.map(lambda t: [x for n in parsed(t or "").children if isinstance(n, Node) and n.name in ("ul", "ol") for x in chunking.list_lines(n)])


def cleaned(text: Column) -> Column:
    """Readable text without noise lines and empty sections."""
    done = tx.without_empty_sections(tx.without_noise(readable(text)))
    return tx.stripped(F.regexp_replace(done, r"\n{3,}", "\n\n"))


@arrow("array<struct<section_path:string,pages:array<int>,filename:string,text:string>>")
def _chunks(text: pd.Series, strict: pd.Series) -> pd.Series:
    return pd.Series([chunking.chunks(t or "", bool(s)) for t, s in zip(text, strict, strict=True)])


def chunked(docs: DataFrame, strict: bool = False) -> DataFrame:
    """doc_key, ord, id, component_type, text, section_path, filename, pages for each chunk of docs (doc_key, text)."""
    each = docs.select("doc_key", F.posexplode(_chunks("text", F.lit(strict))).alias("pos", "c"))
    number = F.col("pos") + 1
    return each.select("doc_key", number.alias("ord"), F.format_string("TEXT_%03d", number).alias("id"), F.lit("text").alias("component_type"), "c.text", "c.section_path", "c.filename", "c.pages")


def split_of(kind: str, field: Callable[[str], Column] = F.col) -> Column:
    """The split of a component of one of the lists tables, images_summary, images_translation and texts, from its component_type and id, which field() gives."""
    if kind == "tables":
        return F.when((field("component_type") == "table_unstructured") | field("id").startswith("TB_UNSTR"), "tables_unstr").otherwise("tables_str")
    if kind == "images_summary":
        return F.when(field("component_type") == "image_formula", "images_formula").otherwise("images_sum")
    return F.lit("images_trans" if kind == "images_translation" else "texts")


def components(found: DataFrame) -> DataFrame:
    """All components of extracted() as rows, with split and ord: tables_str, tables_unstr, images_formula, images_sum, images_trans. The lists are exploded together, so a document is parsed once for all of them."""
    kinds = ("tables", "images_summary", "images_translation")
    own = {kind: found.schema[kind].dataType.elementType for kind in kinds}
    types = {f.name: f.dataType for kind in kinds for f in own[kind]}

    def tagged(kind: str) -> Column:
        def row(x: Column, i: Column) -> Column:
            fields = [(x[c] if c in own[kind].names else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
            return F.struct((i + 1).alias("ord"), *fields, split_of(kind, lambda c: x[c]).alias("split"))

        return F.transform(kind, row)

    first = own["tables"].names
    each = found.select("doc_key", F.explode(F.concat(*[F.coalesce(tagged(kind), F.array()) for kind in kinds])).alias("c"))
    return each.select("doc_key", "c.ord", *[f"c.{c}" for c in first], "c.split", *[f"c.{c}" for c in types if c not in first])


def with_texts(parts: DataFrame, texts: DataFrame) -> DataFrame:
    """Components and chunks of text together, in all six splits."""
    return parts.unionByName(texts.withColumn("split", split_of("texts")), True)


def links(parts: DataFrame) -> DataFrame:
    """doc_key, id and image_link of each component; of equal ids an image to summarise comes before a table, and that before an image to translate."""
    rank = F.when(F.col("split").isin("images_sum", "images_formula"), 0).when(F.col("split") == "images_trans", 2).otherwise(1)
    best = parts.groupBy("doc_key", "id").agg(F.min_by(F.coalesce("image_link", F.lit("")), F.struct(rank, -F.col("ord"))).alias("image_link"))
    return best


def with_placeholders(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """texts with placeholders: a map from each component that a chunk mentions to its link, empty if unknown."""
    named = texts.select("doc_key", "ord", F.posexplode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\{\{([^{}]+)\}\}"), F.lit(1)))).alias("k", "id"))
    found = named.join(links(parts), ["doc_key", "id"], "left")
    maps = found.groupBy("doc_key", "ord").agg(F.sort_array(F.collect_list(F.struct("k", "id", F.coalesce("image_link", F.lit("")).alias("link")))).alias("e"))
    maps = maps.select("doc_key", "ord", F.map_from_entries(F.transform("e", lambda e: F.struct(e["id"], e["link"]))).alias("placeholders"))
    empty = F.create_map().cast("map<string,string>")
    return texts.join(maps, ["doc_key", "ord"], "left").withColumn("placeholders", F.coalesce("placeholders", empty))


def split_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@arrow("array<string>")
def cell_texts(html: pd.Series) -> pd.Series:
    from folioforge.functions.tables import cell_texts as of

    return html.map(lambda t: of(t or ""))


@arrow("struct<structured:boolean,rows:array<string>>")
def flattened(html: pd.Series) -> pd.DataFrame:
    from folioforge.functions.markup import parsed
    from folioforge.functions.tables import flattened as flat
    from folioforge.functions.tables import grid, is_structured

    same, rows = [], []
    for tree in (parsed(t or "") for t in html):
        same.append(is_structured(tree))
        rows.append(flat(grid(tree)) if same[-1] else [])
    return pd.DataFrame({"structured": same, "rows": rows})


@arrow("string")
def plain_math(text: pd.Series) -> pd.Series:
    return text.map(lambda t: mathtext.plain_math(t or ""))


@arrow("array<string>")
def windows(text: pd.Series, size: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([chunking.windows(t or "", int(s), int(o)) for t, s, o in zip(text, size, overlap, strict=True)])
