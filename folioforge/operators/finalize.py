"""Final records: components, chunks and summaries as rows of one shape."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.arrow import arrow
from folioforge.functions import text as tx
from folioforge.operators.documents import windows

NONE = "No Description"
COLUMNS = ("doc_key", "record_type", "id", "placeholder", "component_type", "original", "original_rows", "text", "keyword", "placeholders", "image_link", "section_path", "filename", "pages", "page_repr")


@arrow("string")
def listed(rows: pd.Series) -> pd.Series:
    """A list of texts as it is written in Python."""
    return rows.map(lambda x: repr([str(v) for v in x]) if x is not None else "None")


def _record(df: DataFrame, **given: Column) -> DataFrame:
    """df's columns and those given, in the shape of COLUMNS; what is missing is null."""
    kinds = {"original_rows": "array<string>", "keyword": "array<string>", "placeholders": "map<string,string>", "pages": "array<int>"}
    if "page" in df.columns:
        given = {"pages": F.when(F.col("page").isNotNull(), F.array("page")), "page_repr": F.col("page").cast("string")} | given
    return df.select(*[given[c].alias(c) if c in given else F.col(c) if c in df.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in COLUMNS])


def last_summaries(results: DataFrame, family: str, by_document: bool = True) -> DataFrame:
    """key columns and summary of each component; of several results the last (ord) wins. Without by_document, documents that use the same id share one summary."""
    keys = ["doc_key", "id"] if by_document else ["id"]
    order = F.col("ord") if "ord" in results.columns else F.lit(0)
    return results.where(F.col("family") == family).groupBy(*keys).agg(F.max_by("summary", order).alias("summary"))


def _before() -> Column:
    return tx.prefix(F.col("filename"), F.col("section_path"))


def structured(parts: DataFrame, summaries: DataFrame) -> DataFrame:
    """Of each structured table a record, one for each row, and one for its summary if it has one. Tables with protected terms give none."""
    keys = [c for c in ("doc_key", "id") if c in summaries.columns]
    tables = parts.where((F.col("split") == "tables_str") & ~tx.has_protected(F.col("row_flatten"))).join(summaries, keys, "left")
    tables = tables.withColumn("record_type", F.lit("table_str")).withColumn("__p", _before()).withColumn("__s", tx.joined_summary(F.col("summary")))
    base = _record(tables.withColumn("original_rows", F.col("row_flatten")), text=F.when(F.col("__p") != "", tx.prefixed(F.col("__p"), listed("row_flatten"))).otherwise(F.array_join("row_flatten", "\n")))
    rows = tables.select("*", F.posexplode("row_flatten").alias("__k", "__row"))
    none = F.lit(None).cast("string")
    each = _record(rows, id=F.concat("id", F.lit("#"), (F.col("__k") + 1).cast("string")), placeholder=none, component_type=F.lit("table_row"), original=F.col("__row"), text=tx.prefixed(F.col("__p"), F.col("__row")))
    said = _record(tables.where("__s != ''"), id=F.concat("id", F.lit("#summary")), placeholder=none, component_type=F.lit("table_summary"), original=F.col("__s"), text=tx.prefixed(F.col("__p"), F.col("__s")))
    return base.unionByName(each).unionByName(said)


def unstructured(parts: DataFrame, summaries: DataFrame) -> DataFrame:
    """Summary, or else the table's HTML, or else NONE."""
    keys = [c for c in ("doc_key", "id") if c in summaries.columns]
    tables = parts.where(F.col("split") == "tables_unstr").join(summaries, keys, "left")
    said = F.coalesce(F.nullif(tx.joined_summary(F.col("summary")), F.lit("")), F.nullif("full_html", F.lit("")), F.lit(NONE))
    return _record(tables.withColumn("record_type", F.lit("table_unstr")), original=said, text=tx.prefixed(_before(), said))


def formulas(parts: DataFrame) -> DataFrame:
    said = F.coalesce(F.nullif("description", F.lit("")), F.lit(NONE))
    return _record(parts.where(F.col("split") == "images_formula").withColumn("record_type", F.lit("image_formula")), original=said, text=tx.prefixed(_before(), said))


def images(parts: DataFrame, results: DataFrame, family: str) -> DataFrame:
    """Images with an answer; it is looked up by id and link, or else by id where the result has no link. A translation with a long run of ideographs falls back to the description. Without content there is no record."""
    order = F.col("ord") if "ord" in results.columns else F.lit(0)
    own = results.where(F.col("family") == family).select("doc_key", "id", F.nullif("image_link", F.lit("")).alias("image_link"), "summary", order.alias("ord"))
    found = own.groupBy("doc_key", "id", "image_link").agg(F.max_by("summary", "ord").alias("summary"))
    linked = found.where("image_link IS NOT NULL").withColumnRenamed("summary", "__a")
    bare = found.where("image_link IS NULL").select("doc_key", "id", F.col("summary").alias("__b"))
    all_ = parts.where(F.col("split") == family).join(linked, ["doc_key", "id", "image_link"], "left").join(bare, ["doc_key", "id"], "left")
    said = tx.stripped(F.array_join(F.coalesce("__a", "__b", F.array().cast("array<string>")), ""))
    if family == "images_trans":
        said = F.when(said.rlike(tx.LONG_CJK), F.coalesce("description", F.lit(""))).otherwise(said)
    kind = F.lit("image_sum" if family == "images_sum" else "image_trans")
    all_ = all_.withColumn("record_type", kind).withColumn("__said", said).where("__said != ''")
    return _record(all_, original=F.col("__said"), text=tx.prefixed(_before(), F.col("__said")), keyword=F.array().cast("array<string>"))


def texts(chunks: DataFrame, size: int = 0, overlap: int = 0) -> DataFrame:
    """Chunks behind their prefix, cut into windows of about `size` characters."""
    whole = chunks.withColumn("record_type", F.lit("text")).withColumn("__t", tx.prefixed(_before(), F.coalesce("text", F.lit("")))).drop("text")
    shown = F.concat(F.lit("["), F.array_join(F.transform("pages", lambda p: p.cast("string")), ", "), F.lit("]"))
    if size <= 0:
        return _record(whole, text=F.col("__t"), page_repr=shown)
    cut = whole.withColumn("__c", windows("__t", F.lit(size), F.lit(max(overlap, 0))))
    many = cut.select("*", F.size("__c").alias("__n"), F.posexplode_outer("__c").alias("__k", "__w")).drop("__c")
    named = F.when(F.col("__n") > 1, F.concat("id", F.lit("#c"), (F.col("__k") + 1).cast("string"))).otherwise(F.col("id"))
    return _record(many, id=named, text=F.when(F.col("__n") > 1, F.col("__w")).otherwise(F.col("__t")), page_repr=shown)


def finalized(parts: DataFrame, chunks: DataFrame, results: DataFrame, size: int = 0, overlap: int = 0) -> DataFrame:
    """All final records. results: doc_key, family, id, image_link, summary and, if several may be for one component, ord."""
    out = texts(chunks, size, overlap).unionByName(structured(parts, last_summaries(results, "tables_str"))).unionByName(unstructured(parts, last_summaries(results, "tables_unstr")))
    return out.unionByName(formulas(parts)).unionByName(images(parts, results, "images_sum")).unionByName(images(parts, results, "images_trans"))
