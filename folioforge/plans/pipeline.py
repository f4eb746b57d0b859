"""From documents to answers as one lazy chain."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import documents, enrich, finalize, qa, vectors
from folioforge.operators.providers import EchoLlm, HashedWords
from folioforge.sources import files


@dataclass(frozen=True)
class PipelineConfig:
    strict_headings: bool = False
    numeric_share: float = enrich.NUMERIC_SHARE
    chunk_size: int = 0
    chunk_overlap: int = 0
    attempts: int = enrich.ATTEMPTS
    distance: str = "cosine"
    top_k: int = 7
    collection: str = "final_embeddings"
    hnsw_m: int = 16
    hnsw_ef_construct: int = 100
    on_disk: bool = False
    llm: object = field(default_factory=EchoLlm)
    embedder: object = field(default_factory=HashedWords)

    @property
    def collection_name(self) -> str:
        return vectors.collection_name(self.collection, self.distance, self.hnsw_m, self.hnsw_ef_construct, self.on_disk)


@dataclass(frozen=True)
class Stages:
    sanitized: DataFrame
    components: DataFrame
    cleaned: DataFrame
    texts: DataFrame
    payloads: DataFrame
    results: DataFrame
    finals: DataFrame
    points: DataFrame
    found: DataFrame
    judged: DataFrame


def stages(docs: DataFrame, config: PipelineConfig = PipelineConfig(), folder: str | None = None) -> Stages:
    """docs: doc_key, folder, filename, text. What several stages start from (parsed documents, readable texts, answers) is written to folder, a new one if none is given, and read again: each document is parsed once, whatever is read of the stages.

    Tables that are in the folder already are written over. Without a folder of the caller's own they stay as long as the session.
    """
    spark = docs.sparkSession
    if folder is None:
        folder = files.new_folder(spark, "stages")
        system, where = files.file_system(spark, folder)
        system.deleteOnExit(where)
    clean = documents.sanitized(docs)
    found = files.kept(documents.extracted(clean), f"{folder}/extracted")
    parts = documents.components(found)
    texts = files.kept(found.select("doc_key", documents.cleaned(F.col("text")).alias("text")), f"{folder}/texts")
    chunks = documents.with_placeholders(documents.chunked(texts, config.strict_headings), parts)
    asked = enrich.payloads(parts, texts, config.numeric_share)
    results = files.kept(enrich.answered(asked, config.llm, config.attempts), f"{folder}/results")
    finals = finalize.finalized(parts, chunks, results, config.chunk_size, config.chunk_overlap)
    return Stages(clean, parts, texts, chunks, asked, results, finals, vectors.records(finals, config.embedder), found, enrich.judged_tables(parts, config.numeric_share))


def logs(done: Stages, pages: DataFrame | None = None) -> DataFrame:
    """What to look at, as rows of kind, at and said: headings as they were found, pages (see ocr.read_pdfs) that couldn't be read, documents without a top-level heading, tables that stand for themselves, components that weren't found in the text, tables that are left out, answers that can't be used."""
    missing = done.sanitized.select("doc_key", F.explode("missing_titles").alias("title"))
    special = done.found.select("doc_key", F.explode("special").alias("t")).select("doc_key", "t.*")
    lost = done.components.where("NOT substituted")
    skipped, failed = enrich.skipped_tables(done.judged), done.results.where("NOT ok")
    text = lambda c: F.col(c).cast("string")
    heads = done.sanitized.select("doc_key", F.explode("headings").alias("h")).select("doc_key", "h.level", "h.title")
    parts = [
        files.audit(heads, "heading", F.col("doc_key"), text("level"), F.col("title")),
        files.audit(missing, "missing_heading", F.col("doc_key"), F.col("title")),
        files.audit(special, "image_table", F.col("doc_key"), F.col("placeholder"), text("page"), F.col("image_src")),
        files.audit(lost, "not_found", F.col("doc_key"), F.col("id"), text("page")),
        files.audit(skipped, "skipped_table", F.col("doc_key"), F.col("id"), F.col("skip_reason"), text("digit_only_cells"), text("total_cells")),
        files.audit(failed, "answer", F.col("doc_key"), F.col("family"), F.col("id"), F.col("reason")),
    ]
    if pages is not None:
        parts.append(files.audit(pages.where("error IS NOT NULL"), "ocr_error", F.col("doc_key"), text("page"), F.col("error")))
    return reduce(DataFrame.unionByName, parts)


def answers(questions: DataFrame, points: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    return qa.answers(questions, points, config.embedder, config.llm, config.top_k, config.distance)
