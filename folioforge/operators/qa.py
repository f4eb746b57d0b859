"""Questions answered from retrieved records, all questions at once."""

from __future__ import annotations

import re
import time

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.arrow import arrow
from folioforge.operators.vectors import top_k

#: The system's part of a prompt; a parameter of answers().
SYSTEM = "컨텍스트에 있는 사실만으로 간결하게 답하고, 숫자와 단위는 원문 그대로 쓰며, 근거가 없으면 모른다고 답한다."
_MARK = re.compile(r"\{\{([^{}#]+(?:#[^{}]+)?)\}\}")


def retrieved(questions: DataFrame, points: DataFrame, k: int = 7, distance: str = "cosine") -> DataFrame:
    """qid, rank, score and the record of the k nearest points of each question (qid, query)."""
    found = top_k(questions.select(F.col("qid").cast("string").alias("qid"), "query"), points, k, distance, "point_id", "dense")
    columns = ["text", "placeholder", "record_type", "source_file", "filename", "page_repr", "image_link", "placeholders"]
    return found.join(points.select(F.col("point_id").alias("id"), *columns), "id").select("qid", "rank", "score", *columns)


def notes(contexts: DataFrame, points: DataFrame) -> DataFrame:
    """qid, rank and notes: for each component that a context's text mentions, what to say in its stead. It is looked up by id, and by link where the context knows one."""
    asked = contexts.select("qid", "rank", "placeholders", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\{\{([^{}#]+)\}\}"), F.lit(1)))).alias("id"))
    asked = asked.withColumn("hint", F.nullif(F.try_element_at("placeholders", F.col("id")), F.lit("")))
    stored = points.select("id", "image_link", "point_id", "record_type", "component_type", F.coalesce(F.nullif("original", F.lit("")), F.nullif(F.array_join("original_rows", "\n"), F.lit("")), "text").alias("body"))
    wanted = asked.select("id", "hint").distinct()
    found = wanted.join(stored, "id").where(F.col("hint").isNull() | (F.col("hint") == F.col("image_link")))
    found = found.groupBy(F.col("id").alias("own"), F.col("hint").alias("own_hint")).agg(F.min_by(F.struct("record_type", "component_type", "body"), "point_id").alias("p"))
    known = asked.join(found, (F.col("id") == F.col("own")) & F.col("hint").eqNullSafe(F.col("own_hint")), "left").select("qid", "rank", "id", "p")
    body = F.coalesce("p.body", F.lit(""))
    kind = F.coalesce(F.nullif("p.record_type", F.lit("")), "p.component_type", F.lit(""))
    label = F.when(kind.contains("image"), "[이미지 참고]").when(kind.contains("table"), "[테이블 참고]").otherwise("[참고]")
    upper = F.upper("id")
    only = F.when(upper.startswith("IMG"), "[이미지 있음]").when(upper.startswith("TB"), "[테이블 있음]").otherwise("[참고 있음]")
    said = F.when((body == "") | (F.lower(F.trim(body)) == "no description"), only).otherwise(F.concat(label, F.lit(" "), body))
    return known.groupBy("qid", "rank").agg(F.map_from_entries(F.collect_list(F.struct("id", said.alias("said")))).alias("notes"))


@arrow("string")
def filled(text: pd.Series, notes: pd.Series) -> pd.Series:
    """Placeholders replaced in one pass: what comes in isn't looked at again."""
    return pd.Series([_MARK.sub(lambda m, n=dict(n) if n is not None else {}: n.get(m[1], m[0]), t or "") for t, n in zip(text, notes, strict=True)])


def resolved(contexts: DataFrame, points: DataFrame) -> DataFrame:
    """contexts with placeholders in their texts replaced by what the components say."""
    return contexts.join(notes(contexts, points), ["qid", "rank"], "left").withColumn("text", filled("text", "notes")).drop("notes")


def _file_name(c: str) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"([^/]*)$", 1)


def prompts(questions: DataFrame, contexts: DataFrame, system: str = SYSTEM) -> DataFrame:
    """qid, prompt and evidence of each question (qid, question)."""
    told = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c))
    meta = F.concat_ws(" | ", told("종류: ", F.col("record_type")), told("파일: ", _file_name("source_file")))
    shown = F.concat(F.format_string("[컨텍스트 %d] ", "rank"), meta, F.lit("\n"), F.coalesce("text", F.lit("")))
    facts = F.concat_ws(" | ", told("type=", F.col("record_type")), told("file=", _file_name("source_file")), F.format_string("score=%.4f", "score"))
    proof = F.concat(F.format_string("[%d] ", "rank"), facts, F.lit("\n"), F.coalesce("text", F.lit("")))
    each = contexts.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", shown.alias("shown"), proof.alias("proof")))).alias("c"))
    block = F.coalesce(F.nullif(F.trim(F.array_join(F.transform("c", lambda x: x["shown"]), "\n\n")), F.lit("")), F.lit("(컨텍스트 없음)"))
    asked = questions.select(F.col("qid").cast("string").alias("qid"), "question").join(each, "qid", "left")
    text = F.concat(F.lit(system), F.lit("\n\n질문: "), "question", F.lit("\n\n답은 다섯 문장을 넘기지 말고, 주어진 자료에 없으면 없다고 밝혀라.\n\n"), block)
    return asked.select("qid", "question", text.alias("prompt"), F.coalesce(F.array_join(F.transform("c", lambda x: x["proof"]), "\n\n"), F.lit("")).alias("evidence"))


def answers(questions: DataFrame, points: DataFrame, embedder, llm, k: int = 7, distance: str = "cosine", system: str = SYSTEM) -> DataFrame:
    """qid, question, answer, evidence, and the seconds that embedding and answering took, of each question. A blank question has an empty answer and evidence, and took no time."""

    @F.pandas_udf("struct<vector:array<float>,seconds:double>")
    def embedded(texts: pd.Series) -> pd.DataFrame:
        began = time.perf_counter()
        found = embedder.embed(texts.tolist())
        return pd.DataFrame({"vector": list(found), "seconds": (time.perf_counter() - began) / max(1, len(texts))})

    @F.pandas_udf("struct<text:string,seconds:double>")
    def said(texts: pd.Series) -> pd.DataFrame:
        out = []
        for p in texts:
            began = time.perf_counter()
            out.append((llm.answer(p, None, 1).strip(), time.perf_counter() - began))
        return pd.DataFrame(out, columns=["text", "seconds"])

    blank = ~F.coalesce("question", F.lit("")).rlike(r"(?U)\S")
    real = questions.where(~blank).withColumn("__e", embedded("question"))
    contexts = resolved(retrieved(real.select("qid", F.col("__e.vector").alias("query")), points, k, distance), points)
    took = real.select(F.col("qid").cast("string").alias("qid"), F.col("__e.seconds").alias("embed_seconds"))
    done = prompts(real, contexts, system).withColumn("__a", said("prompt")).join(took, "qid")
    done = done.select("qid", "question", F.col("__a.text").alias("answer"), "evidence", "embed_seconds", F.col("__a.seconds").alias("answer_seconds"))
    zero = F.lit(0.0)
    return done.unionByName(questions.where(blank).select(F.col("qid").cast("string").alias("qid"), "question", F.lit("").alias("answer"), F.lit("").alias("evidence"), zero.alias("embed_seconds"), zero.alias("answer_seconds")))


def time_sums(done: DataFrame) -> DataFrame:
    """How many rows there are, and the sum of each column of seconds."""
    return done.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in done.columns if c.endswith("_seconds")])


def numbered(questions: DataFrame) -> DataFrame:
    """qid for questions in the order of the file; the file is one small partition."""
    return questions.withColumn("qid", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))
