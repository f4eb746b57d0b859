"""Language identification by fusing evidence.

The text's likelihood under character trigram models (fitted on a bounded labelled sample, see SAMPLE_ROWS), the language that the markup declares, the country suffix of the address, and a prior of the host
are multiplied and scaled to one. The host's prior comes from grouped counts of what the texts alone say, smoothed towards its parent domain, and that towards all rows. A further class stands for text in none of the
languages; rows for which it wins, or no language reaches MIN_CONFIDENCE, are rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.secret_scan import text_buffers
from folioforge.llm.support import PRINT, bounded_batches, row_print, written

LANGUAGES = ("de", "en", "es", "fr")
OTHER = "und"
#: Labelled rows that the models are fitted on, whole texts, at most: those of the least hashes of id and text.
SAMPLE_ROWS = 3000
#: Trigrams of a text that count as independent evidence; buckets of trigrams; what is added to each count.
WEIGHED, BUCKETS, ADDED = 40, 1 << 16, 0.5
#: Chance that a declaration or suffix names the text's language; weight of the parent in a host's prior, in rows; chance of text in no language.
DECLARED_RIGHT, SUFFIX_RIGHT, SMOOTHING, OTHER_PRIOR, MIN_CONFIDENCE = 0.9, 0.8, 50.0, 0.005, 0.5
#: Suffixes of countries with one of the languages.
SUFFIXES = (("at", "de"), ("de", "de"), ("uk", "en"), ("us", "en"), ("au", "en"), ("es", "es"), ("mx", "es"), ("ar", "es"), ("fr", "fr"))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("0") : ord("9") + 1] = ord("0")
_FOLD[9:14] = 32
#: Bytes that are scored together.
STEP = 1 << 21


def _buckets(data: np.ndarray) -> np.ndarray:
    b = _FOLD[data].astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Log chances of each bucket: a column for each language and one for none of them (even); a last row of zeros for places that are no trigram.

    Fitted on sample_rows labelled rows at most. Their whole texts are counted in tasks; the driver gets their hashes, and a number for each bucket and language.
    """
    known = docs.where(F.col(f"`{lang_col}`").isin(*LANGUAGES) & F.col(f"`{text_col}`").isNotNull())
    key = F.xxhash64(F.col(f"`{id_col}`").isNull(), f"`{id_col}`", f"`{text_col}`")
    least = known.select(key.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    counts = np.full((BUCKETS, len(LANGUAGES)), ADDED)
    if least is not None:
        part = known.select(key.alias("h"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(F.col("h") <= least).dropDuplicates(["h"]).select("lang", "text")

        def run(batches):
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    found = np.bincount(_buckets(raw), minlength=BUCKETS) if len(raw) > 2 else np.zeros(BUCKETS, np.int64)
                    at = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays([pa.array([LANGUAGES.index(lang)] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(found[at].astype(np.int64))], ["lang", "bucket", "n"])

        got = part.mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        lang, bucket, n = (got.column(c).to_numpy() for c in ("lang", "bucket", "n"))
        counts[bucket, lang] += n
    weights = np.zeros((BUCKETS + 1, len(LANGUAGES) + 1), np.float32)
    weights[:-1, :-1] = np.log(counts / counts.sum(0))
    weights[:-1, -1] = -np.log(BUCKETS)
    return weights


def _scores(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log chances over each whole text, and numbers of trigrams."""
    ends, data = text_buffers(texts)
    n = len(texts)
    sums = np.zeros((n, weights.shape[1]))
    sizes = np.maximum(0, np.diff(ends) - 2)
    for lo in range(0, max(0, len(data) - 2), STEP):
        at = _buckets(data[lo : lo + STEP + 2])
        first, last = np.searchsorted(ends, [lo, lo + len(at) - 1], side="right") - 1
        cuts = ends[first + 1 : last + 1] - lo
        for back in (1, 2):
            over = cuts - back
            at[over[(over >= 0) & (over < len(at))]] = BUCKETS
        after = ends[last + 1] - lo
        at[max(0, min(len(at), after - 2)) :] = BUCKETS
        starts = np.concatenate([[0], cuts]).astype(np.int64)
        full = np.diff(np.concatenate([starts, [len(at)]])) > 0
        sums[np.arange(first, last + 1)[full]] += np.add.reduceat(weights[at].astype(np.float64), starts[full], axis=0)
    return sums, sizes


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str | None = "source", url_col: str | None = None, weights: np.ndarray | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, print (of id, text, declaration and host), host, declared, text_lang, lang, confidence, kept.

    Null and blank texts have no evidence of their own, are lang und and not kept. A null or unknown declaration, host or address says nothing. Repeated rows each give their row and count in their host's prior. An empty table gives an
    empty result; other columns are ignored. The whole of each text is scored.
    """
    bounded_batches(docs.sparkSession)
    host = F.col(f"`{host_col}`") if host_col else F.regexp_extract(f"`{url_col}`", r"(?s)^.*?://([^/?#:]*)", 1)
    host = F.lower(F.coalesce(host.cast("string"), F.lit("")))
    models = docs.sparkSession.sparkContext.broadcast(fitted(docs, id_col, text_col, declared_col, sample_rows) if weights is None else weights)
    kind, k = docs.schema[id_col].dataType.simpleString(), len(LANGUAGES)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                sums, sizes = _scores(pc.fill_null(some.column(4), ""), models.value)
                mean = sums / np.maximum(1, sizes)[:, None] * np.minimum(sizes, WEIGHED)[:, None]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * (k + 1)), pa.array(mean.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), some.column(3), flat, pa.array(sizes)], ["doc_id", "print", "declared", "host", "says", "n"])

    declared = F.lower(F.substring(F.trim(F.col(f"`{declared_col}`").cast("string")), 1, 2))
    key = row_print(id_col, text_col, declared_col, host_col or url_col)
    told = docs.select(F.col(f"`{id_col}`").alias("doc_id"), key.alias("print"), declared.alias("declared"), host.alias("host"), F.col(f"`{text_col}`").alias("text"))
    blank = F.col("text").isNull() | ~F.col("text").rlike(r"[^\x00-\x40\x5B-\x60\x7B-\xBF]")
    told = told.withColumn("text", F.when(blank, F.lit("")).otherwise(F.col("text")))
    said = written(told.mapInArrow(run, f"doc_id {kind}, print {PRINT}, declared string, host string, says array<double>, n long"), "evidence")

    names = F.array(*[F.lit(x) for x in (*LANGUAGES, OTHER)])
    best = lambda scores: F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))
    said = said.withColumn("text_lang", F.when(F.col("n") > 0, best(F.col("says"))).otherwise(F.lit(OTHER))).withColumn("parent", F.regexp_extract("host", r"^[^.]*\.(.+)$", 1))
    counts = said.where(F.col("text_lang") != OTHER).groupBy("host", "parent", "text_lang").agg(F.count(F.lit(1)).alias("c"))
    wide = lambda by: [F.sum(F.when(F.col("text_lang") == x, F.col("c")).otherwise(0)).alias(f"{by}_{x}") for x in LANGUAGES]
    total = lambda by: sum((F.col(f"{by}_{x}") for x in LANGUAGES), F.lit(0.0))
    hosts, parents, whole = counts.groupBy("host", "parent").agg(*wide("h")), counts.groupBy("parent").agg(*wide("p")), counts.agg(*wide("a"))
    everywhere = {x: (whole_row[f"a_{x}"] or 0) + 1.0 for whole_row in [whole.first()] for x in LANGUAGES}
    share = {x: v / sum(everywhere.values()) for x, v in everywhere.items()}
    prior = hosts.join(parents, "parent")
    up = {x: (F.col(f"p_{x}") + SMOOTHING * share[x]) / (total("p") + SMOOTHING) for x in LANGUAGES}
    prior = written(prior.select("host", F.array(*[(F.col(f"h_{x}") + SMOOTHING * up[x]) / (total("h") + SMOOTHING) for x in LANGUAGES]).alias("prior")), "priors")

    suffix = F.regexp_extract("host", r"\.([a-z]+)$", 1)
    land = F.lit(None).cast("string")
    for name, x in SUFFIXES:
        land = F.when(suffix == name, x).otherwise(land)
    spoken = F.when(F.col("declared").isin(*LANGUAGES), F.col("declared"))
    even = F.array(*[F.lit(share[x]) for x in LANGUAGES])
    joined = said.join(prior, "host", "left").withColumn("prior", F.coalesce("prior", even)).withColumn("land", land).withColumn("spoken", spoken)
    hint = lambda col, x, right: F.when(F.col(col).isNull(), F.lit(1.0 / k)).when(F.col(col) == x, F.lit(right)).otherwise(F.lit((1 - right) / (k - 1)))
    logs = [F.element_at("says", i + 1) + F.log(F.element_at("prior", i + 1) * (1 - OTHER_PRIOR)) + F.log(hint("spoken", x, DECLARED_RIGHT)) + F.log(hint("land", x, SUFFIX_RIGHT)) for i, x in enumerate(LANGUAGES)]
    logs.append(F.element_at("says", k + 1) + F.log(F.lit(OTHER_PRIOR)) + 2 * F.log(F.lit(1.0 / k)))
    scored = joined.withColumn("logs", F.array(*logs))
    top = F.array_max("logs")
    mass = F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    scored = scored.withColumn("best", best(F.col("logs"))).withColumn("confidence", F.when(F.col("n") > 0, 1 / mass).otherwise(F.lit(0.0)))
    scored = scored.withColumn("kept", (F.col("n") > 0) & (F.col("best") != OTHER) & (F.col("confidence") >= MIN_CONFIDENCE))
    return scored.select("doc_id", "print", "host", "declared", "text_lang", F.when(F.col("kept"), F.col("best")).otherwise(F.lit(OTHER)).alias("lang"), F.round("confidence", 6).alias("confidence"), "kept")


#: Rejected rows (32 bytes each) up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 500_000


def without_rejected(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that identify() keeps, all columns as they are, whatever their names or types. Null and blank texts go; of repeated rows all stay or all go; a null id, declaration or host is no reason to go. An empty table gives an empty one."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    declared_col, host_col = options.get("declared_col", "lang"), options.get("host_col", "source")
    key = row_print(id_col, text_col, declared_col, host_col or options.get("url_col"))
    gone = written(identify(docs, **options).where("NOT kept").select(F.col("print").alias("print")).distinct(), "rejected")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    name = next(x for x in (f"__print{k}" for k in range(len(docs.columns) + 1)) if x not in {c.lower() for c in docs.columns})
    return docs.withColumn(name, key).join(gone.withColumnRenamed("print", name), name, "left_anti").drop(name)
