"""What the operators of this subpackage share: the shared folder, written tables, word patterns, long ranges."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word and a run of white space, as Java and Python patterns.
WORD = r"[^\x20\x09-\x0D]+"
#: Runs of white space that are not one space already; replacing only these by a space is the same and much cheaper.
UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


_own_folder: list[str] = []
#: Paths of tables that the operators that run just now have written, by operator.
_open: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("open", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only where it is unset (tests in one process), a temporary one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own_folder:
            _own_folder.append("file://" + tempfile.mkdtemp(prefix="folioforge-"))
        found = _own_folder[0]
    return found.rstrip("/")


def _file(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def collected(spark: SparkSession) -> None:
    """Spark removes shuffle files of plans that nobody holds any more: those of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str, compression: str = "zstd", lasting: bool = False, tidy: bool = True) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage, and survives the loss of any executor.

    Inside of scratch() the table goes when that ends; a lasting one belongs to the scratch() around it, or else stays as long as the JVM. tidy: shuffle files of finished steps are removed after it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/folioforge/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if tidy:
        collected(spark)
    files, where = _file(spark, path)
    files.deleteOnExit(where)
    owners = _open.get()[: -1 if lasting else None]
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, but for lasting ones. What is computed inside must be written there, too."""
    own: list[str] = []
    before = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(before)
        for path in own:
            files, where = _file(spark, path)
            files.delete(where, True)
        collected(spark)


def few(df: DataFrame, most: int) -> DataFrame:
    """df, broadcast if it has so many rows at most; else left to a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def row_key(*cols: str) -> list[Column]:
    """Two independent hashes, p and q, that tell rows apart by these columns; nulls are told from values."""
    values = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(k), *values).alias(name) for k, name in enumerate("pq")]


#: The type of row_print().
PRINT = "struct<p:long,q:long>"


def row_print(*cols: str) -> Column:
    """The two hashes of row_key() as one column: 128 bits, so that among 10^10 rows two that differ hardly ever share it."""
    return F.struct(*row_key(*cols))


def without_repeats(docs: DataFrame, *key: str, most: int = 300_000) -> DataFrame:
    """docs with one of rows alike in the key columns. Only rows that repeat are moved, found by narrow columns. A column that holds a row's key is named with two underscores and a number that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    k = next(k for k in range(len(taken) + 1) if f"__{k}" not in taken)
    keyed = F.struct(*row_key(*key))
    twice = written(docs.groupBy(keyed.alias("key")).count().where("count > 1").select("key"), "alike", lasting=True)
    if twice.isEmpty():
        return docs
    twice = few(twice.select(F.col("key").alias(f"__{k}")), most)
    all_ = docs.withColumn(f"__{k}", keyed)
    return all_.join(twice, f"__{k}", "left_anti").unionByName(all_.join(twice, f"__{k}", "left_semi").dropDuplicates([f"__{k}"])).drop(f"__{k}")


def squeezed(text: Column) -> Column:
    """Every run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def word_count(text: Column) -> Column:
    """How many words a text has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def deal_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def expanded(df: DataFrame, count: str, out: str, chunk: int = 1 << 16) -> DataFrame:
    """Each row once for every number from 0 to df[count] - 1, as column out.

    A long range is cut into chunks that are dealt to all tasks before they are spelled out, so one row with a huge range doesn't keep one task busy.
    """
    n = F.col(count)
    parts = df.where(n > 0).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))))
    dealt = parts.repartition(deal_width(df.sparkSession), F.xxhash64(*[F.col(f"`{c}`") for c in parts.columns if not c.startswith("__m_")]))
    first = F.col("__part") * chunk
    return dealt.withColumn(out, F.explode(F.sequence(first, F.least(n, first + chunk) - 1))).drop("__part")


def bounded_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Arrow batches that go to Python are at most so large (one row at least)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
