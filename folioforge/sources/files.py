"""Readers and writers. All paths go to Spark's own readers, so any store that Spark reads will do."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.documents import split_of


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path as it wants it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that isn't there yet, below spark.checkpoint.dir; only where that is unset and all is one process, below a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str) -> DataFrame:
    """df, written and read again: what comes after starts from there, and survives the loss of executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def decoded(uri: Column) -> Column:
    """A file's path or name as it is, from the form in which Spark gives it."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def placed(df: DataFrame, root: str | None) -> DataFrame:
    """doc_key, rel_path, folder, filename and text of files read as whole texts."""
    path, name = decoded(F.col("_metadata.file_path")), decoded(F.col("_metadata.file_name"))
    base = F.lit(root.rstrip("/") + "/") if root else F.lit("")
    rel = F.when(F.instr(path, base) > 0, F.substr(path, F.instr(path, base) + F.length(base))).otherwise(name) if root else name
    folder = F.regexp_extract(rel, r"^(.*)/[^/]*$", 1)
    return df.select(path.alias("doc_key"), rel.alias("rel_path"), folder.alias("folder"), name.alias("filename"), F.col("value").alias("text"))


def markdown(spark: SparkSession, root: str, suffix: str = ".md") -> DataFrame:
    """doc_key, rel_path, folder, filename and text of all files below root that end so; none if root isn't there."""
    files, where = file_system(spark, root)
    if not files.exists(where):
        return spark.createDataFrame([], "doc_key string, rel_path string, folder string, filename string, text string")
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return placed(reader.text(root, wholetext=True), root)


def markdown_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return placed(spark.read.text(paths, wholetext=True), None)


def json_records(spark: SparkSession, path: str | list[str], schema: str, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records of files that hold one array each, and what couldn't be read. Strict: such a file is an error when it is read."""
    if not lenient:
        return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST"), spark.createDataFrame([], "path string, record string")
    wide = f"{schema}, _corrupt_record string"
    rows = spark.read.schema(wide).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    rows = rows.select("*", decoded(F.col("_metadata.file_path")).alias("__path")).persist()  # both results come from one parse, which Spark asks for
    good = rows.where("_corrupt_record IS NULL").drop("_corrupt_record", "__path")
    return good, rows.where("_corrupt_record IS NOT NULL").select(F.col("__path").alias("path"), F.col("_corrupt_record").alias("record"))


_COMPONENT = (
    "id string, placeholder string, component_type string, row_flatten array<string>, table_html string, snapshot_html string, full_html string, description string, "
    "image_link string, text string, section_path string, filename string, page int, pages array<int>"
)


def gathered(spark: SparkSession, root: str) -> DataFrame:
    """path, ord, split and the fields of each component in the files components.json below root, from their lists tables, images_summary, images_translation and texts. A list that is missing has none."""
    kinds = ("tables", "images_summary", "images_translation", "texts")
    shape = ", ".join(f"{k} array<struct<{_COMPONENT}>>" for k in kinds)
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "components.json").schema(shape).json(root, multiLine=True, mode="FAILFAST")
    each = read.select(decoded(F.col("_metadata.file_path")).alias("path"), *kinds)
    rows = [each.select("path", F.posexplode(k).alias("ord", "c")).select("path", (F.col("ord") + 1).alias("ord"), "c.*").withColumn("split", split_of(k)) for k in kinds]
    return reduce(DataFrame.unionByName, rows)


def questions(spark: SparkSession, path: str, column: str = "question") -> DataFrame:
    """A CSV with its column of questions, named as asked whatever its case; an error if there is none."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    found = next((c for c in df.columns if c.strip().lstrip("﻿").lower() == column.lower()), None)
    if found is None:
        raise ValueError(f"{path} has no column {column}: {df.columns}")
    return df.withColumnRenamed(found, column)


def pdfs(spark: SparkSession, root: str, wanted: list[str] | None = None) -> DataFrame:
    """doc_key, stem and content of all PDFs below root, or of those wanted by name, stem or path relative to root (with or without `_datasets/` before it)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(root)
    base = root.rstrip("/") + "/"
    rel = F.substr("path", F.instr("path", F.lit(base)) + len(base))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    files = files.select(F.col("path").alias("doc_key"), F.regexp_replace(name, r"\.pdf$", "").alias("stem"), name.alias("name"), rel.alias("rel"), "content")
    if wanted is not None:
        names = [w.removeprefix("./").removeprefix("_datasets/") for w in wanted]
        files = files.where(F.col("name").isin(*names) | F.col("stem").isin(*names) | F.col("rel").isin(*names))
    return files.drop("name", "rel").dropDuplicates(["doc_key"])


def write_split(parts: DataFrame, path: str, by: str = "split") -> None:
    """One folder for each value of `by`."""
    parts.write.mode("overwrite").partitionBy(by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A record a line, nulls kept, characters as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_json(df: DataFrame, path: str) -> None:
    """One file with one array of all records, in the order of df, nulls kept; a single task writes it a batch at a time. For readers that can't take a record a line: write_json() is written by all tasks."""

    def said(lines):
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    def run(batches):
        yield said(["["])
        first = True
        for batch in batches:
            lines = [x for x in batch.column(0).to_pylist() if x is not None]
            yield said([("" if first and not k else ",") + line for k, line in enumerate(lines)])
            first = first and not lines
        yield said(["]"])

    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    last = df.sparkSession.range(1).select(F.lit(None).cast("string").alias("value"))  # so that there is a task where there is no record
    df.select(record.alias("value")).unionByName(last).coalesce(1).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def write_answers(df: DataFrame, path: str) -> None:
    """CSV whose first column's name begins with a byte order mark, as spreadsheets want it."""
    first = df.columns[0]
    df.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("quoteAll", True).option("escape", '"').csv(path)


def assets(spark: SparkSession, root: str) -> DataFrame:
    """path, rel and content of the images below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{png,jpg,jpeg}").load(root)
    base = root.rstrip("/") + "/"
    return files.select("path", F.substr("path", F.instr("path", F.lit(base)) + len(base)).alias("rel"), "content")


def audit(df: DataFrame, kind: str, *said: Column) -> DataFrame:
    """A table of things to look at: kind, time, and what is said of each row."""
    return df.select(F.lit(kind).alias("kind"), F.current_timestamp().alias("at"), F.concat_ws(" ", *said).alias("said"))
