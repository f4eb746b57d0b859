"""The same stages over files that arrive: a file stream, and an upsert of each batch that can be done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioforge.sources.files import placed
from folioforge.streaming.point_store import PointStore


def arriving(spark: SparkSession, root: str, suffix: str = ".md", files_a_batch: int = 1000) -> DataFrame:
    """doc_key, folder, filename and text of files as they arrive below root."""
    stream = spark.readStream.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_a_batch)
    return placed(stream.text(root, wholetext=True), root).select("doc_key", "folder", "filename", "text")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table of points: of each the row of the last batch that wrote it."""
    return PointStore(spark, path).read()


def upserting(docs: DataFrame, points: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Upserts the points of each batch into the store at path; a batch that comes again changes nothing. Batches are numbered by the checkpoint, so a store belongs to one checkpoint."""

    def write(batch: DataFrame, number: int) -> None:
        PointStore(batch.sparkSession, path).append(points(batch), number)

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
