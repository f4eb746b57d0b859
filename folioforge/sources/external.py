"""Points written to a store outside of Spark, as a Python data source for batches and streams.

Tasks stage their points, a request of a few points at a time, under a name that no other attempt has; the driver then makes what the tasks have staged count, all at once, or drops it. So a task that failed, was repeated or was lost
leaves nothing that is read, and an epoch of a stream that comes again changes nothing. FolderStore, on any file system that pyarrow knows, is such a store; one for a server has the same six methods.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.vectors import latest

#: Points of a request.
REQUEST = 32


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged. The run is in it, because Spark may make a stream's writer anew for its commits."""

    run: str
    part: str
    rows: int


class Store(Protocol):
    """A picklable object; stage runs in tasks, the others on the driver."""

    def stage(self, run: str, part: str, requests: Iterator[pa.RecordBatch]) -> int: ...

    def publish(self, staged: list[Staged], epoch: int | None) -> bool: ...

    def discard(self, staged: list[Staged]) -> None: ...

    def discard_run(self, run: str) -> None: ...

    def last_epoch(self) -> int | None: ...

    def read(self, spark: SparkSession) -> DataFrame: ...


def _path(uri: str) -> tuple[fs.FileSystem, str]:
    """file:/x, as Hadoop writes it, is file:///x to pyarrow."""
    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class FolderStore:
    """runs/<run>/<part>.parquet holds what was staged; commits/<number>.json names the parts that count, and the epoch that they are of. One writer at a time, as the epochs of a stream are."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _commits(self) -> list[dict]:
        files, root = _path(self.path)
        found = files.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
        return [json.loads(files.open_input_stream(f.path).read()) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".json")]

    def stage(self, run: str, part: str, requests: Iterator[pa.RecordBatch]) -> int:
        files, root = _path(self.path)
        rows, out = 0, None
        try:
            for batch in requests:
                if out is None:
                    files.create_dir(f"{root}/runs/{run}")
                    out = pq.ParquetWriter(f"{root}/runs/{run}/{part}.parquet", batch.schema, filesystem=files)
                out.write_batch(batch)
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return rows

    def publish(self, staged: list[Staged], epoch: int | None) -> bool:
        commits, last = self._commits(), self.last_epoch()
        if epoch is not None and last is not None and epoch <= last:
            self.discard(staged)
            return False
        files, root = _path(self.path)
        files.create_dir(f"{root}/commits")
        draft = f"{root}/commits/{uuid.uuid4().hex}.tmp"
        with files.open_output_stream(draft) as f:
            f.write(json.dumps({"parts": [f"{m.run}/{m.part}" for m in staged], "epoch": epoch}).encode())
        files.move(draft, f"{root}/commits/{len(commits):012d}.json")
        return True

    def discard(self, staged: list[Staged]) -> None:
        files, root = _path(self.path)
        for m in staged:
            if files.get_file_info(f"{root}/runs/{m.run}/{m.part}.parquet").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/runs/{m.run}/{m.part}.parquet")

    def discard_run(self, run: str) -> None:
        files, root = _path(self.path)
        if files.get_file_info(f"{root}/runs/{run}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/runs/{run}")

    def last_epoch(self) -> int | None:
        return max((c["epoch"] for c in self._commits() if c["epoch"] is not None), default=None)

    def read(self, spark: SparkSession) -> DataFrame:
        """Each point as the last commit that has it wrote it; of one that occurs twice in a commit, the one of the greatest ord."""
        commits = self._commits()
        paths = [f"{self.path}/runs/{p}.parquet" for c in commits for p in c["parts"]]
        if not paths:
            raise ValueError(f"no points have been written to {self.path}")
        number = spark.createDataFrame([(p, k) for k, c in enumerate(commits) for p in c["parts"]], "__part string, __commit int")
        part = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)\.parquet$", 1)
        rows = spark.read.parquet(*paths).withColumn("__part", part).join(number, "__part").withColumn("__order", F.struct("__commit", "ord"))
        return latest(rows, "point_id", "__order").drop("__part", "__commit", "__order")


class _Writer:
    def __init__(self, store: Store, request: int):
        self.store, self.request, self.run = store, request, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        part = uuid.uuid4().hex
        requests = (batch.slice(k, self.request) for batch in iterator for k in range(0, batch.num_rows, self.request))
        return Staged(self.run, part, self.store.stage(self.run, part, requests))

    def _publish(self, messages: list[Staged | None], epoch: int | None) -> None:
        self.store.publish([m for m in messages if m is not None and m.rows], epoch)


class BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[Staged | None]) -> None:
        self._publish(messages, None)

    def abort(self, messages: list[Staged | None]) -> None:
        self.store.discard_run(self.run)


class StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self._publish(messages, batchId)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.store.discard([m for m in messages if m is not None])


def registered(spark: SparkSession, store: Store, request: int = REQUEST) -> str:
    """The name of a format that writes to store."""
    called = f"points_{uuid.uuid4().hex}"

    class Points(DataSource):
        @classmethod
        def name(cls) -> str:
            return called

        def writer(self, schema, overwrite):
            return BatchWriter(store, request)

        def streamWriter(self, schema, overwrite):
            return StreamWriter(store, request)

    spark.dataSource.register(Points)
    return called


def write_points(points: DataFrame, store: Store, request: int = REQUEST) -> None:
    """Upserts points (point_id, ord and any others) into store, all or none."""
    points.write.format(registered(points.sparkSession, store, request)).mode("append").save()


def stream_points(points: DataFrame, store: Store, checkpoint: str, request: int = REQUEST) -> StreamingQuery:
    """Upserts a stream of points; epochs are numbered by the checkpoint, so a store belongs to one checkpoint."""
    return points.writeStream.format(registered(points.sparkSession, store, request)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
