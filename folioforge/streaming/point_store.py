"""Points that take upserts for years: runs of Parquet files, merged as they pile up, behind a small table that says which of them count.

A batch is written as one run, each point once and sorted by its id, with Parquet's Bloom filters on the id; then a new state names the runs that count. A state counts once its _SUCCESS is there, so a write that failed or a task that was lost leaves
nothing to be read, and a batch whose number was written already changes nothing. When FANOUT runs of one level have come together they are merged into one of the next, so a point is written again once a level and a read has to look at few runs,
however many batches there were. One writer at a time, as a stream's batches are.
"""

from __future__ import annotations

import time
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.vectors import last_written, latest
from folioforge.sources.files import file_system

#: Runs of a level that are merged; ids (40 bytes each) up to which those of newer runs are broadcast against the oldest one; different ids that a file's Bloom filter is made for.
FANOUT, BROADCAST_IDS, FILE_IDS = 8, 1_000_000, 1_000_000
_STATE = "first long, last long, level int, rows long, seconds double"


@dataclass(frozen=True)
class Run:
    """Batches first to last, its level, its points, and the seconds that it took to write."""

    first: int
    last: int
    level: int
    rows: int
    seconds: float

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}"


class PointStore:
    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), max(2, fanout)

    def _states(self) -> list[int]:
        """Numbers of the states that are complete."""
        files, root = file_system(self.spark, f"{self.path}/states")
        if not files.exists(root):
            return []
        Path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(s.getPath().getName()) for s in files.listStatus(root) if files.exists(Path(s.getPath(), "_SUCCESS")))

    def runs(self) -> list[Run]:
        """The runs that count, from the oldest on: a few for each level."""
        states = self._states()
        if not states:
            return []
        rows = self.spark.read.schema(_STATE).parquet(f"{self.path}/states/{states[-1]}").collect()
        return sorted((Run(**r.asDict()) for r in rows), key=lambda r: r.first)

    def _commit(self, runs: list[Run]) -> None:
        number = (self._states() or [0])[-1] + 1
        self.spark.createDataFrame([astuple(r) for r in runs], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/states/{number}")

    def _write(self, rows: DataFrame, first: int, last: int, level: int) -> Run:
        """Writes a run; one of the same name that a failed attempt has left is written over."""
        began, path = time.perf_counter(), f"{self.path}/runs/{first}-{last}"
        out = rows.sortWithinPartitions("point_id").write.mode("overwrite").option("parquet.bloom.filter.enabled#point_id", "true").option("parquet.bloom.filter.expected.ndv#point_id", str(FILE_IDS))
        out.parquet(path)
        seconds = time.perf_counter() - began
        return Run(first, last, level, self.spark.read.schema(rows.schema).parquet(path).count(), seconds)  # counted from footers

    def append(self, rows: DataFrame, number: int) -> bool:
        """Upserts the points of batch `number`: of those that occur twice the last one (see last_written). False, and nothing is written, if that batch or a later one has been."""
        runs = self.runs()
        if runs and number <= runs[-1].last:
            return False
        self._commit([*runs, self._write(last_written(rows), number, number, 0)])
        self.compact()
        return True

    def compact(self) -> None:
        """Merges runs until no level has FANOUT of them. Rows read before and after are the same."""
        while True:
            runs = self.runs()
            levels = [r.level for r in runs]
            full = next((level for level in sorted(set(levels)) if levels.count(level) >= self.fanout), None)
            if full is None:
                return
            old = [r for r in runs if r.level == full]
            merged = self._write(self._merged(old), old[0].first, old[-1].last, full + 1)
            self._commit([merged if r is old[0] else r for r in runs if r is old[0] or r not in old])

    def _rows(self, run: Run) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/runs/{run.name}").withColumn("__run", F.lit(run.last))

    def _merged(self, runs: list[Run]) -> DataFrame:
        """Of each point the row of the newest of these runs. The oldest, which is the largest, isn't shuffled where the ids of the others are few."""
        base = self._rows(runs[0]).drop("__run")
        if len(runs) == 1:
            return base
        newer = latest(reduce(lambda a, b: a.unionByName(b, True), [self._rows(r) for r in runs[1:]]), "point_id", "__run").drop("__run")
        ids = newer.select(F.col("point_id").alias("__id"))
        ids = F.broadcast(ids) if sum(r.rows for r in runs[1:]) <= BROADCAST_IDS else ids
        return base.join(ids, F.col("point_id").eqNullSafe(F.col("__id")), "left_anti").unionByName(newer, True)

    def read(self) -> DataFrame:
        """Each point as it was last written. Only runs that count are read."""
        return self._merged(self._live())

    def _live(self) -> list[Run]:
        runs = self.runs()
        if not runs:
            raise ValueError(f"no points have been written to {self.path}")
        return runs

    def found(self, ids: list[str]) -> DataFrame:
        """The points of some ids (a list for one request): the ids go to the scan, which skips row groups by their bounds and Bloom filters."""
        runs = [self._rows(r).where(F.col("point_id").isin(ids)) for r in self._live()]
        return latest(reduce(lambda a, b: a.unionByName(b, True), runs), "point_id", "__run").drop("__run")

    def vacuum(self) -> int:
        """Deletes states but the last, and runs that it doesn't name, of failed attempts too; how many runs. Not while somebody reads an older state."""
        states, live = self._states(), {r.name for r in self.runs()}
        files, root = file_system(self.spark, f"{self.path}/runs")
        if not states or not files.exists(root):
            return 0
        gone = [s.getPath() for s in files.listStatus(root) if s.getPath().getName() not in live]
        for path in gone:
            files.delete(path, True)
        for number in states[:-1]:
            files.delete(file_system(self.spark, f"{self.path}/states/{number}")[1], True)
        return len(gone)
