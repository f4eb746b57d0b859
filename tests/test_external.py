"""Points in a store outside of Spark: all of a write or nothing."""

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from folioforge.plans import registry
from folioforge.sources.external import BatchWriter, FolderStore, Staged, StreamWriter, stream_points, write_points

SHAPE = "point_id string, ord int, text string"


def said(spark, store):
    return {r["point_id"]: r["text"] for r in store.read(spark).collect()}


def test_upserts(spark, tmp_path):
    store = FolderStore(f"file:{tmp_path}")
    first = spark.range(200).select(F.col("id").cast("string").alias("point_id"), F.lit(0).alias("ord"), F.lit("first").alias("text")).repartition(3)
    write_points(first, store)
    second = spark.createDataFrame([("7", 0, "old"), ("7", 1, "new"), (None, 0, "none"), ("200", 0, None)], SHAPE)
    write_points(second, store, request=1)
    write_points(second.limit(0), store)
    want = {str(k): "first" for k in range(200)} | {"7": "new", None: "none", "200": None}
    assert said(spark, store) == want and store.read(spark).count() == len(want)


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    store = FolderStore(f"file://{tmp_path}")
    write_points(spark.createDataFrame([("a", 0, "kept")], SHAPE), store)
    bad = spark.range(4000).repartition(4).select(F.col("id").cast("string").alias("point_id"), F.lit(0).alias("ord"), F.when(F.col("id") == 3999, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.lit("x")).alias("text"))
    with pytest.raises(Exception, match="broken"):
        write_points(bad, store)
    assert said(spark, store) == {"a": "kept"}
    assert sum(1 for _ in tmp_path.glob("runs/*/*.parquet")) == 1 and sum(1 for _ in tmp_path.glob("commits/*")) == 1


def test_a_repeated_epoch_changes_nothing(spark, tmp_path):
    store, batch = FolderStore(f"file://{tmp_path}"), spark.createDataFrame([("a", 0, "one")], SHAPE).toArrow().to_batches()
    for epoch, text in ((0, None), (0, "again")):
        writer = StreamWriter(store, 32)
        rows = batch if text is None else spark.createDataFrame([("a", 0, text)], SHAPE).toArrow().to_batches()
        writer.commit([writer.write(iter(rows)), None], epoch)
    assert said(spark, store) == {"a": "one"} and store.last_epoch() == 0
    writer = StreamWriter(store, 32)
    writer.abort([writer.write(iter(batch)), None], 1)
    assert store.last_epoch() == 0 and sum(1 for _ in tmp_path.glob("runs/*/*.parquet")) == 1


def test_requests_are_small(tmp_path):
    import pyarrow as pa

    class Counting:
        sizes: list = []

        def stage(self, run, part, requests):
            self.sizes += [b.num_rows for b in requests]
            return sum(self.sizes)

    writer = BatchWriter(Counting(), 32)
    assert isinstance(writer.write(iter([pa.record_batch({"point_id": [str(k) for k in range(70)]})])), Staged)
    assert Counting.sizes == [32, 32, 6]


def test_a_stream_that_starts_again(spark, tmp_path):
    store, arriving = FolderStore(f"file://{tmp_path}/store"), tmp_path / "in"
    for round_ in range(2):
        spark.createDataFrame([("a", 0, f"round {round_}"), (f"b{round_}", 0, "x")], SHAPE).coalesce(1).write.mode("append").parquet(str(arriving))
        stream_points(spark.readStream.schema(SHAPE).parquet(str(arriving)), store, f"{tmp_path}/checkpoint").awaitTermination()
    assert said(spark, store) == {"a": "round 1", "b0": "x", "b1": "x"} and store.last_epoch() == 1
    stream_points(spark.readStream.schema(SHAPE).parquet(str(arriving)), store, f"{tmp_path}/checkpoint").awaitTermination()
    assert store.last_epoch() == 1


def test_clients_and_their_changes(spark):
    got = sorted(repr(tuple(r)) for r in registry.QUERIES["upsert_external"](spark, SMALL).select("client_id", "city", "balance").collect())
    want = duckdb.sql(f"""SELECT client_id, city, balance FROM (
        SELECT client_id, city, balance, 0 AS step, 0 AS seq, updated_at AS t FROM '{SMALL}/clients.parquet' UNION ALL SELECT client_id, city, balance, 1, seq, valid_at FROM '{SMALL}/client_changes.parquet')
        QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY step DESC, seq DESC NULLS LAST, t DESC NULLS LAST, city DESC NULLS LAST, balance DESC NULLS LAST) = 1""").fetchall()
    assert got == sorted(map(repr, want)) and got


def test_items_through_one_file(spark):
    got = sorted(repr(tuple(r)) for r in registry.QUERIES["array_files"](spark, SMALL).collect())
    assert got == sorted(map(repr, duckdb.sql(f"SELECT item_id, name, brand, kind, size, price FROM '{SMALL}/items.parquet'").fetchall())) and got
