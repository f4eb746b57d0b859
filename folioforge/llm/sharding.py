"""Random shards by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by a seeded hash. Pass two shuffles each bucket by itself (Spark's shuffle() is Fisher and Yates') and writes it.
Buckets one after another are then a uniform random order of all records, which is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.support import deal_width, written

#: Bytes of text and overhead that a bucket holds on average. A bucket is held in memory by one task.
BUCKET_BYTES = 8 << 20
ROW_BYTES = 64
#: Bytes that a task of the second pass reads: some buckets, one after another, so tasks grow in number with the table and not in size. Beyond MOST_TASKS they grow; a task still holds one bucket at a time.
TASK_BYTES, MOST_TASKS = 128 << 20, 100_000
#: Buckets whose first positions are summed together, in the two levels of the prefix sum.
RUN = 4096
#: Rows of the table of offsets (24 bytes each) up to which it is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 400_000


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return _orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def _sorted(records: Column, ordered: bool) -> Column:
    """Records in the order of draw and place. Where their rows have no order, a comparison of these two alone does it, which is slower."""
    if ordered:
        return F.sort_array(records)
    less = lambda a, b: (a["draw"] < b["draw"]) | ((a["draw"] == b["draw"]) & (a["place"] < b["place"]))
    return F.array_sort(records, lambda a, b: F.when(less(a, b), F.lit(-1)).otherwise(F.lit(1)))


def shuffled_shards(docs: DataFrame, shards: int = 16, seed: int = 20, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of docs, with shard (0 to shards - 1) and slot (0, 1, ... in each shard).

    Row counts of shards differ by one at most (law `rows`). Each record counts for itself: rows that are alike, or that have the same or no doc_id, are scattered like any others, by the seed and
    their place in the table, so a group of copies never shares a bucket. Nulls in any column, empty and very long texts are kept as they are; a text longer than a bucket makes a bucket larger.
    An empty table gives an empty result; with fewer rows than shards, some shards are empty. Input columns named shard or slot are replaced. The order depends on the seed and on
    the table's files and split size, and is the same again when a task or the query is run again.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")])
    held = kept.agg(F.sum(F.coalesce(F.octet_length(f"`{text_col}`"), F.lit(0)) + ROW_BYTES).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(1, -(-(held["bytes"] or 0) // bucket_bytes))

    whole = F.struct(*[F.col(f"`{c}`") for c in kept.columns])
    ordered = all(_orderable(f.dataType) for f in kept.schema)
    record = F.struct(F.xxhash64(F.lit(seed), F.col("__place")).alias("draw"), F.col("__place").alias("place"), F.col("__row").alias("row"))
    scattered = kept.select(whole.alias("__row"), F.monotonically_increasing_id().alias("__place")).select(
        F.pmod(F.xxhash64(F.lit(seed + 1), F.col("__place")), F.lit(buckets)).alias("bucket"), record.alias("record")
    )
    tasks = min(buckets, max(deal_width(docs.sparkSession), min(MOST_TASKS, -(-(held["bytes"] or 0) // TASK_BYTES))))
    together = scattered.repartition(tasks, "bucket").groupBy("bucket").agg(_sorted(F.collect_list("record"), ordered).alias("records")).sortWithinPartitions("bucket")  # one random stream a task: buckets take it in order
    mixed = together.select("bucket", F.posexplode(F.expr(f"shuffle(records, {seed})")).alias("pos", "record"))
    mixed = written(mixed.select("bucket", F.col("pos").cast("long").alias("pos"), F.col("record.row").alias("row")), "buckets")

    counts = mixed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("run", F.floor(F.col("bucket") / RUN))
    runs = counts.groupBy("run").agg(F.sum("n").alias("n")).select("run", (F.sum("n").over(Window.orderBy("run")) - F.col("n")).alias("before"))
    inner = F.sum("n").over(Window.partitionBy("run").orderBy("bucket")) - F.col("n")
    offsets = written(counts.withColumn("inside", inner).join(runs, "run").select("bucket", (F.col("before") + F.col("inside")).alias("first")), "bucket-offsets")

    total = held["rows"]
    place = F.col("first") + F.col("pos")
    placed = mixed.join(F.broadcast(offsets) if buckets <= BROADCAST_ROWS else offsets, "bucket").select("row", place.alias("place"))
    shard = F.expr(f"({shards} * (place + 1) - 1) div {max(total, 1)}")
    cut = placed.withColumn("shard", shard.cast("int"))
    return cut.select("row.*", "shard", F.expr(f"place - (shard * {total}L) div {shards}").alias("slot"))
