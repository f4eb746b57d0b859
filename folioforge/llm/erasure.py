"""Cascading erasure: tables are kept as sorted files, and only files that hold a victim are written again.

Sorting. A row's key is one string of bytes whose order is that of its columns from left to right, nulls first: a byte that tells nulls from values, then the value in bytes that compare as it does (see memcomparable); the row's place in the table
ends it, so keys differ, and equal rows split like any others. Keys are partitioned by their most significant bits, as many as the rows need, and buckets with too many rows again by the next ones that differ in them. What is counted before a bucket is
the rank of its first row, so where files begin is known from counts but for a bucket; in the few buckets in which a file begins, keys are sorted to find the one with which it does. Those keys, one a file, then tell each row's file. Rows move once, to the file that holds them. Several tables are
partitioned together: each begins as a bucket of its own.

Erasing. Victims are a table of ids. Those that occur in a file come to it as one sorted array, which heads its rows in one stream; numpy's searchsorted masks them batch by batch. New files are written beside the table, and take the places of the old ones when all are there.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.support import _file, bounded_batches, collected, deal_width, few, shared_folder, written

#: A file has one row more than this share of its table's rows.
FILES = 150
#: Buckets of a file, as its rows allow; rows of a bucket below which nothing is gained; digits for each bucket that is wanted, as a power of two, and most bits of a digit.
BUCKETS, LEAST_ROWS, SPARE_BITS, MOST_BITS = 8, 1024, 3, 16
#: Bytes of a key that are looked at together, as a positive number.
BYTES = 7
#: Rows (50 bytes each at most) up to which tables of buckets are broadcast; beyond, they are joined by a shuffle. Buckets are BUCKETS for each file and a few.
BROADCAST_ROWS = 500_000
#: Rows of a task that files are dealt to, where they are many.
TASK_ROWS = 200_000
_TOP = np.uint64(1 << 63)


def _fixed(values: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """A row of nine bytes for each uint64: is it there, and itself from the highest byte down."""
    out = np.zeros((len(values), 9), np.uint8)
    out[:, 0] = valid
    out[:, 1:] = np.where(valid, values, 0).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out


def _encoded(col: pa.Array) -> tuple[np.ndarray, pa.Array | None]:
    """Fixed bytes of a column's rows, and after them its strings, if it has any, with zeros escaped and an end that is less than any escape."""
    kind, valid = col.type, np.asarray(pc.is_valid(col))
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        body = col.cast(pa.binary()).fill_null(b"")
        if b"\0" in b"".join(body.to_pylist()):
            body = pa.array([x.replace(b"\0", b"\0\xff") for x in body.to_pylist()], pa.binary())
        return valid.astype(np.uint8).reshape(-1, 1), body
    if pa.types.is_floating(kind):
        values = np.asarray(col.cast(pa.float64()).fill_null(0.0)) + 0.0  # no negative zero
        bits = np.where(np.isnan(values), np.nan, values).view(np.uint64)
        return _fixed(np.where(bits >= _TOP, ~bits, bits ^ _TOP), valid), None
    if pa.types.is_decimal(kind):
        wide = col.cast(pa.decimal128(38, kind.scale)).fill_null(0)
        halves = np.frombuffer(pa.concat_arrays([wide]).buffers()[1], np.uint64, 2 * len(wide)).reshape(-1, 2)
        high = _fixed(halves[:, 1] ^ _TOP, valid)
        low = np.where(valid, halves[:, 0], 0).astype(">u8").view(np.uint8).reshape(-1, 8)
        return np.hstack([high, low]), None
    if pa.types.is_date32(kind):
        col = col.cast(pa.int32())
    values = np.asarray(col.cast(pa.int8() if pa.types.is_boolean(kind) else pa.int64()).fill_null(0)).astype(np.int64)
    return _fixed(values.view(np.uint64) ^ _TOP, valid), None


def memcomparable(columns: list[pa.Array]) -> pa.Array:
    """Rows as bytes that compare, from the first byte on, as the rows do from the first column on: ascending, nulls first, no number after NaN. No row's bytes begin another's, unless the rows are equal."""
    rows, parts, fixed = len(columns[0]), [], []

    def flush() -> None:
        if fixed:
            block = np.ascontiguousarray(np.hstack(fixed))
            parts.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(block.shape[1]), rows, [None, pa.py_buffer(block)]).cast(pa.binary()))
            fixed.clear()

    for col in columns:
        head, body = _encoded(col)
        fixed.append(head)
        if body is not None:
            flush()
            parts.append(body)
            fixed.append(np.zeros((rows, 2), np.uint8))
    flush()
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


@F.arrow_udf(T.BinaryType())
def _ordered(rows: pa.Array) -> pa.Array:
    return memcomparable(rows.flatten())


def _plain(field: T.StructField) -> Column:
    """A column as it goes into keys. Nested ones, which have no order of their own, go as their JSON text."""
    col = F.col("row").getField(field.name)
    return F.to_json(F.struct(col)) if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else col


def fresh(taken: list[str], name: str) -> str:
    """name, with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def as_row(df: DataFrame) -> Column:
    """All columns as one, row: what else is worked out for a row can't clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def keyed(rows: DataFrame) -> DataFrame:
    """row and key, of row and lead: the crc32 of lead (a string; null counts as empty), the row's columns from left to right, and the row's place."""
    crc = F.crc32(F.coalesce("lead", F.lit("")).cast("binary"))
    values = F.struct(*[_plain(f).alias(str(k)) for k, f in enumerate(rows.schema["row"].dataType)], F.monotonically_increasing_id().alias("place"))
    return rows.select("row", F.concat(F.unhex(F.lpad(F.hex(crc), 8, "0")), _ordered(values)).alias("key"))


@dataclass
class Level:
    """A round of partitioning.

    spans: parent (rank of the first row of a bucket that was too large), most (rows that a bucket may have), depth (bytes of the key before those looked at), lo and shift: digit = (bytes looked at - lo) >> shift. digits: parent, digit, to (rank of the
    first row of the bucket that the digit is in), held (rows of that bucket) and open (is it still too large).
    """

    spans: DataFrame
    digits: DataFrame


def _small(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, broadcast where it is joined if it is small."""
    return few(written(df, name, tidy=False), BROADCAST_ROWS)


def _looked(depth: str) -> str:
    return f"cast(conv(rpad(hex(substring(key, cast({depth} AS int) + 1, {BYTES})), {2 * BYTES}, '0'), 16, 10) AS long)"


def _digit() -> Column:
    return F.expr(f"shiftright({_looked('depth')} - lo, cast(shift AS int))")


def walked(rows: DataFrame, levels: list[Level]) -> DataFrame:
    """rows (with key, and base: the rank of its table's first row) and parent, first and size: the rank of the first row of a row's bucket is parent if the bucket is still too large, else first, and size its rows."""
    own, none = [F.col(f"`{c}`") for c in rows.columns], F.lit(None).cast("long")
    at = rows.select("*", F.col("base").alias("parent"), none.alias("first"), none.alias("size"))
    for level in levels:
        at = at.join(level.spans, "parent", "left").withColumn("digit", _digit()).join(level.digits, ["parent", "digit"], "left")
        at = at.select(*own, F.when(F.col("open"), F.col("to")).alias("parent"), F.when(~F.col("open"), F.col("to")).otherwise(F.col("first")).alias("first"), F.when(~F.col("open"), F.col("held")).otherwise(F.col("size")).alias("size"))
    return at


def radix_levels(keys: DataFrame, sizes: list[tuple[int, int]]) -> list[Level]:
    """Rounds of partitioning until no bucket of a table has more than twice the rows that it may. keys: base, and key (binary, all different within a table); sizes: rows and most rows of a bucket for each table, one after another."""
    spark, levels = keys.sparkSession, []
    bits = [min(MOST_BITS, max(1, (n // most).bit_length() + SPARE_BITS)) for n, most in sizes]
    bases = np.cumsum([0, *[n for n, _ in sizes]]).tolist()
    every = [(base, most, 0, 0, 8 * BYTES - b) for base, (n, most), b in zip(bases, sizes, bits, strict=False) if n]
    spans = _small(spark.createDataFrame(every, "parent long, most long, depth long, lo long, shift long"), "spans")
    left = keys.select(F.col("base").alias("parent"), "key")  # those in buckets that are still too large
    while True:
        at = left.join(spans, "parent").withColumn("digit", _digit())
        counts = written(at.groupBy("parent", "digit").agg(F.first("most").alias("most"), F.count(F.lit(1)).alias("many")), "digits", tidy=False)
        before = F.sum("many").over(Window.partitionBy("parent").orderBy("digit")) - F.col("many")
        told = counts.withColumns({"before": before, "open": F.col("many") > F.col("most")}).withColumn("block", F.when(F.col("open"), F.col("digit")).otherwise(F.expr("before div most")))
        bucket = Window.partitionBy("parent", "open", "block")
        digits = told.select("parent", "digit", (F.col("parent") + F.min("before").over(bucket)).alias("to"), F.sum("many").over(bucket).alias("held"), "open")
        levels.append(Level(spans, _small(digits, "buckets")))
        large = levels[-1].digits.where("open").join(spans, "parent").select(F.col("to").alias("parent"), "most", "held", F.when(F.col("shift") > 0, F.col("depth")).otherwise(F.col("depth") + BYTES).alias("depth"))
        large = _small(large, "large-buckets")
        if large.isEmpty():
            return levels
        # where the bytes are those of all rows of a bucket, the next ones are looked at
        left = at.select("parent", "digit", "key").join(levels[-1].digits.where("open").select("parent", "digit", "to"), ["parent", "digit"]).select(F.col("to").alias("parent"), "key")
        left = written(left, "open-keys", tidy=False)
        seen = left.join(large, "parent").select("parent", "most", "held", "depth", F.expr(_looked("depth")).alias("x"), F.expr(_looked(f"depth + {BYTES}")).alias("y"))
        ends = seen.groupBy("parent", "most", "held", "depth").agg(*[f(c).alias(f"{name}_{c}") for c in "xy" for name, f in (("lo", F.min), ("hi", F.max))])
        same = F.col("lo_x") == F.col("hi_x")
        lo, hi = F.when(same, F.col("lo_y")).otherwise(F.col("lo_x")), F.when(same, F.col("hi_y")).otherwise(F.col("hi_x"))
        wanted = F.least(F.lit(MOST_BITS), F.ceil(F.log2(F.col("held") / F.col("most"))) + SPARE_BITS)
        shift = F.greatest(F.lit(0), F.length(F.bin(hi - lo)) - wanted).cast("long")
        spans = _small(ends.select("parent", "most", (F.col("depth") + F.when(same, F.lit(BYTES)).otherwise(F.lit(0))).alias("depth"), lo.alias("lo"), shift.alias("shift")), "spans")


def file_begins(keys: DataFrame, levels: list[Level]) -> dict[int, list[bytes]]:
    """The keys with which the files of each table begin, but for its first, sorted, by the table's base: one a file, FILES a table at most. keys: base, key and per (rows of a file).

    Buckets are ranks counted; only keys of buckets in which a file begins are sorted.
    """
    first = F.col("first") - F.col("base")
    cut = walked(keys, levels).withColumn("first", first).where("(first + size - 1) div per > (first - 1) div per")
    rank = F.col("first") + F.row_number().over(Window.partitionBy("base", "first").orderBy("key")) - 1
    out: dict[int, list[bytes]] = {}
    for r in cut.withColumn("rank", rank).where("rank > 0 AND rank % per = 0").select("base", "key").collect():
        out.setdefault(r["base"], []).append(bytes(r["key"]))
    return {base: sorted(found) for base, found in out.items()}


def with_passed(rows: DataFrame, key: str, begins: list[bytes], out: str) -> DataFrame:
    """rows and, as out, how many of begins (sorted) are not greater than key: strides of them are counted first, then those of one stride."""
    if not begins:
        return rows.withColumn(out, F.lit(0).cast("long"))
    stride = math.isqrt(len(begins))
    said = lambda some: F.array(*[F.lit(x) for x in some])
    passed = lambda some: F.size(F.filter(some, lambda x: x <= F.col(key)))
    before = rows.withColumn("__strides", passed(said(begins[::stride])))
    start = (F.greatest(F.col("__strides"), F.lit(1)) - 1) * stride
    return before.withColumn(out, (start + passed(F.slice(said(begins), start + 1, F.lit(stride)))).cast("long")).drop("__strides")


@dataclass
class Stored:
    """A table as files: <path>/<file>=<number>/ has one Parquet file of per_file consecutive rows of its sorted rows, the last the rest."""

    name: str
    path: str
    file: str
    schema: T.StructType
    rows: int
    per_file: int

    def tasks(self, spark: SparkSession) -> int:
        """Tasks that its rows are dealt to by their files. A task takes some files, one after another."""
        return max(1, min(-(-self.rows // self.per_file), deal_width(spark) + self.rows // TASK_ROWS))

    def read(self, spark: SparkSession, *more: Column) -> DataFrame:
        """file, at (a row's place in its file), row and more."""
        every = spark.read.schema(T.StructType([*self.schema.fields, T.StructField(self.file, T.LongType())])).parquet(self.path)
        row = F.struct(*[F.col(f"`{c}`") for c in self.schema.names]).alias("row")
        return every.select(F.col(f"`{self.file}`").alias("file"), F.col("_metadata.row_index").alias("at"), row, *more)


def together(do, items: list) -> list:
    """do(*item) for all items at once, each in a thread of the driver: what runs in Spark are small steps of one table each, which leave most of a cluster idle."""
    with ThreadPoolExecutor(len(items)) as pool:
        return [f.result() for f in [pool.submit(do, *item) for item in items]]


def _written_by_file(rows: DataFrame, table: Stored, path: str) -> None:
    """rows: file, at (their order in it), row."""
    dealt = rows.repartition(table.tasks(rows.sparkSession), "file").sortWithinPartitions("file", "at")
    dealt.select("row.*", F.col("file").alias(table.file)).write.partitionBy(table.file).parquet(path)


def sorted_files(tables: dict[str, DataFrame], folder: str, files: int = FILES) -> dict[str, Stored]:
    """Writes each table's rows (row, and lead, a string) sorted by the crc32 of lead, then by all columns of row from left to right, ascending, nulls first, as files of 1 + floor(n / files) rows.

    Rows that are alike are kept as often as they occur. An empty table has no files.
    """
    keys = dict(zip(tables, together(lambda rows: (k := written(keyed(rows), "keyed", tidy=False), k.count()), [(x,) for x in tables.values()]), strict=True))
    out, base, based, starts = {}, 0, {}, {}
    for name, (k, n) in keys.items():
        kind = k.schema["row"].dataType
        out[name] = Stored(name, f"{folder}/{name}", fresh(kind.names, "file"), kind, n, 1 + n // files)
        based[name] = k.withColumn("base", F.lit(base).cast("long"))
        starts[name] = base
        base += n
    sizes = [(t.rows, max(LEAST_ROWS, t.per_file // BUCKETS)) for t in out.values()]
    levels = radix_levels(reduce(DataFrame.unionByName, [k.select("base", "key") for k in based.values()]), sizes) if base else []
    begins = file_begins(reduce(DataFrame.unionByName, [based[name].select("base", "key", F.lit(t.per_file).cast("long").alias("per")) for name, t in out.items()]), levels)

    def put(table: Stored, rows: DataFrame, first: list[bytes]) -> None:
        _written_by_file(with_passed(rows.select("row", F.col("key").alias("at")), "at", first, "file"), table, table.path)

    together(put, [(t, keys[name][0], begins.get(starts[name], [])) for name, t in out.items()])
    collected(keys[name][0].sparkSession)
    return out


def victims_by_file(spark: SparkSession, erased: list[tuple[Stored, str, DataFrame]]) -> DataFrame:
    """table_name, file and ids (sorted) for each file that holds a victim: the ids of its victims. erased: tables, the columns of their ids, and victims (a column of ids, in any order)."""
    held = [t.read(spark, F.col(f"`{c}`").cast("long").alias("id")).select(F.lit(t.name).alias("table_name"), "file", "id") for t, c, _ in erased]
    named = [v.toDF("id").select(F.lit(t.name).alias("table_name"), F.col("id").cast("long").alias("id")) for t, _, v in erased]
    asked = written(reduce(DataFrame.union, named).where("id IS NOT NULL").distinct(), "victims", tidy=False)
    met = reduce(DataFrame.union, held).where("id IS NOT NULL").distinct().join(few(asked, BROADCAST_ROWS), ["table_name", "id"], "left_semi")
    return _small(met.groupBy("table_name", "file").agg(F.sort_array(F.collect_list("id")).alias("ids")), "victims-by-file")


def rewritten(table: Stored, spark: SparkSession, id_col: str, victims: DataFrame) -> None:
    """Writes the files of victims (see victims_by_file) again without the rows whose id is among the victims; a file that none are left of goes.

    New files are written beside the table and only then take the places of the old ones, so a failure before leaves the table as it was.
    """
    found = victims.where(F.col("table_name") == table.name).select("file", "ids")
    rows = table.read(spark, F.col(f"`{id_col}`").cast("long").alias("id")).join(found.select("file"), "file", "left_semi").select("row", "file", "at", "id")
    kind = rows.schema["row"].dataType
    heads = found.select(F.lit(None).cast(kind).alias("row"), "file", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("id"), "ids")
    stream = rows.withColumn("ids", F.lit(None).cast("array<long>")).unionByName(heads).repartition(table.tasks(spark), "file").sortWithinPartitions("file", "at")

    def survivors(batches):
        gone = np.zeros(0, np.int64)
        for batch in batches:
            ids, heads_ = batch.column(3), batch.column(4)
            numbers, keep = np.asarray(ids.fill_null(0)), np.asarray(heads_.is_null()).copy()
            known = np.asarray(ids.is_valid())
            starts = np.flatnonzero(~keep).tolist()
            for a, b in zip([0, *starts], [*starts, batch.num_rows], strict=True):
                if a < b and not keep[a]:
                    gone = np.asarray(heads_[a].values, np.int64)
                at = np.minimum(np.searchsorted(gone, numbers[a:b]), max(len(gone) - 1, 0))
                if len(gone):
                    keep[a:b] &= ~(known[a:b] & (gone[at] == numbers[a:b]))
            yield batch.filter(pa.array(keep)).select([0, 1, 2])

    bounded_batches(spark)
    left = stream.mapInArrow(survivors, T.StructType([T.StructField("row", kind), T.StructField("file", T.LongType()), T.StructField("at", T.LongType())]))
    staged = f"{table.path}-staged"
    _written_by_file(left, table, staged)
    files, root = _file(spark, table.path)
    new = _file(spark, staged)[1]
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for r in found.select("file").toLocalIterator():
        here, there = Path(root, f"{table.file}={r['file']}"), Path(new, f"{table.file}={r['file']}")
        old = [x.getPath() for x in files.listStatus(here)]
        for x in files.listStatus(there) if files.exists(there) else []:
            files.rename(x.getPath(), Path(here, x.getPath().getName()))
        for path in old:
            files.delete(path, True)
        if not files.listStatus(here):
            files.delete(here, True)
    files.delete(new, True)


def file_facts(spark: SparkSession, tables: list[tuple[Stored, str]]) -> DataFrame:
    """table_name, file, path, n_rows, cents (sum of floor(100 * amount + 0.5), null 0) and ids_sha256 (of the first column in the file's order, decimal, null empty, comma-joined), for each file of the tables, given with the columns of their amounts."""

    def narrow(table: Stored, amount: str) -> DataFrame:
        first = F.coalesce(F.col(f"`{table.schema.names[0]}`").cast("string"), F.lit("")).alias("id")
        cents = F.coalesce(F.floor(F.col(f"`{amount}`") * 100 + 0.5), F.lit(0)).cast("long").alias("cents")
        rows = table.read(spark, F.col("_metadata.file_path").alias("path"), first, cents)
        return rows.select(F.lit(table.name).alias("table_name"), "file", "path", "at", "id", "cents")

    stream = reduce(DataFrame.union, [narrow(*x) for x in tables]).repartition(sum(t.tasks(spark) for t, _ in tables), "table_name", "file").sortWithinPartitions("table_name", "file", "at")
    names = ["table_name", "file", "path", "n_rows", "cents", "ids_sha256"]

    def summed(batches):
        now, n, total, digest = None, 0, 0, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, n, total, digest.hexdigest())], names)
        for batch in batches:
            of, which = np.asarray(batch.column(1)), batch.column(0).dictionary_encode().indices
            which = np.asarray(which)
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (which[1:] != which[:-1])) + 1).tolist(), len(of)] if len(of) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                here = tuple(batch.column(k)[a].as_py() for k in range(3))
                if here != now:
                    if now is not None:
                        yield done()
                    now, n, total, digest = here, 0, 0, hashlib.sha256()
                digest.update((("," if n else "") + ",".join(batch.column(4).slice(a, b - a).to_pylist())).encode())
                n += b - a
                total += sum(batch.column(5).slice(a, b - a).to_pylist())
        if now is not None:
            yield done()

    return stream.mapInArrow(summed, "table_name string, file long, path string, n_rows long, cents long, ids_sha256 string")


def erase(spark: SparkSession, erased: list[tuple[Stored, str, DataFrame, str]]) -> DataFrame:
    """Erases the rows whose ids are among the victims (tables, the columns of their ids, victims, and the columns of their amounts), and returns file_facts of the files that are left, with file_no, n_erased, rewritten and columns."""
    found = victims_by_file(spark, [x[:3] for x in erased])
    together(lambda table, id_col: rewritten(table, spark, id_col, found), [x[:2] for x in erased])
    left = written(file_facts(spark, [(x[0], x[3]) for x in erased]), "files")
    known = spark.createDataFrame([(t.name, t.rows, t.per_file, ",".join(t.schema.names)) for t, *_ in erased], "table_name string, rows long, per long, columns string")
    told = left.join(F.broadcast(known), "table_name").join(found.select("table_name", "file", F.lit(True).alias("hit")), ["table_name", "file"], "left")
    held = F.least(F.col("per"), F.col("rows") - F.col("file") * F.col("per"))
    return told.select("table_name", F.col("file").alias("file_no"), "n_rows", (held - F.col("n_rows")).alias("n_erased"), "cents", F.coalesce("hit", F.lit(False)).alias("rewritten"), "ids_sha256", "columns", "path")


def victim_masters(clients: DataFrame, clicks: DataFrame, every: int = 100) -> DataFrame:
    """master_id of those with a crc32 (of decimal) divisible by `every`, and of the one whose clients together have most clicks (of several, the smallest)."""
    known = clients.where("master_id IS NOT NULL").select("master_id", "client_id").distinct()
    drawn = known.where(F.crc32(F.col("master_id").cast("string").cast("binary")) % every == 0).select("master_id")
    counts = clicks.groupBy("client_id").agg(F.count(F.lit(1)).alias("many"))
    sums = known.join(counts, "client_id", "left").groupBy("master_id").agg(F.coalesce(F.sum("many"), F.lit(0)).alias("many"))
    return drawn.union(sums.orderBy(F.desc("many"), "master_id").limit(1).select("master_id")).distinct()


def erase_masters(clients: DataFrame, clicks: DataFrame, sales: DataFrame, sale_lines: DataFrame, every: int = 100, files: int = FILES) -> DataFrame:
    """Writes the four tables as sorted files into a new folder of the shared one and erases the victims' rows from them: the clients of victim_masters, these clients' clicks and sales, and these sales' lines.

    Returns table_name and what erase() tells of each file that is left. Rows follow the crc32 of their client, that of a line being its sale's (of a sale_id with several rows, the least). Null ids are no victims and have no client; repeated
    rows are kept or erased together; empty tables have no files; columns may be more than the known ones, of any names, nested ones too. The folder stays.
    """
    spark = clients.sparkSession
    folder = f"{shared_folder(spark)}/erasure-{uuid.uuid4().hex}"
    owner = written(sales.where("sale_id IS NOT NULL").groupBy("sale_id").agg(F.min("client_id").alias("of")), "sale-clients", tidy=False)
    masters = _small(victim_masters(clients, clicks, every), "victim-masters")
    gone = _small(clients.join(masters, "master_id", "left_semi").where("client_id IS NOT NULL").select("client_id").distinct(), "victim-clients")
    gone_sales = sales.join(gone, "client_id", "left_semi").select("sale_id").distinct()

    led = lambda df: df.select(as_row(df), F.col("client_id").cast("string").alias("lead"))
    lines = sale_lines.select(as_row(sale_lines), "sale_id").join(owner, "sale_id", "left").select("row", F.col("of").cast("string").alias("lead"))
    stored = sorted_files({"clients": led(clients), "clicks": led(clicks), "sales": led(sales), "sale_lines": lines}, folder, files)
    asked = (("clients", "master_id", masters, "balance"), ("clicks", "client_id", gone, "value"), ("sales", "client_id", gone, "total"), ("sale_lines", "sale_id", gone_sales, "amount"))
    return erase(spark, [(stored[name], id_col, victims, amount) for name, id_col, victims, amount in asked])
