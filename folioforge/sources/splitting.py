"""Large files of one JSON array, and CSV with quoted line feeds, read by many tasks a file.

Spark cuts a file into blocks at any separator, so pieces between commas (or line feeds) come from many tasks at once. Whether a piece begins inside of quotes, and how deep in brackets, follows from all before it: both are sums that
can be taken by block. Each block says its count of quotes and its change of depth for either state that it may begin in; those few numbers are scanned over a file's blocks, and then each piece knows where it stands. Pieces
that belong together meet by the number of their record. No step holds more of a file than a block, or a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.sources.files import decoded

_CORRUPT = "_corrupt_record"


def _pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """path, block and at (in order within a block) of each piece, and value."""
    read = spark.read.option("lineSep", separator).text(path)
    return read.select(decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def _before(*order: str, upto: int = -1):
    """Sums over what comes before (or, upto 0, with the row itself) in a block, or in a file if the order is that of blocks."""
    keys = ("path",) if order == ("block",) else ("path", "block")
    return lambda c: F.coalesce(F.sum(c).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)), F.lit(0)).cast("long")


def _placed(pieces: DataFrame, separates: Column, separator: str) -> tuple[DataFrame, DataFrame]:
    """path, ord and text of each record; path, last (ord) and sound for each file.

    pieces: path, block, at, value, quotes, and d0 and d1, the change of depth by what is outside of quotes if the piece begins outside or inside of them. separates says, of `inside` and `level` where a piece begins, whether it begins a record.
    """
    in_block, in_file = _before("at"), _before("block")
    own = pieces.withColumn("odd", in_block("quotes") % 2)
    for k in (0, 1):
        own = own.withColumn(f"e{k}", F.when(F.col("odd") == k, F.col("d0")).otherwise(F.col("d1")))
    blocks = own.groupBy("path", "block").agg(F.sum("quotes").alias("q"), F.sum("e0").alias("s0"), F.sum("e1").alias("s1"))
    blocks = blocks.withColumn("odd0", in_file("q") % 2).withColumn("s", F.when(F.col("odd0") == 0, F.col("s0")).otherwise(F.col("s1"))).withColumn("level0", in_file("s"))
    known = own.join(blocks.select("path", "block", "odd0", "level0"), ["path", "block"])
    known = known.withColumn("inside", (F.col("odd") + F.col("odd0")) % 2).withColumn("d", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    known = known.withColumn("level", F.col("level0") + in_block("d")).withColumn("new", separates.cast("long"))
    firsts = known.groupBy("path", "block").agg(F.sum("new").alias("n")).withColumn("ord0", in_file("n"))
    files = firsts.groupBy("path").agg(F.sum("n").alias("last")).join(blocks.groupBy("path").agg(((F.sum("q") % 2 == 0) & (F.sum("s") == 0)).alias("sound")), "path")
    numbered = known.withColumn("nth", _before("at", upto=0)("new")).join(firsts.select("path", "block", "ord0"), ["path", "block"])
    piece = F.struct("block", "at", "value")
    together = numbered.groupBy("path", (F.col("ord0") + F.col("nth")).alias("ord")).agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return together.select("path", "ord", F.array_join(F.transform("p", lambda x: x["value"]), separator).alias("text")), files


def array_records(spark: SparkSession, path: str | list[str], schema: str, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """path, ord (from 0) and the fields of each record of files that hold one JSON array each; path and record of what couldn't be read.

    Lenient: a record that can't be read is reported, and a file whose brackets or quotes don't end, or that isn't an array, is reported with a null record; its other records are read. Strict: either is an error when it is read. An empty array, or an empty file, has no records.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = _pieces(spark, path, ",").withColumn("parts", F.split(bare, '"', -1)).withColumn("quotes", F.size("parts") - 1)
    for name, keeps in (("d0", lambda x, i: i % 2 == 0), ("d1", lambda x, i: i % 2 == 1)):
        seen = F.array_join(F.filter("parts", keeps), "")
        pieces = pieces.withColumn(name, F.length(F.regexp_replace(seen, r"[^\[{]", "")) - F.length(F.regexp_replace(seen, r"[^\]}]", "")))
    records, files = _placed(pieces.drop("parts"), (F.col("inside") == 0) & (F.col("level") == 1), ",")
    held = records.join(files, "path").withColumn("last", F.col("ord") == F.col("last"))
    opened = F.when(F.col("ord") == 0, F.regexp_replace("text", r"^﻿?\s*\[", "")).otherwise(F.col("text"))
    closed = F.when(F.col("last"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    is_array = ((F.col("ord") != 0) | F.col("text").rlike(r"^﻿?\s*\[")) & (~F.col("last") | F.col("text").rlike(r"\]\s*$"))
    held = held.select("path", "ord", F.regexp_replace(closed, r"^\s+|\s+$", "").alias("record"), (~F.col("sound") | ~is_array).alias("broken"), (F.col("ord") == 0).alias("first"), "last", "text")
    none = F.col("first") & F.col("last") & (F.col("record") == "")
    real = held.where(~none)
    broken = held.where(F.col("broken") & F.regexp_replace("text", r"^[\s﻿]+$", "").rlike(r"(?s).")).select("path").distinct()
    if not lenient:
        said = F.concat(F.lit("not a JSON array: "), F.col("path"))
        checked = real.withColumn("record", F.when(F.col("broken"), F.raise_error(said).cast("string")).otherwise(F.col("record")))
        good = checked.withColumn("r", F.from_json("record", schema, {"mode": "FAILFAST"}))
        return good.select("path", "ord", "r.*"), spark.createDataFrame([], "path string, record string")
    parsed = real.withColumn("r", F.from_json("record", f"{schema}, {_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    bad = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    good = parsed.where(~bad).select("path", "ord", "r.*").drop(_CORRUPT)
    return good, parsed.where(bad).select("path", "record").unionByName(broken.select("path", F.lit(None).cast("string").alias("record")))


def csv_records(spark: SparkSession, path: str | list[str], schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """path, ord (from 0, the header not counted) and the fields of each record of CSV files, by place; path and record of what couldn't be read. Quoted fields may hold line feeds, and quotes in them are doubled. Blank lines are no records."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    pieces = _pieces(spark, path, "\n").withColumns({"quotes": quotes, "d0": F.lit(0), "d1": F.lit(0)})
    records, files = _placed(pieces, F.col("inside") == 0, "\n")
    # every line that begins outside of quotes begins a record, so the first has number 1
    rows = records.withColumn("ord", F.col("ord") - (2 if header else 1)).where("ord >= 0").withColumn("text", F.regexp_replace(F.when(F.col("ord") == 0, F.regexp_replace("text", "^﻿", "")).otherwise(F.col("text")), r"\r$", ""))
    rows = rows.where(F.length("text") > 0)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "escape": '"', "multiLine": "true"}
    parsed = rows.join(files.select("path", "sound"), "path").withColumn("r", F.from_csv("text", f"{schema}, {_CORRUPT} string", options))
    odd = F.col(f"r.{_CORRUPT}").isNotNull()
    unended = ~F.col("sound") & F.col("text").rlike('(?s)^[^"]*("[^"]*"[^"]*)*"[^"]*$') & (F.length(F.regexp_replace("text", '[^"]', "")) % 2 == 1)
    return parsed.where(~odd & ~unended).select("path", "ord", "r.*").drop(_CORRUPT), parsed.where(odd | unended).select("path", F.col("text").alias("record"))
