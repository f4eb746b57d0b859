"""Exact duplicates by deterministic block naming (after Karp, Miller and Rosenberg).

The normalised text is cut into blocks of a fixed number of bytes. The distinct blocks of the corpus are sorted and each gets an integer name. Then
adjacent names are paired, the distinct pairs are sorted and named, and so on, until every document has one name. Two documents have the same
name (at the same level) if and only if their texts are equal: names stand for sorted distinct contents, never for hashes of them. The hash that rows carry from the
text scan to the dictionary of blocks only shortens the key; where two blocks share it, they are looked up by content.

A block that many documents share is one row per task before any shuffle (the distinct is combined on the map side), and the join that hands names
back has exchanges that Spark splits where they are skewed. No step gathers a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.support import squeezed, written

#: Bytes of a block. Most web documents are one or two of them, so few levels have many rows.
BLOCK_BYTES = 4096
NONE = -(1 << 63)


def _blocks(bits: Column) -> Column:
    last = F.greatest(F.floor((F.length(bits) - 1) / BLOCK_BYTES), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(bits, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)))


def _short(block: Column, key_bits: int) -> Column:
    key = F.xxhash64(block)
    return key if key_bits >= 64 else key.bitwiseAND(F.lit((1 << key_bits) - 1))


def label_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Null text counts as empty, and an empty text is one empty block; so empty and null texts are one group. Of equal texts the smallest doc_id stays. A null doc_id is
    larger than any other; if all of a group are null, keep_id is null. Rows that agree in doc_id and text are ties: one of them is kept. An empty table gives an
    empty result. Other columns are ignored, whatever their names. key_bits exists for tests, which make it small so that keys clash.
    """
    text = docs.select(F.col(f"`{id_col}`").alias("doc_id"), squeezed(F.col(f"`{text_col}`")).alias("norm"))
    cut = text.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "norm", _blocks(F.col("norm").cast("binary")).alias("blocks"))
    rows = written(cut.select("rid", "doc_id", F.sha2("norm", 256).alias("sha"), F.transform("blocks", lambda b: _short(b, key_bits)).alias("keys")), "named-rows")

    content = cut.select(F.explode("blocks").alias("block")).select(_short(F.col("block"), key_bits).alias("key"), "block")
    names = written(content.distinct().sortWithinPartitions("block").select("key", F.monotonically_increasing_id().alias("name")), "block-names")
    shared = names.groupBy("key").count().where("count > 1").select("key")

    found = rows.select("rid", "doc_id", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    if shared.isEmpty():
        level = found.join(names, "key")
    else:  # different blocks under one key: these are named by content
        shared = written(shared, "shared-keys")
        clash = content.join(shared, "key", "left_semi").distinct().sortWithinPartitions("block")
        clash = written(clash.select("key", "block", (-1 - F.monotonically_increasing_id()).alias("name")), "clashing-names")
        again = cut.select("rid", "doc_id", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block")).withColumn("key", _short(F.col("block"), key_bits))
        level = found.join(shared, "key", "left_anti").join(names, "key").unionByName(again.join(clash, ["key", "block"]).drop("block"))
    level = written(level.select("rid", "doc_id", "n", "pos", "name"), "level-0")

    depth, most = 0, rows.agg(F.max(F.size("keys"))).first()[0] or 1
    named = level.where("n = 1").select("rid", "doc_id", F.lit(0).alias("level"), "name")
    while most > 1:
        depth, most = depth + 1, (most + 1) // 2
        pairs = (
            level.where("n > 1")
            .groupBy("rid", "doc_id", F.floor((F.col("n") + 1) / 2).cast("int").alias("n"), F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("b"))
        )
        pairs = written(pairs, f"pairs-{depth}")
        names = written(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b").select("a", "b", F.monotonically_increasing_id().alias("name")), f"pair-names-{depth}")
        level = written(pairs.join(names, ["a", "b"]).select("rid", "doc_id", "n", "pos", "name"), f"level-{depth}")
        named = named.unionByName(level.where("n = 1").select("rid", "doc_id", F.lit(depth).alias("level"), "name"))

    groups = named.groupBy("level", "name").agg(F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rid")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    marked = named.join(groups, ["level", "name"]).select("rid", F.col("keeper.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keeper.rid")).alias("kept"))
    return rows.join(marked, "rid").select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
