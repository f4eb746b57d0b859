"""Mixing sources to target weights: blocks of words, multinomial counts, and a join of blocks by index.

Each source's documents, in a seeded order, are one stream of words, packed into blocks of BLOCK_WORDS. A source's target says how many of its words the mix takes: whole passes over
the stream and the rest of one more, so many slots. How many of a source's slots each output shard gets is drawn, multinomial with equal chances given the sources' totals, which meet the targets: slots are halved again and again, and the size of a half is
the number of ones among as many seeded random bits. Slot j of a source takes the block at a pseudorandom permutation (a Feistel network over the block numbers, another one for each pass) of j, so a pass takes
every block once; shards have consecutive slots. Slots and blocks meet by (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.support import expanded, few, row_key, scratch, without_repeats, word_count, written

BLOCK_WORDS = 64
#: Weights of the sources in the order of their names, repeating; share of all words that the mix has; passes over a source at most.
WEIGHTS, SHARE, PASSES = (5.0, 2.0, 1.0), 1.5, 2
#: Documents whose places in their source are summed in one task, on average.
RUN_DOCS = 2_000
#: Applications of the network to numbers that fall outside, before the longer walk; see permuted().
WALK = 64
#: Output shards, a power of two.
SHARDS = 16
#: Documents and passes (about 100 bytes each) up to which what the mix takes of them is broadcast to the texts; beyond, texts move once.
BROADCAST_ROWS = 400_000


def measured(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, size in words and p and q (see row_key) of id, source and text for each row."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"), *row_key(id_col, source_col, text_col))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """source, sid, source_size, target for each source: words by weight; none over passes times its size, what is over goes to the others by weight.

    Sources that reach their limit are those with the least limit for their weight, so after sorting by that the level is found from running sums. Sources are one row each here; a
    null source is one too, after all others.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = each.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = named.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(passes))
    order = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spent = F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1))
    level = (F.sum("source_size").over(everything) * share - F.coalesce(spent, F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    tried = limit.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("most") / F.col("weight"))
    first = F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.col("most") / F.col("weight"))).over(everything)
    return tried.withColumn("level", first).select("source", "sid", "source_size", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("target"))


def permuted(i: Column, n: Column, *key: Column, walk_steps: int = WALK) -> Column:
    """The image of i under a pseudorandom permutation of 0 .. n - 1.

    Four rounds of an unbalanced Feistel network over a grid of a by c cells, a = ceil(sqrt(n)), c = ceil(n / a); images outside of n go through again until they are inside.
    Fewer than a cells are outside, so a steps are always enough. More than 2 or 3 are rare for large n: WALK are taken first, and the rest of the a only by a number that is still outside then.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    c = F.ceil(n / a).cast("long")

    def through(x: Column) -> Column:
        left, right = F.floor(x / c).cast("long"), F.pmod(x, c)
        for k in range(2):
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(2 * k), right, *key), a), a)
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(2 * k + 1), left, *key), c), c)
        return left * c + right

    once = through(i)

    def walk(x: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), x, lambda y, _: F.when(y >= n, through(y)).otherwise(y))

    again = walk(once, F.lit(walk_steps).cast("long"))
    return F.when(once < n, once).otherwise(F.transform(F.array(again), lambda x: F.when(x < n, x).otherwise(walk(x, a)))[0])


def drawn(slots: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """sid and ends (the slot after the last of each shard) from sid and slots: multinomial counts, as sums of random bits."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    parts = slots.select("sid", F.lit(0).alias("part"), F.col("slots").cast("long").alias("n"))
    for level in range(shards.bit_length() - 1):
        longs = expanded(parts.select("sid", "part", "n", F.expr("(n + 63) div 64").alias("longs")), "longs", "k")
        bits = F.xxhash64(F.lit(seed), F.lit(level), "sid", "part", "k")
        own = F.least(F.col("n") - F.col("k") * 64, F.lit(64)).cast("int")
        ones = F.sum(F.bit_count(F.call_function("shiftrightunsigned", bits, 64 - own)).cast("long"))
        halves = parts.join(longs.groupBy("sid", "part").agg(ones.alias("ones")), ["sid", "part"], "left").withColumn("ones", F.coalesce("ones", F.lit(0).cast("long")))
        two = F.array(F.struct((2 * F.col("part")).alias("part"), F.col("ones").alias("n")), F.struct((2 * F.col("part") + 1).alias("part"), (F.col("n") - F.col("ones")).alias("n")))
        parts = written(halves.select("sid", F.explode(two).alias("h")).select("sid", "h.part", "h.n"), "drawn-counts")
    counts = parts.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("c"))
    upto = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(F.slice("c", F.lit(1), k), F.lit(0).cast("long"), lambda s, x: s + x["n"]))
    return counts.select("sid", upto.alias("ends"))


def mixture(sizes: DataFrame, aims: DataFrame, shards: int = SHARDS, seed: int = 7, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What the mix takes: shard, sid, slot, pass, p, q, size, copy, first word and number of words.

    sizes and aims are the written tables of measured() and targets(). Rows alike in source, doc_id and text are copies 0, 1, ... of one document.
    """
    docs = sizes.where("size > 0").join(aims.select("source", "sid"), sizes["source"].eqNullSafe(aims["source"])).drop("source")
    units = docs.groupBy("sid", "p", "q", "size").agg(F.count(F.lit(1)).alias("copies"))
    runs = max(1, sizes.count() // RUN_DOCS)
    units = units.withColumn("draw", F.xxhash64(F.lit(seed), "p", "q")).withColumn("run", F.pmod("draw", F.lit(runs)))
    words = F.col("size") * F.col("copies")
    ahead = units.groupBy("sid", "run").agg(F.sum(words).alias("in_run"))
    ahead = ahead.select("sid", "run", (F.sum("in_run").over(Window.partitionBy("sid").orderBy("run")) - F.col("in_run")).alias("ahead"))
    inside = F.sum(words).over(Window.partitionBy("sid", "run").orderBy("draw", "p", "q").rowsBetween(Window.unboundedPreceding, 0)) - words
    placed = units.withColumn("inside", inside).join(ahead, ["sid", "run"]).withColumn("start", F.col("ahead") + F.col("inside"))
    placed = placed.withColumn("end", F.col("start") + words).withColumn("block0", F.expr(f"start div {block_words}")).withColumn("blocks", F.expr(f"(end - 1) div {block_words}") - F.col("block0") + 1)
    cut = expanded(placed.select("sid", "p", "q", "size", "start", "end", "block0", "blocks"), "blocks", "b").withColumn("block", F.col("block0") + F.col("b"))
    low, high = F.greatest(F.col("start"), F.col("block") * block_words), F.least(F.col("end"), (F.col("block") + 1) * block_words)
    cut = cut.withColumn("low", low).withColumn("high", high)
    cut = cut.withColumn("copy", F.explode(F.sequence(F.expr("(low - start) div size"), F.expr("(high - 1 - start) div size"))))
    begins = F.col("start") + F.col("copy") * F.col("size")
    low = F.greatest(F.col("low"), begins)
    pieces = cut.select("sid", "block", "p", "q", "size", "copy", (low - begins).alias("first"), (F.least(F.col("high"), begins + F.col("size")) - low).alias("n"), (low - F.col("block") * block_words).alias("off"))

    aim = aims.where("source_size > 0").withColumn("words", F.least(F.round("target").cast("long"), F.col("source_size") * PASSES))
    aim = aim.withColumn("blocks", F.expr(f"(source_size + {block_words - 1}) div {block_words}")).withColumn("whole", F.expr("words div source_size")).withColumn("rest", F.expr("words % source_size"))
    aim = aim.withColumn("slots", F.col("whole") * F.col("blocks") + F.expr(f"(rest + {block_words - 1}) div {block_words}"))
    aim = written(aim.select("sid", "blocks", "whole", "rest", "slots"), "slots")
    slots = expanded(aim.join(drawn(aim, shards, seed + 1), "sid"), "slots", "slot")
    last = (F.col("slot") == F.col("slots") - 1) & (F.col("rest") > 0)
    slots = slots.withColumn("pass", F.expr("slot div blocks")).select(
        "sid",
        permuted(F.expr("slot % blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), F.col("pass")).alias("block"),
        "slot",
        "pass",
        F.when(last, F.col("rest") - F.expr(f"(rest - 1) div {block_words}") * block_words).otherwise(F.lit(block_words)).alias("room"),
        F.size(F.filter("ends", lambda e: e <= F.col("slot"))).alias("shard"),
    )
    # Rows that were spelled out are many more than their plan says: never broadcast them.
    taken = slots.hint("merge").join(pieces, ["sid", "block"]).withColumn("taken", F.least(F.col("n"), F.col("room") - F.col("off")))
    return taken.where("taken > 0").select("shard", "sid", "slot", "pass", "p", "q", "size", "copy", "first", F.col("taken").alias("words"))


def mix_accounts(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", shards: int = SHARDS, **options) -> DataFrame:
    """For each row of docs: doc_id, size, source_size, target (of its source), taken (words that the mix takes of it, repeats counted), shard_words (those of each output shard).

    Null and empty texts have size 0 and nothing is taken of them. A null source is a source of its own, and null ids are ids like any other. Rows alike in id, source and text count each for itself.
    A source's taken words meet its target but for less than one block; no row gives more than twice its size. An empty table gives an empty result. Other columns are ignored. The same table gives the
    same result in any layout.
    """
    with scratch(docs.sparkSession):
        sizes = written(measured(docs, id_col, source_col, text_col), "sizes")
        aims = written(targets(sizes), "targets")
        by_shard = [F.coalesce(F.sum(F.when(F.col("shard") == k, F.col("words"))), F.lit(0).cast("long")) for k in range(shards)]
        got = mixture(sizes, aims, shards=shards, **options).groupBy("p", "q", "copy").agg(F.sum("words").alias("taken"), F.array(*by_shard).alias("shard_words"))
        rows = sizes.groupBy("p", "q", "source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
        rows = rows.join(aims, rows["source"].eqNullSafe(aims["source"])).drop("source")
        rows = rows.where("copies = 1").withColumn("copy", F.lit(0).cast("long")).unionByName(expanded(rows.where("copies > 1"), "copies", "copy"))
        joined = rows.join(got.hint("merge"), ["p", "q", "copy"], "left")
        none = F.array_repeat(F.lit(0).cast("long"), shards)
        out = joined.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("shard_words", none).alias("shard_words"))
        return written(out, "accounts", lasting=True)


def mixed_documents(docs: DataFrame, columns: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block_words: int = 1024, seed: int = 7) -> DataFrame:
    """The mix as documents: a row for each document and pass, with the words taken (and the white space before them); whole where all were taken.

    Rows whose text is null, empty or blank have no words, so the mix takes nothing of them and they aren't in the result. Rows alike in id, source and text take the other columns from one of them. A null id or source is a value like
    any other. n_chars, if there, is the length of the new text. Columns may have any names. An empty table gives an empty result.
    """
    with scratch(docs.sparkSession):
        sizes = written(measured(docs, id_col, source_col, text_col), "sizes")
        aims = written(targets(sizes), "targets")
        got = mixture(sizes, aims, seed=seed, block_words=block_words).groupBy("p", "q", "size", "copy", "pass")
        got = got.agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans"), F.sum("words").alias("taken"))
        got = written(got, "taken-words", lasting=True)
    one = without_repeats(docs, id_col, source_col, text_col)
    others = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in columns if c != text_col]).alias("row")
    both = one.select(others, F.col(f"`{text_col}`").alias("text"), *row_key(id_col, source_col, text_col)).join(few(got, BROADCAST_ROWS), ["p", "q"])
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(words, (s["first"] + 1).cast("int"), s["words"].cast("int")))), "")
    out = both.withColumn("new", F.when(F.col("taken") == F.col("size"), F.col("text")).otherwise(F.ltrim(part)))
    return out.select(*[F.col("new").alias(c) if c == text_col else F.length("new").cast("long").alias(c) if c == "n_chars" else F.col("row").getField(c).alias(c) for c in columns])
