"""Benchmark decontamination by spaced-seed hashing. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, materialize, row_tag

#: Fixed masks: token positions of a seed that count; those between may be substituted. All begin with two adjacent tokens. Every window of 13 tokens with
#: two substitutions, and of 15 with three, holds a seed of one of them; the last, without gaps, is for items too short for the others.
MASKS = ((0, 1, 3, 6, 7), (0, 1, 3, 8, 9), (0, 1, 2, 3, 4))
#: Tokens of a document that one row holds.
CHUNK = 1024
#: Test tokens whose seeds are broadcast at once (about 100 bytes each); a larger benchmark is searched in blocks.
MOST_TOKENS = 400_000


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(array: str, at: Column) -> Column:
    """Hashes of the masked tokens from position `at` (from 0) on, one for each mask; null where a mask passes the end."""
    return F.array(*[F.when(F.get(F.col(array), at + m[-1]).isNotNull(), F.xxhash64(F.lit(k), *[F.get(F.col(array), at + i) for i in m])) for k, m in enumerate(MASKS)])


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 13, equal: float = 0.8, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """doc_id, item_id, start, end, same, overlap: the largest overlap of each document and test item that shares one.

    Seeds of both sides are hashed under each mask and joined. The hits of one document and item with the same shift between
    their positions are one diagonal, whose tokens are compared from end to end, whatever their number. An overlap is the
    longest stretch of a diagonal that begins and ends with equal tokens and of which a share `equal` is equal; it counts from `least`
    tokens or, if the item is shorter, with a share `equal` of the whole item. Of the diagonals of a document and item the one with the most
    equal tokens is given, ties to the first start. Starts and ends are token positions of the document, end exclusive.

    Items of equal tokens are searched once. Seeds of the test side are broadcast in blocks of at most about most_tokens tokens, counted first, an item
    of any length being dealt over blocks; documents are cut into rows of CHUNK tokens, so that long texts are many rows. Nothing of
    the documents moves but hits, and the texts that have one.

    Null or empty text on either side shares nothing; neither do items of fewer than five tokens. Rows of one doc_id (or item_id) are
    taken together, null ones too; repeated rows give one. Empty tables: no rows. Other columns, whatever their names, are not looked at.
    """
    docs = docs.select("doc_id", row_tag(F.col("doc_id"), F.col("text")).alias("tag"), "text")
    listed = benchmark.select("item_id", tokens(F.col("text")).alias("item")).where(F.size("item") >= len(MASKS[-1]))
    listed = materialize(listed.select("item_id", F.xxhash64("item").alias("key"), "item"), "decontam-items")
    items = listed.groupBy("key").agg(F.first("item").alias("item")).withColumn("size", F.size("item"))
    placed = items.select("key", "item", F.posexplode("item").alias("q", "word"))
    placed = placed.select("key", "q", F.xxhash64("word", F.get("item", F.col("q") + 1)).alias("pair"), seeds("item", F.col("q")).alias("seeds"))
    placed = materialize(placed.where(F.exists("seeds", lambda s: s.isNotNull())), "decontam-seeds")
    blocks = max(1, -(-placed.count() // most_tokens))
    part = F.pmod(F.xxhash64("key", F.expr("q div 4096")), F.lit(blocks))
    found = [hits(docs, placed.where(part == i) if blocks > 1 else placed) for i in range(blocks)]
    diagonals = materialize(reduce(DataFrame.unionByName, found).distinct(), "decontam-hits")
    texts = docs.join(diagonals.select("tag").distinct(), "tag", "left_semi").distinct().select("doc_id", "tag", tokens(F.col("text")).alias("all"))
    both = texts.join(diagonals, "tag").join(items, "key")
    best = stretches(both, least, equal).groupBy("doc_id", "key").agg(F.max_by(F.struct("start", "end", "same", "overlap"), F.struct("same", -F.col("start"), -F.col("overlap"))).alias("best"))
    return best.join(listed.select("item_id", "key").distinct(), "key").groupBy("doc_id", "item_id").agg(F.max_by("best", F.struct("best.same", -F.col("best.start"))).alias("best")).select("doc_id", "item_id", "best.*")


def hits(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """tag, key, shift (position in the document less that in the item) of the seeds that both sides have."""
    reach = max(m[-1] for m in MASKS)  # words stay strings, and positions after the first join alone are looked at further: few begin with two words of an item
    cut = docs.select("tag", tokens(F.col("text")).alias("all"))
    cut = cut.select("tag", "all", F.explode(F.expr(f"sequence(1, greatest(size(all), 1), {CHUNK})")).alias("from"))
    cut = cut.select("tag", "from", F.expr(f"slice(all, from, {CHUNK + reach})").alias("chunk"))
    rows = cut.select("tag", "from", "chunk", F.posexplode(F.expr(f"slice(chunk, 1, {CHUNK})")).alias("p", "word"))
    pairs = placed.select("pair").distinct()
    rows = rows.withColumn("pair", F.xxhash64("word", F.get("chunk", F.col("p") + 1))).join(F.broadcast(pairs), "pair", "left_semi")
    rows = rows.select("tag", (F.col("from") + F.col("p") - 1).alias("at"), F.explode(seeds("chunk", F.col("p"))).alias("seed")).where(F.col("seed").isNotNull())
    lanes = placed.select("key", "q", F.explode("seeds").alias("seed")).where(F.col("seed").isNotNull())
    return rows.join(F.broadcast(lanes), "seed").select("tag", "key", (F.col("at") - F.col("q")).alias("shift"))


def stretches(both: DataFrame, least: int, equal: float) -> DataFrame:
    """doc_id, key, start, end, same, overlap of the longest overlap of each diagonal (doc_id, tag, all, key, item, size, shift) that has one.

    Along a diagonal an equal token adds and another takes away so much that a stretch of the least share adds up to nothing: a stretch
    counts if the sum at its end is no less than the one before it. In the order of falling sums, the last end so far is the farthest of each beginning.
    """
    up, down = 1000 - round(1000 * equal), round(1000 * equal)
    first = F.greatest(-F.col("shift"), F.lit(0))  # of the item
    length = F.least(F.col("size") - first, F.size("all") - F.col("shift") - first)
    lined = both.select(
        "doc_id", "tag", "key", "size", "shift", first.alias("first"),
        F.zip_with(F.slice("all", F.col("shift") + first + 1, length), F.slice("item", first + 1, length), lambda x, y: x == y).alias("equals"),
    )
    told = lined.select("doc_id", "tag", "key", "size", "shift", "first", F.posexplode("equals").alias("i", "here"))
    line = ["doc_id", "tag", "key", "shift"]
    step = F.when(F.col("here"), up).otherwise(-down)
    summed = told.withColumn("sum", F.sum(step).over(Window.partitionBy(*line).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # equal tokens alone begin and end a stretch: one row for each as a beginning (the sum before it), one as an end
    marked = summed.where("here").select(*line, "size", "first", F.explode(F.array(
        F.struct((F.col("sum") - up).alias("sum"), F.col("i").alias("begin"), F.lit(None).cast("struct<i:int,sum:bigint>").alias("stop")),
        F.struct(F.col("sum"), F.lit(None).cast("int").alias("begin"), F.struct(F.col("i"), F.col("sum").alias("sum")).alias("stop")),
    )).alias("m")).select(*line, "size", "first", "m.*")
    falling = Window.partitionBy(*line).orderBy(F.desc("sum")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = marked.withColumn("stop", F.max("stop").over(falling)).where(F.col("begin").isNotNull() & (F.col("stop.i") >= F.col("begin")))
    sized = ends.withColumn("overlap", (F.col("stop.i") - F.col("begin") + 1).cast("int"))
    sized = sized.withColumn("same", F.round((F.col("stop.sum") - F.col("sum") + down * F.col("overlap")) / 1000).cast("int"))
    sized = sized.where((F.col("overlap") >= least) | ((F.col("size") < least) & (F.col("same") >= equal * F.col("size"))))
    begin = F.col("shift") + F.col("first") + F.col("begin")
    whole = F.struct(begin.cast("int").alias("start"), (begin + F.col("overlap")).cast("int").alias("end"), "same", "overlap")
    return sized.groupBy(*line).agg(F.max_by(whole, F.struct("overlap", "same", -F.col("begin"))).alias("it")).select("doc_id", "key", "it.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id has no overlap; see `overlaps` for nulls, repeats and empty tables. All columns stay as they are."""
    (leaked,) = fresh(docs, "leaked")
    found = overlaps(docs, benchmark, **options).select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(leaked)), "left_anti")
