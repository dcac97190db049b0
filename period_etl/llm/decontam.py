"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact weighted shingles.

Every benchmark item is compared with windows of its own length in words. A
window's fingerprint is the 64-bit SimHash of its words. The fingerprints are
cut into RADIUS + 1 = 4 blocks of 16 bits: two that differ in at most RADIUS bits
agree in one block at least, so the join on (length, block, its bits) finds all
pairs within the radius, and of two unlike fingerprints one pair in 16,000 meets
in a block. A window that shares one of an item's rare shingles is paired
with it too, whatever their distance (see ``_with_rare``). Pairs are made of row
numbers and fingerprints; shingles are fetched for those that are left, and all
are verified exactly: the multiset Jaccard similarity of the 5-word shingles, each weighted
by how often it occurs (sum of least over sum of greatest counts), must reach
``percent``. Windows are laid around anchors (see native): where the document
and the item of some length share a shingle, at the item's offset;
where that sticks out of the text (an item cut off by the text's beginning or
end), at the text's first or last place. Texts shorter than an item have none.

At similarity 0.8 a window may differ in a ninth of its shingles, at its end in
1 word of 15, 4 of 40, 6 of 59 and 21 of 200, and most such pairs lie further apart
than RADIUS bits (of 4,000 of distinct random words each the mean is 6.8, 8.8, 9.1
and 9.4). These are found by their rare shingles, so no pair at the threshold is
missed; copies and windows with little changed are found by their fingerprints.

Rows: null and empty documents and items match nothing. An item of fewer than
k words is one shingle. Rows with the same id and text are one document; each
row of the input still gets its answer. Items that repeat are each reported.
All work on documents is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from period_etl.llm.common import stored
from period_etl.llm.native import anchors, bit_sum, bounded, shingle_array, word_array
from period_etl.session import unique_name

RADIUS = 3
BLOCK_BITS = 64 // (RADIUS + 1)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _blocks(fp: Column) -> Column:
    """The fingerprint's blocks, each with its number in front."""
    return F.array(*[F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int") + (b << BLOCK_BITS)
                     for b in range(RADIUS + 1)])


def benchmark_items(benchmark: DataFrame, k: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, n_words, item_shingles, item_fp) of the items that have words."""
    return (benchmark.select(F.col(id_col).alias("item_id"), word_array(F.col(text_col)).alias("w")).where("size(w) > 0")
            .select("item_id", F.size("w").alias("n_words"), shingle_array(F.col("w"), k).alias("item_shingles"), _hashes(F.col("w")).alias("h"))
            .withColumn("item_fp", bit_sum(F.col("h"))).drop("h"))


def _with_rare(items: DataFrame, percent: int) -> DataFrame:
    """The items with ``rare``, the shingles that the fewest items have: a window of the item's length at ``percent`` has one at least.

    Of n shingles it must hold c = 2 n percent / (100 + percent), so any n - c + 1 of them include one that it holds.
    """
    one = items.select("row", F.explode("item_shingles").alias("g"))
    ranked = one.join(bounded(one.groupBy("g").agg(F.count("*").alias("x"))), "g").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("x", "g"))).alias("s"))
    n = F.size("s")
    held = F.greatest(F.lit(1), F.ceil(n * 2 * percent / (100 + percent)).cast("int"))
    return items.join(ranked.select("row", F.array_distinct(F.slice(F.col("s.g"), F.lit(1), n - held + 1)).alias("rare")), "row")


def candidates(prints: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """(print, row, distance), each pair once: windows and items of one length whose fingerprints differ in RADIUS bits at
    most, or that share one of the item's rare shingles. ``prints`` has print, n_words, shingles, fp; ``items`` row, n_words,
    item_shingles, item_fp."""
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("distance")
    blocked = prints.select("print", "n_words", "fp", F.explode(_blocks(F.col("fp"))).alias("block"))
    index = items.select("row", "n_words", "item_fp", F.explode(_blocks(F.col("item_fp"))).alias("block"))
    near = blocked.join(bounded(index), ["n_words", "block"]).select("print", "row", distance).where(F.col("distance") <= RADIUS)
    rare = stored(_with_rare(items, percent).select("row", "n_words", "item_fp", F.explode("rare").alias("g")), "decon-rare")
    held = prints.select("print", "n_words", "fp", F.explode(F.array_distinct("shingles")).alias("g"))
    return near.union(held.join(bounded(rare), ["n_words", "g"]).select("print", "row", distance)).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, item_id, start, n_words, distance, common, whole): each item found in a document, with its
    most similar window (of equals the first); common / whole is the similarity."""
    items = stored(benchmark_items(benchmark, k).withColumn("row", F.monotonically_increasing_id()), "decon-items")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    places = items.select("n_words", F.posexplode("item_shingles").alias("offset", "g")).distinct()
    split = keyed.withColumn("words", word_array(F.col("text"))).drop("text").withColumn("m", F.size("words"))
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("offset"), F.col("m") - F.col("n_words")))
    windows = anchors(split, places, k).where("n_words <= m").select("doc_id", "text_hash", start.alias("start"), "n_words")
    windows = stored(windows.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n_words")).alias("windows")), "decon-windows")

    same = (keyed["text_hash"] == windows["text_hash"]) & keyed["doc_id"].eqNullSafe(windows["doc_id"])
    texts = keyed.join(windows, same).select(windows["doc_id"], windows["text_hash"], "text", "windows").dropDuplicates(["doc_id", "text_hash"])
    cut = (texts.select("doc_id", "text_hash", word_array(F.col("text")).alias("words"), F.explode("windows").alias("v"))
           .where("v.start + v.n_words <= size(words)")
           .select("doc_id", "text_hash", "v.start", "v.n_words", F.slice("words", F.col("v.start") + 1, F.col("v.n_words")).alias("w")))
    cut = cut.select("doc_id", "text_hash", "start", "n_words", shingle_array(F.col("w"), k).alias("shingles"), _hashes(F.col("w")).alias("h"))
    prints = stored(cut.withColumn("fp", bit_sum(F.col("h"))).drop("h").withColumn("print", F.monotonically_increasing_id()), "decon-prints")

    pairs = candidates(prints, items, percent)
    known = items.select("row", "item_id", "item_shingles")
    near = (pairs.join(prints.select("print", "doc_id", "text_hash", "start", "n_words", "shingles"), "print")
            .join(bounded(known, weight=F.size("item_shingles") + 4), "row"))
    mine, its = F.col("shingles"), F.col("item_shingles")
    common = F.aggregate(F.array_intersect(mine, its), F.lit(0), lambda s, g: s + F.least(
        F.size(F.filter(mine, lambda x: x == g)), F.size(F.filter(its, lambda x: x == g))))
    found = (near.withColumn("common", common).withColumn("whole", F.size(mine) + F.size(its) - F.col("common"))
             .where(F.col("common").cast("long") * 100 >= F.col("whole").cast("long") * percent)
             .select("doc_id", "text_hash", "item_id", "start", "n_words", "distance", "common", "whole"))
    best = F.max_by(F.struct("start", "n_words", "distance", "common", "whole"), F.struct(F.col("common") / F.col("whole"), -F.col("start")))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b")).select("doc_id", "text_hash", "item_id", "b.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found."""
    i, h = unique_name("decon"), unique_name("decon")  # names that no column of docs has
    hit = stored(leaks(docs, benchmark, id_col, text_col, **settings).select(F.col("doc_id").alias(i), F.col("text_hash").alias(h)).distinct(), "decon-hit")
    same = (F.xxhash64(text_col) == F.col(h)) & F.col(id_col).cast("long").eqNullSafe(F.col(i))
    return docs.join(hit, same, "left_anti")
