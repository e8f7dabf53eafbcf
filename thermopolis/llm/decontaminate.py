"""Benchmark decontamination with DataFrame functions alone: SimHash windows, Hamming blocks, exact check."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import materialize, remove, scratch

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
#: Fingerprints within this many bits are verified. At a similarity of 0.8 the expected distance is
#: about 10 with a deviation of 3.
MAX_DISTANCE = 20
BLOCKS = 10
BITS = 64
#: Bytes of the benchmark's shingle index (24 a row) up to which it is broadcast; beyond it is shuffled.
BROADCAST_BYTES = 64 << 20
SPACE = " \t\n\x0b\f\r"
#: Counters of four bits of the fingerprint in one number, 16 binary digits each.
LANES = 0x0001000100010001


def words(text: Column) -> Column:
    """Lower-cased runs without ASCII white space; NULL for a text without any."""
    plain = F.btrim(F.lower(text), F.lit(SPACE))
    return F.when(plain != "", F.split(plain, f"[{SPACE}]+"))


def fingerprint(hashes: Column) -> Column:
    """SimHash of an array of 64-bit hashes, repeats included: a bit is set where over half set it.

    Sixteen sums count four bits each in lanes of 16 digits; windows have under 65,536 shingles.
    """

    def lanes(i: int) -> Column:
        return F.aggregate(
            hashes, F.lit(0).cast("long"), lambda total, h: total + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANES))
        )

    half = F.size(hashes)

    def bits(sums: Column) -> Column:
        def bit(i: Column) -> Column:
            lane = F.call_function("shiftrightunsigned", F.element_at(sums, i % 16 + 1), (i / 16).cast("int") * 16)
            over = lane.bitwiseAND(F.lit(65535)) * 2 > half
            return F.when(over, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda whole, i: whole.bitwiseOR(bit(i)))

    # The sums are bound to a lambda's variable, else each of the 64 bits would compute them again.
    return F.element_at(F.transform(F.array(F.array(*[lanes(i) for i in range(16)])), bits), 1)


def shingles(of: Column, k: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.size(of) - k + 1), lambda i: F.array_join(F.slice(of, i, k), " ")
    )


def block_edges() -> list[tuple[int, int]]:
    return [(BITS * b // BLOCKS, BITS * (b + 1) // BLOCKS) for b in range(BLOCKS)]


def blocks(print_: Column) -> Column:
    """The fingerprint's blocks, each a struct of its number and its bits."""
    return F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(print_, lo).bitwiseAND(F.lit((1 << hi - lo) - 1)).alias("bits"))
            for b, (lo, hi) in enumerate(block_edges())
        ]
    )


def block_index(items: DataFrame, max_distance: int) -> DataFrame:
    """(item_id, block, bits): every content a block may have in a fingerprint within the distance.

    With at most ``max_distance`` differing bits in ``BLOCKS`` blocks one block has at most their
    quotient, so a fingerprint within the distance meets its item in that block.
    """
    flips = max_distance // BLOCKS
    masks = [
        [sum(1 << i for i in chosen) for n in range(flips + 1) for chosen in combinations(range(hi - lo), n)]
        for lo, hi in block_edges()
    ]
    masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in x]) for x in masks])
    index = items.select("item_id", F.explode(blocks(F.col("item_print"))).alias("b"))
    index = index.select("item_id", "b.block", "b.bits", F.explode(F.element_at(masks, F.col("b.block") + 1)).alias("mask"))
    return index.select("item_id", "block", F.col("bits").bitwiseXOR(F.col("mask")).alias("bits"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_similarity: float = MIN_SIMILARITY,
    max_distance: int = MAX_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, start, distance): the best window of each document with a leak.

    A document's windows for an item have the item's number of words (a shorter document is one
    window) and start at every word. Their fingerprints meet the item's through Hamming blocks, which
    lose none within ``max_distance`` bits; pairs found that way are verified by the exact similarity
    of their word shingles, weighted by how often each occurs (sum of minima over sum of maxima).

    Which windows can reach the similarity is decided first: at 0.75 or more a window shares all but
    a seventh of its shingles with the item, so of every fourth shingle of a document some must be
    the item's, and windows with too few of them are not fingerprinted. No window above the
    similarity is lost by that. ``start`` counts words from 0; ties go to the smaller start.

    Defined results: NULL, empty and blank texts or items leak nothing; an item of fewer than five
    words is one shingle; repeated rows of a document or item count once; a NULL id passes; an empty
    table gives no rows. Benchmark ids are read as whole numbers.
    """
    spark = docs.sparkSession
    if min_similarity < 0.75:
        raise ValueError("similarities below 0.75 need every shingle, not every fourth")
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("item_words"))
        .where("item_words is not null")
        .distinct()
        .withColumn("n", F.size("item_words"))
        .withColumn("k", F.least(F.lit(SHINGLE_WORDS), F.col("n")))
        .withColumn("m", F.col("n") - F.col("k") + 1)
        .withColumn("item_shingles", shingles(F.col("item_words"), F.col("k")))
        .withColumn("item_print", fingerprint(F.transform("item_shingles", lambda x: F.xxhash64(x))))
    )
    items = materialize(items)
    sizes = items.groupBy("k").agg(F.min("m").alias("least"), F.sum("m").alias("rows")).collect()  # five rows at most
    index = items.select(
        "item_id", "n", "k", "m", F.explode(F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: F.xxhash64(F.slice("item_words", i, F.col("k"))))).alias("hash")
    ).distinct()
    if sum(r.rows for r in sizes) * 24 <= BROADCAST_BYTES:
        index = F.broadcast(index)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    windows = None
    for k, least in sorted((r.k, r.least) for r in sizes):
        part = _windows(texts, index.where(F.col("k") == k), k, min(4, least), min_similarity)
        windows = part if windows is None else windows.unionByName(part)
    if windows is None:
        return _empty(docs, id_col)

    gathered = windows.groupBy("key").agg(F.collect_list(F.struct("item_id", "n", "k", "start")).alias("windows"))
    placed = (
        texts.join(gathered, "key")
        .select("doc_id", words(F.col("text")).alias("w"), F.explode("windows").alias("x"))
        .select("doc_id", "x.item_id", "x.start", "x.k", F.slice("w", F.col("x.start") + 1, F.col("x.n")).alias("w"))
        .select("doc_id", "item_id", "start", shingles(F.col("w"), F.col("k")).alias("shingles"))
        .withColumn("print", fingerprint(F.transform("shingles", lambda x: F.xxhash64(x))))
    )
    folder = scratch(spark, "windows")
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    near = (
        placed.select("doc_id", "item_id", "start", "print", F.explode(blocks(F.col("print"))).alias("b"))
        .select("doc_id", "item_id", "start", "print", "b.block", "b.bits")
        .join(block_index(items, max_distance), ["item_id", "block", "bits"])
        .select("doc_id", "item_id", "start", "print")
        .distinct()
        .join(items.select("item_id", "item_print").distinct(), "item_id")
        .withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))))
        .where(F.col("distance") <= max_distance)
        .groupBy("doc_id", "item_id", "start")
        .agg(F.min("distance").alias("distance"))
    )
    of_window = ["item_id", "start", "distance"]
    near = near.toDF("near_id", "near_item", "near_start", "distance")
    same = F.expr("doc_id <=> near_id and item_id = near_item and start = near_start")
    candidates = placed.join(near, same).select("doc_id", *of_window, "shingles").distinct()
    counted = (
        candidates.select("doc_id", *of_window, F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
        .groupBy("doc_id", *of_window, "size", "shingle")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    theirs = items.select("item_id", "m", F.explode("item_shingles").alias("shingle"))
    theirs = theirs.groupBy("item_id", "m", "shingle").agg(F.count(F.lit(1)).alias("item_times"))
    shared = (
        counted.join(theirs, ["item_id", "shingle"])
        .groupBy("doc_id", *of_window, "size", "m")
        .agg(F.sum(F.least("times", "item_times")).alias("shared"))
        .withColumn("similarity", F.col("shared") / (F.col("size") + F.col("m") - F.col("shared")))
        .where(F.col("similarity") >= min_similarity)
    )
    best = shared.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", -F.col("start"), -F.col("distance"))).alias("x"))
    best = best.select(
        F.col("doc_id").alias(id_col), "item_id", "x.similarity", (-F.col("x.col2")).alias("start"), (-F.col("x.col3")).alias("distance")
    )
    best = materialize(best)
    remove(spark, folder)
    return best


def _windows(texts: DataFrame, index: DataFrame, k: int, step: int, min_similarity: float) -> DataFrame:
    """(key, item_id, n, k, start) of the windows that may reach the similarity with an item."""
    w = F.col("w")
    hashes = F.when(
        F.size(w) >= k,
        F.transform(F.sequence(F.lit(0), F.size(w) - k, F.lit(step)), lambda p: F.xxhash64(F.slice(w, p + 1, k))),
    )
    share = (1 - min_similarity) / (1 + min_similarity)  # of a window's shingles, at most these are not the item's
    last = F.greatest(F.col("size") - F.col("n"), F.lit(0))
    enough = F.when(F.col("size") >= F.col("n"), F.greatest(F.floor(F.col("m") / step) - F.floor(F.col("m") * share + 1e-9), F.lit(1))).otherwise(1)
    return (
        texts.select("key", words(F.col("text")).alias("w"))
        .select("key", F.size(w).alias("size"), F.posexplode(hashes).alias("i", "hash"))
        .join(index, "hash")
        .select("key", "size", (F.col("i") * step).alias("p"), "item_id", "n", "k", "m")
        .distinct()
        .where(F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)) <= F.least("p", last))
        .withColumn("start", F.explode(F.sequence(F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)), F.least("p", last))))
        .groupBy("key", "item_id", "n", "k", "start", enough.alias("enough"))
        .agg(F.count(F.lit(1)).alias("anchors"))
        .where(F.col("anchors") >= F.col("enough"))
        .select("key", "item_id", "n", "k", "start")
    )


def _empty(docs: DataFrame, id_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, item_id long, similarity double, start int, distance int"
    return docs.sparkSession.createDataFrame([], schema)
