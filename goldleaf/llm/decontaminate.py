"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted similarity.

Only windows that share a shingle with an item can resemble it. So a document's windows are those of an item's length
laid so that a shared shingle stands at the same place in both. Their 64-bit SimHash fingerprints meet
the items' in an index of eight 8-bit blocks: fingerprints within RADIUS bits differ by at most RADIUS // 8 bits in
some block, and the index holds every block value that near, so no pair within the radius is missed. Pairs found are
compared by weighted Jaccard similarity (shingle multisets: sum of minima over sum of maxima).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.text import lower_ascii, shingle_hashes, words

SHINGLE, PERCENT = 5, 80
#: Similarity 0.8 means about 10 differing bits of 64 (standard deviation 3), so 23 lie some 4.5 deviations off.
RADIUS, BLOCKS, BITS = 23, 8, 8
#: Most rows of an item table that is broadcast (it is counted first); a larger one is joined by a shuffle. Such a table holds
#: four numbers a row and no texts or arrays, so the bound is one of bytes too.
BROADCAST_ROWS = 500_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normal_words(c: Column) -> Column:
    """Words in lower case (A-Z) and without ASCII punctuation."""
    return words(F.translate(lower_ascii(c), PUNCTUATION, ""))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: a bit is set where most of the shingles (repeats count) have it set."""
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.call_function("getbit", h, b).cast("int"))
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(
        F.when(2 * ones(b) > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))))
    return F.coalesce(bits, F.lit(0).cast("bigint"))  # never NULL: else joins push a NULL test of it, with its inputs, to the scan


def _block(fingerprint: Column, b: Column) -> Column:
    return F.call_function("shiftright", fingerprint, b * BITS).bitwiseAND(F.lit(2 ** BITS - 1)).cast("int")


def _shared(a: Column, b: Column) -> Column:
    """Sum over distinct shingles of the smaller count in two arrays."""
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    exact = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(exact)


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a table of numbers if it is small; not for columns whose values have no size bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def find_leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents that hold a window alike to a benchmark item.

    Returns one row per input row: ``doc_id, contaminated, item_ids`` (sorted, comma-joined, of the items matched)
    and ``spans`` (sorted ``item_id:start:end`` word places of the windows that match, comma-joined). A document shorter than
    an item is one window. Shingles have five words; an item of fewer is one shingle.

    NULL and empty texts match nothing, nor do items without words. NULL item ids are left out, as there is nothing
    to report them by. Repeated rows get the same result each; repeated items are one. Empty tables: no documents give
    no rows, no items leave every document clean. Other columns are ignored. The same window may match several items.

    Shared shingles are found where the texts are read, in a hash join with the items' shingles (broadcast
    behind a check of its size); only windows travel, first reduced to distinct ones, so a passage that fills a
    third of all rows costs a few windows per row. Of the index, only lengths, fingerprints and block values are broadcast; the
    items' shingles are joined to the pairs within the radius. A very long text is one row of the first join; from there
    on only its windows, each as long as an item, travel.
    """
    item = items.select(F.col(item_col).cast("string").alias("item_id"), normal_words(F.col(item_text)).alias("w")).where(
        F.col("item_id").isNotNull() & (F.size("w") > 0)).distinct()
    item = item.select("item_id", F.size("w").alias("length"), F.least(F.size("w"), F.lit(SHINGLE)).alias("k"), "w")
    lengths = sorted(r["k"] for r in item.select("k").distinct().collect())  # at most five values
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = None
    for k in lengths or [SHINGLE]:
        known = item.where(F.col("k") == k).select("item_id", "length", shingle_hashes(F.col("w"), k).alias("sh"))
        at = known.select("length", F.posexplode_outer("sh").alias("j", "h")).distinct()
        texts = rows.select("doc_id", "text_key", normal_words(F.col("text")).alias("w"))
        texts = texts.select("doc_id", "text_key", "w", shingle_hashes(F.col("w"), k).alias("sh"))
        # Outer: else Spark infers a filter on the array and pushes it, with all that makes the array, below its words.
        hits = texts.select("doc_id", "text_key", "w", F.posexplode_outer("sh").alias("p", "h")).join(_bounded(at), "h")
        start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("j"), F.size("w") - F.col("length")))
        windows = hits.select("doc_id", "text_key", "length", start.alias("start"), "w").select(
            "doc_id", "text_key", "length", "start", F.expr("slice(w, start + 1, length)").alias("w")).distinct()
        windows = windows.select("doc_id", "text_key", "length", "start", F.size("w").alias("n"), shingle_hashes(F.col("w"), k).alias("sh"))
        marked = windows.withColumn("fp", simhash(F.col("sh")))
        printed = known.withColumn("ifp", simhash(F.col("sh"))).withColumnRenamed("sh", "ish")
        masks = [sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BITS), n)]
        index = printed.select("length", "ifp", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
        index = index.select("*", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
        index = index.select("length", "ifp", "block", _block(F.col("ifp"), F.col("block")).bitwiseXOR(F.col("mask")).alias("value")).distinct()
        asked = marked.select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
        asked = asked.withColumn("value", _block(F.col("fp"), F.col("block")))
        apart = F.col("fp").bitwiseXOR(F.col("ifp"))
        near_blocks = F.filter(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda b: F.bit_count(_block(apart, b)) <= RADIUS // BLOCKS)
        near = asked.join(_bounded(index), ["length", "block", "value"]).where(
            (F.bit_count(apart) <= RADIUS) & (F.get(near_blocks, F.lit(0)) == F.col("block")))  # once per pair
        # The items' shingles come only now, to the pairs within the radius.
        pairs = near.drop("block", "value").join(printed, ["length", "ifp"])
        shared = pairs.withColumn("shared", _shared(F.col("sh"), F.col("ish")))
        alike = shared.where(100 * F.col("shared") >= percent * (F.size("sh") + F.size("ish") - F.col("shared"))).select(
            "doc_id", "text_key", "item_id", "start", (F.col("start") + F.col("n")).alias("end"))
        found = alike if found is None else found.unionByName(alike)
    span = F.struct("item_id", "start", "end")
    per_text = found.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(span)).alias("s"))
    per_text = per_text.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"),
                               F.array_join(F.array_sort(F.array_distinct(F.col("s.item_id"))), ",").alias("item_ids"),
                               F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["item_id"], x["start"], x["end"])), ",").alias("spans"))
    keyed = rows.select("doc_id", "text_key")
    joined = keyed.join(per_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    return joined.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.lit("")).alias("item_ids"),
                         F.coalesce("spans", F.lit("")).alias("spans"))
