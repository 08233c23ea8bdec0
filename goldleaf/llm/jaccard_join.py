"""n-gram Jaccard self-join with adaptive multi-match prefixes, reported as link components.

Shingles are ordered by document frequency. Two documents whose Jaccard similarity reaches the threshold share at
least l shingles among the first n - ceil(t n) + l of each, for every l. Each document lengthens its prefix to the l
at which postings plus verifications, estimated from the frequencies, cost least; a pair then has to share as many
prefix shingles as the smaller l of the two asks before its sets are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm import chunks as C
from goldleaf.llm.graph import components
from goldleaf.session import scratch_path
from goldleaf.sources.shared_files import delete

#: Longest prefix extension, and the cost of comparing two sets in postings.
MOST_MATCHES, VERIFY_COST = 5, 8
#: Size classes of the second round per factor of the threshold.
SIZE_STEPS = 4
#: Frequencies from here on are told as this one; they only order shingles and estimate costs.
TOP_FREQUENCY = 65_535


def _sets(row, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle keys of each document of a chunk."""
    out = []
    for h in C.document_hashes(row):
        keys = C.window_keys(h, k if len(h) >= k else len(h)) if len(h) else np.empty(0, np.uint64)
        out.append(np.unique(keys))
    return out


def _prefix(keys: np.ndarray, freq: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """The cheapest number of matches for a set, and the places of its prefix in frequency order."""
    need = -(-percent * len(keys) // 100)
    order = np.lexsort((keys, freq))
    base = len(keys) - need + 1
    best, cost = 1, None
    for l in range(1, min(MOST_MATCHES, need) + 1):
        postings = int((freq[order[:base + l - 1]].astype(np.int64) - 1).sum())
        now = postings + VERIFY_COST * postings / l
        if cost is None or now < cost:
            best, cost = l, now
    return best, order[:base + best - 1]


@C.removes_shuffles
def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                       chunk_words: int = C.CHUNK_WORDS) -> DataFrame:
    """Components of documents linked by Jaccard similarity of k-word shingle sets >= percent / 100.

    Words are lower-cased in A-Z. A set has the distinct k-word shingles, or the whole sequence where there are fewer
    words. Returns one row per input row: ``doc_id, n_shingles, component_id`` (the least id reachable by links,
    the row's own included). NULL, empty and blank texts have no shingle and link with nothing, not with
    each other. Rows with equal sets link. Repeated rows are linked copies; NULL ids take part and are
    never a component's id unless all its ids are NULL. An empty table gives no rows; other columns are ignored.

    1. Equal sets become one class (minimum before the shuffle, so thousands of copies are one row).
    2. Frequencies of all shingles over the classes; a class with fewer shared shingles than any partner would need
       is done.
    3. A first round compares every class with one hub: under each prefix shingle and size class that with the most
       frequent shingles, so the likely original of a group, and of these the one that most of its prefix votes for. What links
       is joined: a large group of near copies becomes one component without all pairs.
    4. A second round takes, under each prefix shingle, the classes outside the most frequent component there against
       all others of another component. The place of the first shared shingle bounds what a pair can have in common, and so the
       sizes of its partners: classes meet by shingle and size class, places without a partner's size are left out before. Pairs
       with enough shared prefix shingles have their sets compared. Pairs inside a component need no comparison, so no link
       between components is lost.

    A long text is one set of its shingles in one row; its cost is linear but for the sort of its shingles.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks_at, picked_at, counts_at = (scratch_path(spark, f"join-{x}") for x in ("chunks", "picked", "counts"))
    chunks = C.write_chunks(docs, id_col, text_col, "join-chunks", lower=True, chunk_words=chunk_words, path=chunks_at)

    def signed(frames):
        for pdf in frames:
            for row in pdf.itertuples():
                sets = _sets(row, k)
                yield pd.DataFrame({"chunk": row.chunk, "at": np.arange(len(sets)), "doc_id": list(row.ids), "n": [len(s) for s in sets],
                                    "sign": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]})

    small = chunks.select("chunk", "ids", "lens", "tokens", "hashes")
    path = scratch_path(spark, "join-sets")
    (small.mapInPandas(signed, "chunk long, at int, doc_id string, n long, sign binary")
     .select("chunk", "at", F.col("doc_id").cast(id_type).alias("doc_id"), "n", "sign").write.parquet(path))
    rows = spark.read.parquet(path)
    classes = rows.where("n > 0").groupBy("sign", "n").agg(
        F.min(F.struct("chunk", "at")).alias("r"), F.min("doc_id").alias("least_id")).select(
        "sign", "n", "r.chunk", "r.at", C.node_id(F.col("r.chunk"), F.col("r.at")).alias("node"), "least_id")
    path = scratch_path(spark, "join-classes")
    classes.write.parquet(path)
    classes = spark.read.parquet(path)

    of_chunk = classes.groupBy("chunk").agg(F.collect_list("at").alias("picked"))  # at most a chunk's documents
    shards = C.shard_count(chunks)

    def pick(frames):
        """Chunks with one document of each class; ``picked`` are the documents' places before."""
        for pdf in frames:
            for row in pdf.itertuples():
                kept, lens = np.sort(row.picked), np.asarray(row.lens)
                tokens, hashes = row.tokens, row.hashes
                if len(kept) < len(lens):
                    stays, hashes = np.zeros(len(lens), bool), C.unpack(hashes, np.uint64)
                    stays[kept] = True
                    left, used = C.unpack(tokens, np.uint32)[np.repeat(stays, lens)], np.zeros(len(hashes), bool)
                    used[left] = True
                    tokens, hashes = C.pack((np.cumsum(used, dtype=np.uint32) - np.uint32(1))[left]), C.pack(hashes[used])
                yield pd.DataFrame({"chunk": [row.chunk], "picked": [kept], "lens": [lens[kept]], "tokens": [tokens], "hashes": [hashes]})

    with C.arrow_rows(spark, 2):  # a chunk has some megabytes
        small.drop("ids").join(of_chunk.hint("merge"), "chunk").mapInPandas(  # one plan at every size
            pick, "chunk long, picked array<int>, lens array<int>, tokens binary, hashes binary").write.option("compression", "none").parquet(picked_at)
    picked = spark.read.parquet(picked_at)
    delete(spark, chunks_at)  # all that follows reads the picked documents

    def ask(frames):
        for pdf in frames:
            for row in pdf.itertuples():
                keys, counts = np.unique(np.concatenate(_sets(row, k)), return_counts=True)
                yield pd.DataFrame(C.questions(row.chunk, 1, 0, keys, counts, shards),
                                   columns=["chunk", "shard", "kind", "role", "keys", "counts"])

    answers = C.answer(picked.mapInPandas(ask, C.ASK), ((0,),), counts_at, TOP_FREQUENCY)

    def survivors(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples():
            sets = _sets(row, k)
            all_keys = np.unique(np.concatenate(sets))
            freq_of = C.told(right, 1, 0)
            for at, keys in zip(row.picked, sets):
                freq = freq_of[np.searchsorted(all_keys, keys)]
                if 100 * int((freq > 1).sum()) >= percent * len(keys):
                    matches, places = _prefix(keys, freq, percent)
                    base = len(places) - matches + 1
                    levels = np.maximum(1, np.arange(len(places)) - base + 2)
                    shared = freq[places] > 1
                    out.append(((row.chunk << 17) + int(at), len(keys), int((freq > 1).sum()), float(freq.mean()), matches,
                                keys[places[shared]].view(np.int64), np.flatnonzero(shared).astype(np.int32), levels[shared].astype(np.int32),
                                keys.view(np.int64)))
        return pd.DataFrame(out, columns=["node", "n", "shared", "central", "matches", "prefix", "places", "levels", "keys"])

    path = scratch_path(spark, "join-survivors")
    picked.groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk")).applyInPandas(
        survivors, "node long, n long, shared long, central double, matches int, prefix array<long>, places array<int>, levels array<int>, keys array<long>").write.parquet(path)
    left = spark.read.parquet(path)
    for done in (picked_at, counts_at):  # all that follows reads the survivors
        delete(spark, done)
    postings = left.select("node", "n", "shared", "central", "matches", F.explode(F.arrays_zip("prefix", "places")).alias("p")).select(
        "node", "n", "shared", "central", "matches", F.col("p.prefix").alias("key"), F.col("p.places").alias("place"))
    sets = left.select("node", "n", "keys")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) whose sets reach the threshold."""
        both = pairs.join(sets.toDF("a", "na", "ka"), "a").join(sets.toDF("b", "nb", "kb"), "b")
        common = F.size(F.array_intersect("ka", "kb")).cast("long")
        path = scratch_path(spark, name)
        both.select("a", "b", "na", "nb", common.alias("c")).where(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))
                                                                   ).select("a", "b").write.parquet(path)
        return spark.read.parquet(path)

    size_class = F.floor(F.log("n") / F.lit(float(np.log(100 / percent)) or 1.0)).alias("size") if percent < 100 else F.col("n").alias("size")
    sized = postings.select("node", "key", "central", size_class)
    hubs = sized.groupBy("key", "size").agg(F.max_by("node", F.struct("central", "node")).alias("hub"))
    votes = sized.join(hubs, ["key", "size"]).where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("votes"))
    first = linked(votes.groupBy("node").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub")).toDF("a", "b"), "join-links")
    found = components(first)
    placed = postings.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    path = scratch_path(spark, "join-postings")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    main = placed.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.count("*").alias("components")).where("components > 1")
    prefixes = left.select("node", "prefix", "levels")
    # A pair is looked for under the first shingle that it shares. At place i of a set of n it leaves at most n - i in common,
    # which bounds the partner's size; places that no size satisfies are left out, the others are dealt by size class.
    least_size = F.ceil(percent * F.col("n") / 100)
    reach = F.floor((100 + percent) * (F.col("n") - F.col("place")) / percent) - F.col("n")
    step = float(np.log(100 / percent)) / SIZE_STEPS
    class_of = lambda n: F.floor(F.log(n) / F.lit(step)) if step else n.cast("long")
    open_postings = placed.join(main.select("key", "main"), "key").withColumn("reach", reach).where(
        F.col("reach") >= least_size).join(prefixes, "node").withColumn("sizes", class_of(F.col("n")))
    largest = F.least("reach", F.floor(100 * F.col("n") / percent))
    few = open_postings.where("component <> main").select(
        "key", F.explode(F.sequence(class_of(least_size), class_of(largest))).alias("sizes"), F.col("node").alias("x"), F.col("n").alias("nx"),
        F.col("shared").alias("sx"), F.col("matches").alias("mx"), F.col("component").alias("cx"), F.col("reach").alias("rx"),
        F.col("prefix").alias("px"), F.col("levels").alias("lx"))
    most = F.least("shared", "sx")  # two sets cannot have more in common than either has in common with any other
    alike = (F.col("component") != F.col("cx")) & (F.col("n") <= F.col("rx")) & (F.col("nx") <= F.col("reach")) & ((F.col("component") == F.col("main")) | (F.col("x") < F.col("node"))) & (
        100 * most >= percent * (F.col("n") + F.col("nx") - most))
    asked = F.least("matches", "mx")
    within = lambda keys, levels: F.filter(keys, lambda k, i: F.get(F.col(levels), i) <= asked)
    common = F.array_intersect(within("px", "lx"), within("prefix", "levels"))
    # A pair counts under the first prefix shingle that it shares, and only with enough of them.
    once = (F.size(common) >= asked) & (F.get(common, F.lit(0)) == F.col("key"))
    pairs = few.join(open_postings, ["key", "sizes"]).where(alike & F.when(alike, once)).select(F.col("x").alias("a"), F.col("node").alias("b"))
    second = linked(pairs, "join-links")
    final = components(first.unionByName(second))
    named = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_sign = named.join(least, "component").select("sign", "n", "component_id")
    result = rows.join(by_sign, ["sign", "n"], "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
