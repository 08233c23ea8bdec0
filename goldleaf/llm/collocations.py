"""Phrase collocations from suffix subtrees that are built group by group.

Every word of a text starts a suffix: it and the words behind it in its piece, cut off after five words, or before a word too
rare for any phrase. Suffixes are parted vertically: a word's suffixes are one subtree if they fit the memory budget, else the subtrees of
its two-word prefixes, and so on; small prefixes share a group up to the budget. Each group's task sorts its suffixes, which lays its
subtrees out: a node is a run of suffixes with the same first words, and its count is the sum of the leaves in the run. The nodes above the
subtrees, prefixes beyond the budget, are summed over their groups.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.chunks import arrow_rows, mix, pack, unpack
from goldleaf.llm.dictionary import arrow_schema, global_ids, id_map, packed_words, scratch, spelled, stored
from goldleaf.session import scratch_path

#: Words per chunk of a language, and over all languages that a task holds open.
CHUNK_WORDS = 1_000_000
#: Leaves (distinct suffixes per chunk) that a group may hold; the group's task needs some 150 bytes for each.
GROUP_LEAVES = 1_000_000
#: Distinct prefixes that a task of the vertical partitioning adds up, on average.
SHARD_PREFIXES = 1_000_000
_PIECE_ENDS, _BLANKS, _END = b".,;:!?\n\x0b\x0c\r", b"\t", b"."
#: Lower case, every end of a piece as a point, every blank as a space; no word holds either.
_TABLE = bytes.maketrans(bytes(range(65, 91)) + _PIECE_ENDS + _BLANKS, bytes(range(97, 123)) + _END * len(_PIECE_ENDS) + b" " * len(_BLANKS))
_SLICE = 1 << 22
_U64 = np.uint64
_GATHERED = "chunk long, part string, n long, n_vocab long, words binary, counts binary, tokens binary"


class _Tokens:
    """Word numbers of the texts of one language; 0 ends a piece."""

    def __init__(self):
        self.vocab: dict[bytes, int] = defaultdict()
        self.vocab.default_factory = self.vocab.__len__
        self.vocab[_END] = 0
        self.parts, self.n = [], 0

    def add(self, text: bytes) -> None:
        at = 0
        while at < len(text):
            end = at + _SLICE
            if end < len(text):  # to the next end of a word, so that none is cut
                end = min((e for e in (text.find(c, end) for c in (b" ", b"\t", b"\n", b".")) if e >= 0), default=len(text))
            words = text[at:end].translate(_TABLE).replace(_END, b" . ").split()
            self.parts.append(np.fromiter(map(self.vocab.__getitem__, words), np.uint32, len(words)))
            self.n += len(words)
            at = end
        self.parts.append(np.zeros(1, np.uint32))
        self.n += 1

    def row(self, chunk: int, part: str) -> dict:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens, minlength=len(self.vocab))[1:]
        return {"chunk": chunk, "part": part, "n": int(counts.sum()), "n_vocab": len(self.vocab) - 1, "words": packed_words(list(self.vocab)[1:]),
                "counts": pack(counts.astype(np.uint32)), "tokens": pack(tokens)}


def _tokenizer(chunk_words: int):
    def gather(batches):
        out, made, first = arrow_schema(_GATHERED), 0, TaskContext.get().partitionId() << 24
        held: dict[str, _Tokens] = {}

        def closed(part: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return pa.RecordBatch.from_pylist([held.pop(part).row(first + made, part)], schema=out)

        for batch in batches:
            for part, text in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(part, _Tokens()).add(text)
                if held[part].n >= chunk_words:
                    yield closed(part)
                elif len(held) > 1 and sum(t.n for t in held.values()) >= 2 * chunk_words:
                    yield closed(max(held, key=lambda p: held[p].n))
        for part in list(held):
            yield closed(part)

    return gather


def packed_keys(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Few 64-bit numbers that sort (the first one first) as the columns do."""
    top = max((int(c.max()) for c in columns if len(c)), default=0)
    bits = max(1, top.bit_length())
    per = max(1, 64 // bits)
    keys = []
    for i in range(0, len(columns), per):
        key = columns[i].astype(_U64)
        for c in columns[i + 1:i + per]:
            key = key << _U64(bits) | c.astype(_U64)
        keys.append(key)
    return keys


def merged(columns: list[np.ndarray], weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of the columns as one, in order, their weights summed."""
    if not len(weights):
        return columns, weights
    keys = packed_keys(columns)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(weights), bool)
    new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    at = order[starts]
    return [c[at] for c in columns], np.add.reduceat(weights[order], starts)


def suffixes(tokens: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct suffixes of a token stream, cut off after ``depth`` words and before a 0, with their counts."""
    n = len(tokens)
    padded = np.concatenate([tokens, np.zeros(depth, tokens.dtype)])
    columns = [padded[:n]]
    for d in range(1, depth):
        columns.append(padded[d:n + d] * (columns[-1] != 0))
    starts = np.flatnonzero(columns[1] != 0) if depth > 1 else np.flatnonzero(tokens)  # one word alone is counted by the dictionary
    return merged([c[starts] for c in columns], np.ones(len(starts), np.int64))


def nodes(columns: list[np.ndarray], weights: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted leaves: the first leaf and the total of every node of ``depth`` words that counts ``least`` or more."""
    full = columns[depth - 1] != 0
    new = np.zeros(len(weights), bool)
    new[:1] = True
    for c in columns[:depth]:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new)
    totals = np.add.reduceat(weights, starts) if len(starts) else weights
    kept = full[starts] & (totals >= least)
    return starts[kept], totals[kept]


def _columns(depth: int) -> list[str]:
    return [f"w{d}" for d in range(1, depth + 1)]


def _prefix(columns: list[np.ndarray], depth: int) -> np.ndarray:
    """A 64-bit key of the first words, for dealing only: prefixes with the same key merely share a group."""
    out = mix(columns[0].astype(_U64))
    with np.errstate(over="ignore"):
        for c in columns[1:depth]:
            out = mix(out * _U64(0x9E3779B97F4A7C15) + c.astype(_U64))
    return out


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is one of the known, which are sorted."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def vertical_partition(leaves: DataFrame, depth: int, budget: int, n_leaves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per prefix length: the sorted keys of prefixes above the budget, and the first keys of the groups that the others form.

    The leaves of every prefix are counted over all chunks, longer prefixes only below those above the budget. Both lists hold at
    most n_leaves / budget entries, and at most one more per shard, of 8 bytes each. Prefixes of full length are never parted further: their leaves are one for each chunk.
    """
    spark, plan = leaves.sparkSession, []
    shards = int(n_leaves // SHARD_PREFIXES) + 1
    while len(plan) < depth and (not plan or len(plan[-1][0])):
        level, heavy = len(plan) + 1, spark.sparkContext.broadcast([h for h, _ in plan])

        def ask(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    columns = [unpack(r[c], np.int64) for c in _columns(level)]
                    below = np.ones(len(columns[0]), bool)
                    for d, known in enumerate(heavy.value, 1):
                        below &= _among(_prefix(columns, d), known)
                    keys, counts = np.unique(_prefix([c[below] for c in columns], level), return_counts=True)
                    cut = np.searchsorted((keys >> _U64(32)) * _U64(shards) >> _U64(32), np.arange(shards + 1, dtype=np.uint64))
                    yield pa.RecordBatch.from_pylist([{"shard": int(s), "keys": pack(keys[cut[s]:cut[s + 1]]), "counts": pack(counts[cut[s]:cut[s + 1]].astype(np.uint32))}
                                                      for s in np.flatnonzero(np.diff(cut))], schema=arrow_schema("shard long, keys binary, counts binary"))

        def group(table: pa.Table) -> pa.Table:
            rows = table.to_pylist()
            (keys,), sizes = merged([np.concatenate([unpack(r["keys"], np.uint64) for r in rows])],
                                    np.concatenate([unpack(r["counts"], np.uint32) for r in rows]).astype(np.int64))
            heavy = sizes > budget if level < depth else np.zeros(len(keys), bool)
            light, sizes = keys[~heavy], sizes[~heavy]
            starts, held = [], budget
            for i, size in enumerate(sizes.tolist()):
                if held + size > budget:
                    starts.append(i)
                    held = 0
                held += size
            return pa.table({"heavy": pa.array([keys[heavy].tobytes()], pa.binary()), "starts": pa.array([light[starts].tobytes()], pa.binary())})

        asked = leaves.select(*_columns(level)).mapInArrow(ask, "shard long, keys binary, counts binary")
        found = asked.groupBy("shard").applyInArrow(group, "heavy binary, starts binary").collect()
        plan.append(tuple(np.sort(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r[c], np.uint64) for r in found)])) for c in ("heavy", "starts")))
        heavy.unpersist()
    return plan


def _groups(columns: list[np.ndarray], plan: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The group of each leaf, which is that of its shortest prefix within the budget, and the length of that prefix."""
    out, levels, open_, base = np.full(len(columns[0]), -1, np.int64), np.zeros(len(columns[0]), np.int64), np.ones(len(columns[0]), bool), 0
    for level, (heavy, starts) in enumerate(plan, 1):
        at = np.flatnonzero(open_)
        keys = _prefix([c[at] for c in columns], level)
        light = ~_among(keys, heavy)
        out[at[light]] = base + np.searchsorted(starts, keys[light], side="right")
        levels[at[light]] = level
        open_[at[light]] = False
        base += len(starts) + 1
    return out, levels


def frequent_phrases(docs: DataFrame, path: str, least: int = 100, longest: int = 5, text_col: str = "text", lang_col: str = "lang",
                     budget: int = GROUP_LEAVES, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Count all phrases of one to ``longest`` words that occur ``least`` times or more in a language.

    Returns the dictionary of such words (part, id, word, total) and the phrases (part, ids array<long>, f), stored under ``path``, with the number of all
    words of each part as ``n`` in both.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    names, depth = _columns(longest), longest

    def leaf_rows(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for r in left.to_pylist():
            ids = np.concatenate([np.zeros(1, np.int64), id_map(r["n_vocab"], right["places"].to_pylist(), right["ids"].to_pylist())])
            columns, weights = suffixes(ids[unpack(r["tokens"], np.uint32)], depth)
            made.append({"part": r["part"], "n": len(weights), "weights": pack(weights)} | {c: pack(v) for c, v in zip(names, columns)})
        return pa.Table.from_pylist(made, schema=arrow_schema(leaf_ddl))

    packed = ", ".join(f"{c} binary" for c in ["weights", *names])
    leaf_ddl, dealt_ddl = f"part string, n long, {packed}", f"part string, at long, level long, {packed}"

    def subtree(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        columns, weights = merged([np.concatenate([unpack(r[c], np.int64) for r in rows]) for c in names], np.concatenate([unpack(r["weights"], np.int64) for r in rows]))
        out = []
        for d in range(2, depth + 1):
            # A prefix above the budget has leaves in several groups: its count is the sum of all of theirs.
            first, totals = nodes(columns, weights, d, least if d >= rows[0]["level"] else 1)
            flat = np.stack([c[first] for c in columns[:d]], axis=1).reshape(-1) if len(first) else np.empty(0, np.int64)
            ids = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, d, dtype=np.int32)), pa.array(flat))
            out.append(pa.table({"part": pa.array([rows[0]["part"]] * len(first), pa.string()), "ids": ids, "f": pa.array(totals.astype(np.int64))}))
        return pa.concat_tables(out)

    with scratch(spark, "phrase-leaves") as kept:
        with scratch(spark, "phrase-chunks") as temporary:
            with arrow_rows(spark, 500):
                chunks = stored(given.mapInArrow(_tokenizer(chunk_words), _GATHERED), f"{temporary}/tokens")
            dictionary, told = global_ids(chunks, f"{temporary}/ids", least)
            words = stored(spelled(dictionary), f"{path}/words")
            totals = stored(chunks.groupBy("part").agg(F.sum("n").alias("n")), f"{path}/totals")
            leaves = stored(chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(leaf_rows, leaf_ddl), kept)
        n_leaves = leaves.agg(F.sum("n").alias("n")).first()["n"] or 0
        plan = spark.sparkContext.broadcast(vertical_partition(leaves, depth, budget, n_leaves))

        def deal(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    columns, weights = [unpack(r[c], np.int64) for c in names], unpack(r["weights"], np.int64)
                    of, levels = _groups(columns, plan.value)
                    order = np.argsort(of, kind="stable")
                    at, starts = np.unique(of[order], return_index=True)
                    rows = [{"part": r["part"], "at": int(a), "level": int(levels[i[0]]), "weights": pack(weights[i])} | {c: pack(v[i]) for c, v in zip(names, columns)}
                            for a, i in zip(at, np.split(order, starts[1:]) if len(at) else [])]
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema(dealt_ddl))

        with arrow_rows(spark, 1):
            dealt = leaves.where("n > 0").mapInArrow(deal, dealt_ddl)
            phrases = dealt.groupBy("part", "at").applyInArrow(subtree, "part string, ids array<long>, f long")
            phrases = stored(phrases.groupBy("part", "ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least), f"{path}/phrases")
    return words.join(F.broadcast(totals), "part"), phrases.join(F.broadcast(totals), "part")


def _score(batches):
    """The lowest floor(1000 a n / (l r)) of a phrase's cuts, and its l and r; of equal ones that with the shortest first part."""
    for batch in batches:
        got = batch.select(["a", "n", "cuts"]).to_pylist()
        best = []
        for r in got:  # Python's whole numbers have no size limit
            cuts = sorted((1000 * r["a"] * r["n"] // (c["l"] * c["r"]), c["k"], c["l"], c["r"]) for c in r["cuts"])
            best.append(cuts[0])
        columns = [batch.column(c) for c in ("part", "ids", "a", "n")]
        numbers = [pa.array([b[i] for b in best], pa.int64()) for i in (2, 3, 0)]
        yield pa.RecordBatch.from_arrays(columns + numbers, schema=arrow_schema(_SCORED))


_SCORED = "part string, ids array<long>, a long, n long, l long, r long, score long"


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, absorbed_percent: int = 100, text_col: str = "text",
                 lang_col: str = "lang", budget: int = GROUP_LEAVES, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to ``longest`` words with ``least`` occurrences or more is cut after its first k words; a, l and r count the phrase and
    its parts, n all words of the language; the score is the least floor(1000 a n / (l r)) of its cuts. Phrases inside a
    longer candidate of at least ``absorbed_percent`` percent of their count are left out. NULL texts are empty, a NULL language is ``und``; texts
    of any length are read whole, in slices at ends of words; repeated rows count as often as they stand; equal scores rank by count and then by phrase in byte order;
    other columns are ignored; a table without candidates gives no rows.
    """
    spark = docs.sparkSession
    words, phrases = frequent_phrases(docs, scratch_path(spark, "phrases"), least, longest, text_col, lang_col, budget, chunk_words)
    counts = phrases.select("part", "ids", "f").unionByName(words.select("part", F.array("id").alias("ids"), F.col("total").alias("f")))
    size = F.size("ids")
    # Parts of frequent phrases are frequent, so both joins find all of them.
    cuts = phrases.select("part", "ids", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("part", "ids", "a", "n", "k", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select("part", F.col("ids").alias("left"), F.col("f").alias("l")), ["part", "left"])
    cuts = cuts.join(counts.select("part", F.col("ids").alias("right"), F.col("f").alias("r")), ["part", "right"])
    scored = cuts.groupBy("part", "ids", "a", "n").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts")).mapInArrow(_score, _SCORED)  # at most longest - 1 cuts
    inner = phrases.where(size > 2).select("part", "f", "ids", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("part", "f", "ids", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i"))
    inside = inner.groupBy("part", F.expr("slice(ids, i, m)").alias("ids")).agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["part", "ids"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorbed_percent * F.col("a")))
    # Spark keeps the best of each task before the rows of a language meet; equal scores stay until their phrases are spelled.
    first = kept.withColumn("at", F.rank().over(Window.partitionBy("part").orderBy(F.desc("score"), F.desc("a")))).where(F.col("at") <= top)
    order = Window.partitionBy("part").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _spelled_phrases(first, words).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select(F.col("part").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def _spelled_phrases(phrases: DataFrame, words: DataFrame) -> DataFrame:
    numbers = ("part", "ids", "a", "l", "r", "n", "score")
    each = phrases.select(*numbers, F.posexplode("ids").alias("pos", "id"))
    named = each.join(words.select("part", "id", "word"), ["part", "id"])
    shown = named.groupBy(*numbers).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("ws"))
    return shown.select(*numbers, F.array_join("ws.word", " ").alias("phrase"))
