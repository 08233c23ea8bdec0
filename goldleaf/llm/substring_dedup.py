"""Substring deduplication with suffix automata of reference shards.

A word is removed if a window of ``window`` consecutive words around it also starts earlier in the corpus. The
reference of a document is the whole corpus before it, which no executor can hold. So the corpus is cut into
reference shards by content: every window belongs to the shard of its anchor, the least hash among its ``anchor``-word
sequences, and equal windows have equal anchors. Consecutive windows of one anchor form a segment. Segments under
anchors that occur once have no earlier match and are never shipped. A shard streams its distinct segments, in corpus
order, through the suffix automaton of those before: matching statistics of ``window`` words or more mark maximal
spans that began earlier, and segments with anything new extend the automaton.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm import chunks as C
from goldleaf.session import scratch_path

WINDOW, ANCHOR = 20, 8
#: Words per chunk: the windows of a chunk and their anchors take some 40 MB in a Python worker.
CHUNK_WORDS = 750_000
#: Distinct segments per shard, on average; an automaton of these takes some 60 MB.
SHARD_SEGMENTS = 4_000
#: Distinct segments of one anchor beyond which they are dealt by window instead.
ANCHOR_SEGMENTS = 1_000


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers; strings are added one by one."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _child(self, p: int, w: int) -> int:
        """The state for the string of p and then w, split off where a longer one stood for it."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int]) -> None:
        edges, link, length, last = self.next, self.link, self.length, 0
        for w in words:
            if w in edges[last]:
                last = self._child(last, w)
                continue
            now, p = len(edges), last
            edges.append({})
            length.append(length[last] + 1)
            link.append(0)
            while p >= 0 and w not in (own := edges[p]):
                own[w] = now
                p = link[p]
            if p >= 0:
                q = edges[p][w]
                link[now] = q if length[q] == length[p] + 1 else self._child(p, w)
            last = now

    def matches(self, words: list[int]) -> list[int]:
        """Per word the length of the longest string ending there that occurs in an added string."""
        edges, link, length = self.next, self.link, self.length
        state, own, got, out = 0, edges[0], 0, []
        for w in words:
            to = own.get(w)
            while to is None and state:
                state = link[state]
                got, own = length[state], edges[state]
                to = own.get(w)
            if to is not None:
                state, own, got = to, edges[to], got + 1
            out.append(got)
        return out


def _fold(state, words):
    if words:
        state, gap = (state, b" ") if state else (hashlib.sha256(), b"")
        state.update(gap + b" ".join(words))
    return state


def _least_places(keys: np.ndarray, span: int) -> np.ndarray:
    """Place of the first least one of every ``span`` keys in a row."""
    place, width = np.arange(len(keys)), 1
    while width < span:
        step = min(width, span - width)
        left, right = place[:-step], place[step:]
        place = np.where(keys[right] < keys[left], right, left)
        width += step
    return place


def _runs(h: np.ndarray, lens: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor in texts of ``lens`` words, in order: first word (a place in ``h``), number of
    windows, (scrambled) key of the anchor; and per text the number of its first run, and the end."""
    counts = np.maximum(lens - window + 1, 0)
    ends = np.cumsum(counts)
    if not len(counts) or not ends[-1]:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), np.zeros(len(lens) + 1, np.int64)
    keys = C.window_keys(h, anchor)
    windows = np.arange(ends[-1]) + np.repeat(np.cumsum(lens) - lens - ends + counts, counts)  # no window leaves its text
    places = _least_places(keys, window - anchor + 1)[windows]
    first = np.concatenate([[0], np.flatnonzero(np.diff(places)) + 1])  # texts share no place
    return (windows[first], np.diff(first, append=len(windows)), C.mix(keys[places[first]]),
            np.searchsorted(first, np.concatenate([[0], ends])))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text",
                   chunk_words: int = CHUNK_WORDS, shard_segments: int = SHARD_SEGMENTS,
                   anchor_segments: int = ANCHOR_SEGMENTS) -> DataFrame:
    """Remove every word under a window of words that starts earlier: in a smaller id, or earlier in the same document.

    Words are kept unchanged; windows are judged on the input. Returns one row per input row: ``doc_id, n_words,
    n_removed, kept_sha256`` (of the kept words joined by one space) and ``kept`` spans as an array of [start, end)
    word places, NULL where nothing is removed.

    NULL and empty texts have no words. A NULL id comes before all others. Documents that share an id are
    ordered by the hash of their words; equal rows (id and words) are one document and get the same result. Texts shorter
    than a window lose nothing. An empty table gives no rows; other columns are ignored. A document is never cut: one of more
    than ``chunk_words`` words makes a larger chunk, held whole by one task.

    Copies: only the first document of equal words meets the shards; in the others, every window started earlier. Equal
    segments are reduced to the first before the shuffle, by a 64-bit hash, and only the first one's words travel. An anchor with very many distinct segments (a passage
    in most documents, each with its own surroundings) is dealt by whole windows, again reduced to the first, so no
    shard holds an unbounded group. Words are compared by 32-bit hashes inside windows of equal 64-bit anchors.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    chunks = C.write_chunks(docs, id_col, text_col, "dedup-chunks", digest=_fold, chunk_words=chunk_words, spelled=True)
    nothing = F.lit(hashlib.sha256().digest())
    each = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "lens", "digests")).alias("at", "d"))
    rows = each.select("chunk", "at", F.col("d.ids").cast(id_type).alias("doc_id"), F.col("d.lens").cast("long").alias("n_words"),
                       F.coalesce("d.digests", nothing).alias("sha"))
    first = rows.where(F.col("n_words") >= window).groupBy("sha").agg(F.min(F.struct("doc_id", "chunk", "at")).alias("r")).select(
        "sha", F.col("r.doc_id").alias("first_id"), "r.chunk", "r.at", C.node_id(F.col("r.chunk"), F.col("r.at")).alias("node"))
    path = scratch_path(spark, "dedup-firsts")
    first.write.parquet(path)
    first = spark.read.parquet(path)
    small = chunks.select("chunk", "lens", "tokens", "hashes", "words")
    shards = C.shard_count(chunks, 2.0 / (window - anchor + 2))

    def chunk_runs(row):
        """Word hashes of a chunk's texts in a row, and their runs."""
        h = C.word_hashes(C.spelled_words(row.words))[C.unpack(row.tokens, np.uint32)]
        return h, _runs(h, np.asarray(row.lens, np.int64), window, anchor)

    def ask(frames):
        for pdf in frames:
            for row in pdf.itertuples():
                keys, counts = np.unique(chunk_runs(row)[1][2], return_counts=True)
                yield pd.DataFrame(C.questions(row.chunk, 1, 0, keys, counts, shards),
                                   columns=["chunk", "shard", "kind", "role", "keys", "counts"])

    answers = C.answer(small.mapInPandas(ask, C.ASK), ((0,),), scratch_path(spark, "dedup-anchors"), 2)
    rank = F.expr("conv(hex(substring(sha, 1, 8)), 16, -10)").cast("long")
    picked = first.groupBy("chunk").agg(F.collect_list(F.struct("at", F.col("first_id").cast("string").alias("id"), rank.alias("rank"))).alias("picked"))

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, packer = [], zstandard.ZstdCompressor(level=1)
        for row in left.itertuples():
            h, (starts, ns, own, bounds) = chunk_runs(row)
            again = (C.told(right, 1, 0) > 1)[np.searchsorted(np.unique(own), own)]
            vocab, hashes = C.spelled_words(row.words), memoryview(h).cast("B")
            tokens, ends = C.unpack(row.tokens, np.uint32), np.cumsum(row.lens)
            for doc in row.picked:  # at most a chunk's documents
                at = doc["at"]
                a, b = bounds[at:at + 2]
                hit = a + np.flatnonzero(again[a:b])
                if len(hit):
                    begin, end = int(ends[at] - row.lens[at]), int(ends[at])
                    sids = [xxhash.xxh64_intdigest(hashes[8 * i:8 * (i + n + window - 1)]) - (1 << 63)
                            for i, n in zip(starts[hit].tolist(), ns[hit].tolist())]
                    text = packer.compress(b" ".join([vocab[i] for i in tokens[begin:end].tolist()]))
                    out.append(((row.chunk << 17) + int(at), doc["id"], doc["rank"], starts[hit] - begin, ns[hit].astype(np.int32),
                                own[hit].view(np.int64), sids, text))
        return pd.DataFrame(out, columns=["node", "doc_id", "rank", "starts", "ns", "anchors", "sids", "text"])

    path = scratch_path(spark, "dedup-candidates")
    small.join(picked.hint("merge"), "chunk").groupBy("chunk").cogroup(answers.where("chunk >= 0").groupBy("chunk")).applyInPandas(
        cut, "node long, doc_id string, rank long, starts array<long>, ns array<int>, anchors array<long>, sids array<long>, text binary").write.option(
        "compression", "zstd").parquet(path)
    candidates = spark.read.parquet(path).withColumn("doc_id", F.col("doc_id").cast(id_type))
    segments = candidates.select("node", "doc_id", "rank", F.explode(F.arrays_zip("starts", "ns", "anchors", "sids")).alias("s")).select(
        "node", "doc_id", "rank", F.col("s.starts").alias("start"), F.col("s.ns").alias("n"), F.col("s.anchors").alias("anchor"), F.col("s.sids").alias("sid"))
    # A segment's hash stands for it, its anchor and its length.
    place = F.struct("doc_id", "rank", "start", "node", "n", "anchor")
    path = scratch_path(spark, "dedup-distinct")
    segments.groupBy("sid").agg(F.min(place).alias("first")).select("sid", "first.n", "first.anchor", F.struct(
        "first.doc_id", "first.rank", "first.start", "first.node").alias("first")).write.parquet(path)
    distinct = spark.read.parquet(path)

    def spell(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples():
                h = C.word_hashes(C.spelled_words(row.text)).astype(np.uint32).tobytes()
                out += [(anchor, sid, n, h[4 * start:4 * (start + n + window - 1)], row.doc_id, row.rank, start)
                        for anchor, sid, start, n in zip(*(x.tolist() for x in (row.anchors, row.sids, row.starts, row.ns)))]
            yield pd.DataFrame(out, columns=["anchor", "sid", "n", "words", "doc_id", "rank", "start"])

    wanted = distinct.groupBy(F.col("first.node").alias("node")).agg(  # at most a document's segments
        F.collect_list(F.struct("anchor", "sid", F.col("first.start").alias("start"), "n")).alias("wanted"))
    texts = candidates.select("node", "text")
    path = scratch_path(spark, "dedup-spelled")
    spelling = candidates.select("node", F.col("doc_id").cast("string").alias("doc_id"), "rank", "text").join(wanted, "node").select(
        "doc_id", "rank", "text", *[F.col(f"wanted.{x}").alias(f"{x}s") for x in ("anchor", "sid", "start", "n")])
    spelling.mapInPandas(spell, "anchor long, sid long, n int, words binary, doc_id string, rank long, start long").withColumn(
        "doc_id", F.col("doc_id").cast(id_type)).write.parquet(path)
    spelled = spark.read.parquet(path)
    path = scratch_path(spark, "dedup-crowded")  # written, so its true size decides how it is joined
    distinct.groupBy("anchor").agg(F.count("*").alias("c")).where(F.col("c") > anchor_segments).select("anchor").write.parquet(path)
    crowded = spark.read.parquet(path)
    n_shards = distinct.count() // shard_segments + 1

    def stream(g: pd.DataFrame) -> pd.DataFrame:
        automaton, masks = SuffixAutomaton(), []
        g = g.sort_values(["has_id", "doc_id", "rank", "start"])
        for words, n in zip(g["words"], g["n"]):
            words = np.frombuffer(words, np.uint32).tolist()
            ends = automaton.matches(words)[window - 1:]
            mask = sum(1 << i for i, got in enumerate(ends) if got >= window) if max(ends) >= window else 0
            if mask != (1 << n) - 1:
                automaton.add(words)
            masks.append(mask)
        return pd.DataFrame({"sid": g["sid"], "mask": masks})

    zero = F.lit(0 if id_type != "string" else "").cast(id_type)
    quiet = spelled.join(crowded, "anchor", "left_anti").select(
        F.pmod("anchor", F.lit(n_shards)).alias("shard"), "sid", "words", "n", F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce("doc_id", zero).alias("doc_id"), "rank", "start")
    masks = quiet.groupBy("shard").applyInPandas(stream, "sid long, mask long")
    windows = spelled.join(crowded, "anchor").select("sid", "words", "doc_id", "rank", "start", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    windows = windows.select("sid", "i", F.expr(f"substring(words, 1 + 4 * i, {4 * window})").alias("w"),
                             F.struct("doc_id", "rank", (F.col("start") + F.col("i")).alias("start")).alias("at"))
    earliest = windows.groupBy("w").agg(F.min("at").alias("least"))
    later = windows.join(earliest, "w").groupBy("sid").agg(
        F.sum(F.when(F.col("least") < F.col("at"), F.expr("shiftleft(1L, i)")).otherwise(0)).alias("mask"))
    judged = distinct.select("sid", F.col("first.node").alias("first_node"), F.col("first.start").alias("first_start")).join(
        masks.unionByName(later), "sid")
    is_first = (F.col("node") == F.col("first_node")) & (F.col("start") == F.col("first_start"))
    spans = (segments.select("node", "start", "n", "sid").join(judged, "sid")
             .select("node", "start", F.when(is_first, F.col("mask")).otherwise(F.expr("shiftleft(1L, n) - 1")).alias("mask"))
             .where("mask <> 0").groupBy("node").agg(F.collect_list(F.struct("start", "mask")).alias("spans")))

    bits = np.arange(window - anchor + 1)  # a run has one anchor, so at most these windows

    def strip(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples():
                words = C.spelled_words(row.text)
                span, bit = np.nonzero(row.masks[:, None] >> bits & 1)
                at = row.starts[span] + bit
                change = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + window, minlength=len(words) + 1)
                stays = np.cumsum(change[:-1]) == 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], stays, [False]]).astype(np.int8)))
                spans = edges.reshape(-1, 2).tolist()
                kept = b" ".join([w for a, b in spans for w in words[a:b]])
                out.append((row.node, int((~stays).sum()), hashlib.sha256(kept).hexdigest(), spans))
            yield pd.DataFrame(out, columns=["node", "n_removed", "kept_sha256", "kept"])

    stripped = texts.join(spans, "node").select("node", "text", F.col("spans.start").alias("starts"), F.col("spans.mask").alias("masks")).mapInPandas(strip, "node long, n_removed long, kept_sha256 string, kept array<array<int>>")
    done = first.join(stripped, "node", "left").select("sha", "first_id", F.lit(True).alias("long"), "n_removed", "kept_sha256", "kept")
    result = rows.join(done, "sha", "left")
    copy = F.coalesce("long", F.lit(False)) & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    return result.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                         F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
                         F.when(copy, F.array().cast("array<array<int>>")).otherwise(F.col("kept")).alias("kept"))
