"""Texts as chunks of word numbers, and a count service for 64-bit keys over all chunks.

Operators that need statistics of every word window of a corpus first write their texts as chunks: some
million words of whole documents each, as numbers into the chunk's own vocabulary, with the 64-bit hash
of every vocabulary word. All later passes read the chunks, so a retried task sees the same chunk again.
To learn corpus-wide counts, a chunk sends its distinct keys with their local counts, cut by key range
into shards; each shard sums the keys of all chunks and answers every chunk with totals in the order asked.
Numbers travel as compressed byte planes, so a key costs about six bytes and a count a few bits.
Two different words or windows are taken for the same only if their 64-bit hashes collide.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.session import scratch_path

#: Words per chunk: some 200 MB of working memory in a Python worker.
CHUNK_WORDS = 1_500_000
#: Documents per chunk, for tables of very short texts.
CHUNK_DOCS = 100_000
#: Keys that a shard sums at once, on average.
SHARD_KEYS = 2_000_000
#: Keys of a shard that are sorted and summed in one step, on average; a step takes some 60 bytes a key.
RANGE_KEYS = 1 << 18
_CUT = re.compile(rb"[ \t\n\r\x0b\x0c]")
_U64 = np.uint64


def pack(a: np.ndarray) -> bytes:
    """Compressed byte planes of an array of fixed-size numbers."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) if len(a) else b""


def unpack(b: bytes, dtype) -> np.ndarray:
    if not b:
        return np.empty(0, dtype)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, so that key ranges are even."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
        return h ^ (h >> _U64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key of a sequence from the key of its beginning and that of its last word."""
    with np.errstate(over="ignore"):
        return mix(left * _U64(0x9E3779B97F4A7C15) + right)


def window_keys(words: np.ndarray, k: int) -> np.ndarray:
    """Keys of all windows of k word hashes, in order."""
    n = max(0, len(words) - k + 1)
    out = words[:n].copy()
    with np.errstate(over="ignore"):
        for j in range(1, k):
            out *= _U64(0x9E3779B97F4A7C15)
            out += words[j:n + j]
    return mix(out)


def word_hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def spelled_words(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b" ")


def document_hashes(row) -> list[np.ndarray]:
    """Word hashes of each document of a chunk row."""
    hashes = unpack(row.hashes, np.uint64) if row.hashes else word_hashes(spelled_words(row.words))
    return np.split(hashes[unpack(row.tokens, np.uint32)], np.cumsum(row.lens)[:-1])


def node_id(chunk: Column, at: Column) -> Column:
    """A number for a document by its chunk and its place there (a chunk holds at most 2**17 documents)."""
    return F.shiftleft(chunk, 17) + at


def word_lists(data: bytes, limit: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``limit`` bytes."""
    at = 0
    while at < len(data):
        end = at + limit
        cut = _CUT.search(data, end) if end < len(data) else None
        end = cut.end() if cut else len(data)
        yield data[at:end].split()
        at = end


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Rows per Arrow batch for the jobs run inside, which bounds a batch of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_bytes(spark: SparkSession, n: int):
    """Bytes per Arrow batch for the jobs run inside, which bounds a batch of chunks; a larger row is a batch of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class _Open:
    """A chunk that is being filled."""

    def __init__(self, end_token: bool):
        self.vocab: dict[bytes, int] = defaultdict()
        self.vocab.default_factory = self.vocab.__len__
        if end_token:
            self.vocab[b" end"]  # no word holds a space
        self.end, self.n, self.ids, self.lens, self.parts, self.digests = end_token, 0, [], [], [], []

    def add(self, doc_id, data: bytes, digest: Callable | None) -> None:
        got, state = [], None
        for part in word_lists(data):
            got.append(np.fromiter(map(self.vocab.__getitem__, part), np.uint32, len(part)))
            if digest:
                state = digest(state, part)
        if self.end:
            got.append(np.zeros(1, np.uint32))
        self.ids.append(doc_id)
        self.lens.append(n := sum(map(len, got)))
        self.parts += got
        self.digests.append(state.digest() if state else None)
        self.n += n

    def row(self, chunk: int, role: int, spelled: bool) -> dict:
        tokens = np.concatenate([np.empty(0, np.uint32), *self.parts])
        return {"chunk": chunk, "role": role, "n": self.n, "ids": self.ids, "lens": self.lens, "tokens": pack(tokens),
                "hashes": b"" if spelled else pack(word_hashes(self.vocab)),
                "words": zstandard.ZstdCompressor(level=1).compress(b" ".join(self.vocab)) if spelled else b"", "digests": self.digests}


def write_chunks(docs: DataFrame, id_col: str, text_col: str, name: str, lower: bool = False, end_token: bool = False,
                 role: Column | None = None, digest: Callable | None = None, chunk_words: int = CHUNK_WORDS,
                 spelled: bool = False, path: str | None = None) -> DataFrame:
    """Write the texts as chunks of whole documents to the shared folder (or to ``path``) and return them.

    ``role`` (a small integer) keeps documents of different roles in different chunks. ``digest(state, words)``
    folds lists of a document's words into a hashlib object (from None). The vocabulary is kept as hashes, or as words where ``spelled``.
    Ids are kept as text (NULL stays NULL).
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                        (F.lit(0) if role is None else role).cast("int").alias("role"))
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("role", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(T.StringType())),
                           T.StructField("lens", T.ArrayType(T.IntegerType())), T.StructField("tokens", T.BinaryType()),
                           T.StructField("hashes", T.BinaryType()), T.StructField("words", T.BinaryType()),
                           T.StructField("digests", T.ArrayType(T.BinaryType()))])

    def encode(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        made, at = 0, TaskContext.get().partitionId() << 20
        opened: dict[int, _Open] = {}
        for batch in batches:
            for doc_id, text, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if kind not in opened:
                    opened[kind] = _Open(end_token)
                c = opened[kind]
                c.add(doc_id, text.lower() if lower else text, digest)
                if c.n >= chunk_words or len(c.ids) >= CHUNK_DOCS:
                    yield pa.RecordBatch.from_pylist([c.row(at + made, kind, spelled)], schema=out)
                    made += 1
                    del opened[kind]
        for kind, c in opened.items():
            yield pa.RecordBatch.from_pylist([c.row(at + made, kind, spelled)], schema=out)
            made += 1

    path = path or scratch_path(spark, name)
    with arrow_rows(spark, 1000):
        given.mapInArrow(encode, schema).write.option("compression", "none").parquet(path)
    return spark.read.schema(schema).parquet(path)


#: Columns of a question (one shard of a chunk's sorted keys) and of its answer.
ASK = "chunk long, shard long, kind int, role int, keys binary, counts binary"
ANSWER = "chunk long, shard long, kind int, totals array<binary>, sums array<long>"


def questions(chunk: int, kind: int, role: int, keys: np.ndarray, counts: np.ndarray | None, shards: int) -> list[tuple]:
    """Rows of ASK for a chunk's distinct keys, which must be sorted; counts of None are all 1."""
    cut = np.searchsorted((keys >> _U64(32)) * _U64(shards) >> _U64(32), np.arange(shards + 1, dtype=np.uint64))
    out = []
    for s in np.flatnonzero(np.diff(cut)):
        a, b = cut[s], cut[s + 1]
        out.append((chunk, int(s), kind, role, pack(keys[a:b]), b"" if counts is None else pack(counts[a:b].astype(np.uint32))))
    return out


def _ranges(keys: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Cuts sorted lists of keys at the same keys, some RANGE_KEYS of all lists between two cuts; per range the place of each list's first key and of its end."""
    some = [k for k in keys if len(k)]
    low, high = min((int(k[0]) for k in some), default=0), max((int(k[-1]) for k in some), default=0)
    n = sum(map(len, keys)) // RANGE_KEYS + 1
    bounds = np.array([low + (high - low) * j // n for j in range(1, n)], np.uint64)
    before = np.zeros(len(keys), np.int64)
    for j in range(n):
        after = np.array([np.searchsorted(k, bounds[j]) if j < n - 1 else len(k) for k in keys], np.int64)
        yield np.stack([before, after], axis=1)
        before = after


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Let Spark remove the shuffle files of each query run inside as the query ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def removes_shuffles(operator: Callable) -> Callable:
    """An operator whose own queries, each written and reread, run under ``shuffles_removed``; the frame it returns does not."""
    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs):
        with shuffles_removed(docs.sparkSession):
            return operator(docs, *args, **kwargs)
    return run


def answer(asked: DataFrame, totals: tuple[tuple[int, ...], ...], path: str, cap: int | None = None,
           told_to: tuple[tuple[int, ...] | None, ...] | None = None) -> DataFrame:
    """Sum the counts of equal keys over all chunks; one total per set of roles in ``totals``.

    Writes and returns rows of ANSWER: per question its totals in the order of its keys, and under chunk -1 the
    sum and the number of distinct keys of each total in the shard. ``cap`` limits what is told of a total.
    ``told_to`` names per total the roles whose questions are told it (None: all); the others get none.
    """
    to_roles = told_to or (None,) * len(totals)

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack(k, np.uint64) for k in g["keys"]]
        counts = [unpack(c, np.uint32) if c else None for c in g["counts"]]
        wanted = [np.isin(g["role"].to_numpy(), roles) for roles in totals]
        told = [[np.empty(len(k), np.uint32) if to is None or r in to else None for k, r in zip(keys, g["role"])] for to in to_roles]
        sums = [0] * (2 * len(totals))
        for cut in _ranges(keys):
            here = [slice(*x) for x in cut]
            lens = np.diff(cut).ravel()
            part = np.concatenate([k[x] for k, x in zip(keys, here)])
            if not len(part):
                continue
            times = np.concatenate([np.ones(n, np.uint32) if c is None else c[x] for c, x, n in zip(counts, here, lens)])
            order = np.argsort(part, kind="stable")
            part = part[order]
            new = np.empty(len(part), bool)
            new[0] = True
            np.not_equal(part[1:], part[:-1], out=new[1:])
            starts, number, each = np.flatnonzero(new), np.cumsum(new) - 1, np.empty(len(part), np.uint32)
            ends = np.cumsum(lens)
            for t, own in enumerate(wanted):
                per_key = np.add.reduceat(np.where(np.repeat(own, lens), times, 0)[order].astype(np.int64), starts)
                sums[2 * t] += int(per_key.sum())
                sums[2 * t + 1] += int((per_key > 0).sum())
                each[order] = (per_key if cap is None else np.minimum(per_key, cap))[number]
                for i in (i for i in np.flatnonzero(lens) if told[t][i] is not None):
                    told[t][i][here[i]] = each[ends[i] - lens[i]:ends[i]]
        rows = [(c, s, k, [b"" if t[i] is None else pack(t[i]) for t in told], None)
                for i, (c, s, k) in enumerate(zip(g["chunk"], g["shard"], g["kind"]))]
        rows.append((-1, int(g["shard"].iloc[0]), int(g["kind"].iloc[0]), None, sums))
        return pd.DataFrame(rows, columns=["chunk", "shard", "kind", "totals", "sums"])

    asked.groupBy("shard", "kind").applyInPandas(merge, ANSWER).write.option("compression", "none").parquet(path)
    return asked.sparkSession.read.schema(ANSWER).parquet(path)


def shard_count(chunks: DataFrame, keys_per_word: float = 1.0) -> int:
    words = chunks.agg(F.sum("n").alias("n")).first()["n"] or 0
    return max(1, int(words * keys_per_word / SHARD_KEYS) + 1)


def told(answers: pd.DataFrame, kind: int, which: int) -> np.ndarray:
    """A chunk's totals of one kind in the order of its sorted keys."""
    own = answers[answers["kind"] == kind].sort_values("shard")
    return np.concatenate([np.empty(0, np.uint32), *(unpack(t[which], np.uint32) for t in own["totals"])])
