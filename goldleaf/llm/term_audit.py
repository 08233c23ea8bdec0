"""Audit of five document filters, alone and in every order, over a sparse document-term matrix.

Words are numbered in one dictionary over all documents; the matrix is written as shards of compressed sparse rows
(row pointers, word numbers, counts). Row sums and nonzero counts of the matrix decide the length filter A and the variety filter B;
capitals C, symbols D and copies E are attached, and documents are counted by the set of filters they fail. All 120 orders
are read from these at most 32 counts per part.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.chunks import arrow_rows, pack, unpack, word_lists
from goldleaf.llm.dictionary import arrow_schema, global_ids, id_map, packed_words, scratch, stored
from goldleaf.session import scratch_path

#: Nonzero entries, documents and text bytes at which a shard is closed.
SHARD_ENTRIES, SHARD_DOCS, SHARD_BYTES = 500_000, 20_000, 1 << 25
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, b"#$%&*|"
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))
_PER_DOC = [("doc_ids", "string"), ("parts", "string"), ("failed", "int"), ("digests", "binary")]


class _Rows:
    """Sparse rows that are being gathered, over a vocabulary of their own."""

    def __init__(self):
        self.vocab: dict[bytes, int] = {}
        self.docs, self.at, self.indices, self.data, self.n, self.size = [], [0], [], [], 0, 0

    def add(self, doc_id, part, text: bytes) -> None:
        found: Counter = Counter()
        for some in word_lists(text):
            found.update(some)
        vocab = self.vocab
        self.indices.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in found), np.uint32, len(found)))
        self.data.append(np.fromiter(found.values(), np.int64, len(found)))
        self.n += len(found)
        self.size += len(text)
        self.at.append(self.n)
        points = len(text.translate(None, _CONTINUATION))
        capitals = len(text) - len(text.translate(None, _CAPITALS))
        failed = 4 * (100 * capitals > CAPITAL_PERCENT * points) + 8 * bool(text.translate(None, _NOT_SYMBOLS))
        self.docs.append((doc_id, part, int(failed), hashlib.sha256(text).digest()))

    def row(self, chunk: int) -> dict:
        indices = np.concatenate([np.empty(0, np.uint32), *self.indices])
        data = np.concatenate([np.empty(0, np.int64), *self.data])
        counts = np.zeros(len(self.vocab), np.int64)
        np.add.at(counts, indices, data)
        return {"chunk": chunk, "part": "", "n_vocab": len(self.vocab), "words": packed_words(self.vocab), "counts": pack(counts.astype(np.uint32)),
                "indptr": pack(np.array(self.at, np.int64)), "indices": pack(indices), "data": pack(data)} | \
            {name: [d[i] for d in self.docs] for i, (name, _) in enumerate(_PER_DOC)}


_ARRAYS = ", ".join(f"{name} array<{kind}>" for name, kind in _PER_DOC)
_GATHERED = f"chunk long, part string, n_vocab long, words binary, counts binary, indptr binary, indices binary, data binary, {_ARRAYS}"
MATRIX = f"shard long, indptr binary, indices binary, data binary, n_words array<long>, n_distinct array<long>, {_ARRAYS}"


def _gather(batches):
    out, made, first = arrow_schema(_GATHERED), 0, TaskContext.get().partitionId() << 24
    rows = _Rows()
    for batch in batches:
        for doc_id, part, text in zip(*(c.to_pylist() for c in batch.columns)):
            rows.add(doc_id, part, text)
            if rows.n >= SHARD_ENTRIES or len(rows.docs) >= SHARD_DOCS or rows.size >= SHARD_BYTES:
                yield pa.RecordBatch.from_pylist([rows.row(first + made)], schema=out)
                made, rows = made + 1, _Rows()
    if rows.docs:
        yield pa.RecordBatch.from_pylist([rows.row(first + made)], schema=out)


def _number(left: pa.Table, right: pa.Table) -> pa.Table:
    """A shard with its word numbers replaced by those of the dictionary, and its row sums and nonzero counts."""
    made = []
    for r in left.to_pylist():
        ids = id_map(r["n_vocab"], right["places"].to_pylist(), right["ids"].to_pylist())
        indptr, data = unpack(r["indptr"], np.int64), unpack(r["data"], np.int64)
        sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(data)])
        made.append({"shard": r["chunk"], "indptr": r["indptr"], "indices": pack(ids[unpack(r["indices"], np.uint32)]), "data": r["data"],
                     "n_words": (sums[indptr[1:]] - sums[indptr[:-1]]).tolist(), "n_distinct": np.diff(indptr).tolist()} | {name: r[name] for name, _ in _PER_DOC})
    return pa.Table.from_pylist(made, schema=arrow_schema(MATRIX))


def document_term_matrix(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", part: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the matrix of word counts under ``path`` and return its shards and its dictionary.

    A shard row holds packed ``indptr`` (int64), ``indices`` (int64 dictionary numbers) and ``data`` (int64) of some documents, and per document its
    id as text, part, failed filters C and D (bits 4 and 8), SHA-256 of the text, row sum and nonzero count. A NULL text is an empty row.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("string").alias("id"), (F.lit("") if part is None else part).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    with scratch(spark, "term-rows") as rows:
        with arrow_rows(spark, 500):
            gathered = stored(given.mapInArrow(_gather, _GATHERED), rows)
        words, told = global_ids(gathered, f"{path}/words")
        shards = gathered.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_number, MATRIX)
        return stored(shards, f"{path}/shards"), words


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per document: part, id (its own type) and ``failed``, the sum of 1, 2, 4, 8, 16 for the filters A to E that it fails.

    NULL and empty texts have no words and fail A alone (and E as copies of each other). A NULL id has no smaller one, so it never fails E,
    nor does a repeated row with the least id of its text. A NULL part counts as ''. Whole texts of any length are read; other columns
    are ignored. An empty table gives no rows.
    """
    path = scratch_path(docs.sparkSession, "term-matrix")
    shards, _ = document_term_matrix(docs, path, id_col, text_col, F.coalesce(F.col(part_col).cast("string"), F.lit("")))
    per_doc = ["n_words", "n_distinct", *(name for name, _ in _PER_DOC)]
    one = shards.select(F.explode(F.arrays_zip(*per_doc)).alias("d")).select(
        F.col("d.doc_ids").cast(docs.schema[id_col].dataType).alias("doc_id"), F.col("d.parts").alias("part"), F.col("d.digests").alias("digest"),
        (F.when(F.col("d.n_words") < MIN_WORDS, 1).otherwise(0) + F.when(100 * F.col("d.n_distinct") < DISTINCT_PERCENT * F.col("d.n_words"), 2).otherwise(0)
         + F.col("d.failed")).alias("failed"))
    # Copies meet by text and id, never by text alone, so a text of very many copies is not one key.
    first = one.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").select("digest", "doc_id", F.lit(True).alias("is_first"))
    return one.join(first, ["digest", "doc_id"], "left").select(
        "part", "doc_id", (F.col("failed") + F.when(F.col("doc_id").isNotNull() & F.col("is_first").isNull(), 16).otherwise(0)).cast("int").alias("failed"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What each filter removes at each step of each of the 120 orders, per part: one row per part, order and step.

    ``labels`` has doc_id, quality and toxic; a document is good (toxic) if any of its labels is quality = 1 (toxic = 1); unlabelled ones and
    NULLs are neither. Documents are read as by ``failures``; an empty table gives no rows.
    """
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    cells = failures(docs, id_col, text_col, part_col).join(marks, "doc_id", "left").groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))  # at most 32 of a part
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.select("part", "cells", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))
    bit = "shiftleft(1, instr('ABCDE', substring(filter_order, {}, 1)) - 1)"
    steps = steps.withColumns({"own": F.expr(bit.format("step")),
                               "before": F.expr(f"aggregate(filter(sequence(1, 5), i -> i < step), 0, (a, i) -> a | {bit.format('i')})")})

    def total(what: str, of: str) -> Column:
        return F.expr(f"aggregate(cells, 0L, (a, c) -> a + if({of}, {what}, 0L))")

    gone = "c.failed & before = 0 and c.failed & own > 0"
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("c.n", "c.failed & (before | own) = 0").alias("kept"), total("c.n", gone).alias("removed"),
        total("c.n", "c.failed & own > 0 and c.failed & before > 0").alias("redundant"), total("c.n", "c.failed = own").alias("unique_fails"),
        total("c.good", gone).alias("good_lost"), total("c.toxic", gone).alias("toxic_lost"),
        # A filter is the first of the k that a document fails in 120 / k orders.
        total("c.n * 120 div bit_count(c.failed)", "c.failed & own > 0").alias("shapley"))
