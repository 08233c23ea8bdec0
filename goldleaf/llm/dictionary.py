"""One dictionary over the vocabularies of all chunks, built by word ranges, and scratch folders that end with their use.

A chunk's vocabulary is its distinct words, joined by spaces and compressed, with their counts in the chunk. Every
chunk sends its words, cut by a hash of the word, to shards; a shard adds up equal words (compared as spelled; the hash only chooses the
shard), numbers them, and answers each chunk with the numbers of its words. A number is the word's rank in its shard, spread over the
shards, so no shard needs to know of any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.chunks import pack, spelled_words, unpack, word_hashes
from goldleaf.session import scratch_path
from goldleaf.sources.shared_files import delete

#: Vocabulary entries that a shard adds up, on average.
SHARD_WORDS = 1_000_000
#: Words of a shard's result per row.
_ROW_WORDS = 50_000
ASKED = "chunk long, shard long, part string, words binary, counts binary, places binary"
TOLD = "chunk long, part string, places binary, ids binary, words binary, totals binary"


_ARROW = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow's form of a plain "name type, ..." schema, which tasks can make without a session."""
    def of(kind: str) -> pa.DataType:
        return pa.list_(_ARROW[kind[6:-1]]) if kind.startswith("array<") else _ARROW[kind]

    return pa.schema([(name, of(kind)) for name, kind in (field.split() for field in ddl.split(","))])


def packed_words(words) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def word_list(packed: bytes, n: int) -> list[bytes]:
    """The words of a vocabulary of n words."""
    return spelled_words(packed) if n else []


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder under the shared checkpoint root that is deleted when the block ends, however it ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        delete(spark, path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write rows that are packed already and read them back."""
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_ids(chunks: DataFrame, path: str, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """Number all words (per part) that occur at least ``min_count`` times over all chunks, from 1.

    ``chunks`` has chunk, part, n_vocab, words and counts (packed uint32). Returns, written under ``path``, the dictionary as packed rows
    (part, ids, words, totals) and the answers (chunk, places, ids): the numbers of a chunk's words, 0 for those below.
    """
    total = chunks.agg(F.sum("n_vocab").alias("n")).first()["n"] or 0
    shards = int(total // SHARD_WORDS) + 1

    def ask(batches):
        out = arrow_schema(ASKED)
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = word_list(row["words"], row["n_vocab"]), unpack(row["counts"], np.uint32)
                shard = (word_hashes(words) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                asked = [{"chunk": row["chunk"], "shard": int(s), "part": row["part"], "words": packed_words([words[i] for i in at]),
                          "counts": pack(counts[at]), "places": pack(at.astype(np.uint32))}
                         for s in np.flatnonzero(np.diff(cut)) for at in [order[cut[s]:cut[s + 1]]]]
                yield pa.RecordBatch.from_pylist(asked, schema=out)

    def number(table: pa.Table) -> pa.Table:
        out, rows = arrow_schema(TOLD), table.to_pylist()
        totals: dict[str, dict[bytes, int]] = {}
        for r in rows:
            known = totals.setdefault(r["part"], {})
            for word, c in zip(spelled_words(r["words"]), unpack(r["counts"], np.uint32).tolist()):
                known[word] = known.get(word, 0) + c
        made, at, shard = [], 0, rows[0]["shard"]
        numbers: dict[str, dict[bytes, int]] = {}
        for part in sorted(totals):
            kept = sorted(w for w, c in totals[part].items() if c >= min_count)
            numbers[part] = {w: (at + i) * shards + shard + 1 for i, w in enumerate(kept)}
            at += len(kept)
            for i in range(0, len(kept), _ROW_WORDS):
                some = kept[i:i + _ROW_WORDS]
                made.append({"chunk": None, "part": part, "places": None, "words": packed_words(some),
                             "ids": pack(np.array([numbers[part][w] for w in some], np.int64)),
                             "totals": pack(np.array([totals[part][w] for w in some], np.int64))})
        for r in rows:
            of = numbers[r["part"]]
            ids = np.array([of.get(w, 0) for w in spelled_words(r["words"])], np.int64)
            made.append({"chunk": r["chunk"], "part": r["part"], "places": r["places"], "ids": pack(ids), "words": None, "totals": None})
        return pa.Table.from_pylist(made, schema=out)

    asked = chunks.select("chunk", "part", "n_vocab", "words", "counts").where("n_vocab > 0").mapInArrow(ask, ASKED)
    told = stored(asked.groupBy("shard").applyInArrow(number, TOLD), path)
    return (told.where("chunk is null").select("part", "ids", "words", "totals"),
            told.where("chunk is not null").select("chunk", "places", "ids"))


def id_map(n_vocab: int, places: list[bytes], ids: list[bytes]) -> np.ndarray:
    """Numbers of a chunk's words in vocabulary order, from the answers to it."""
    out = np.zeros(n_vocab, np.int64)
    for p, i in zip(places, ids):
        out[unpack(p, np.uint32)] = unpack(i, np.int64)
    return out


def spelled(dictionary: DataFrame) -> DataFrame:
    """The dictionary with one row per word: part, id, word, total."""

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words = spelled_words(r["words"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(words), pa.string()), pa.array(unpack(r["ids"], np.int64)),
                     pa.array([w.decode() for w in words], pa.string()), pa.array(unpack(r["totals"], np.int64))],
                    names=["part", "id", "word", "total"])

    return dictionary.mapInArrow(rows, "part string, id long, word string, total long")
