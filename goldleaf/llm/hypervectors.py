"""Language identification by hyperdimensional letter profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound to one vector: the vectors of its letters, rotated by
two, one and no places, are multiplied. A document is the sum (bundle) of the vectors of its trigrams, a language the bundle of
the documents labelled with it, and a document's language is the one whose bundle has the greatest cosine with the document's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.llm.chunks import arrow_rows

DIMENSIONS = 1024
SEED = 7
UNKNOWN = "und"
#: Characters and trigrams that are worked on at once.
_SLICE_CHARS, _BLOCK_TRIGRAMS = 1 << 20, 1 << 12
#: Languages whose vectors a pass over the documents carries (4 KB each); more languages take more passes.
PASS_LANGUAGES = 2_000
#: Partial sums per language, so that no task adds up the vectors of all others.
_SALTS = 64


@lru_cache(maxsize=1)
def _lowered() -> np.ndarray:
    """Per code point: that of its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(maxsize=4096)
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The random vector of a letter (0: the edge of a word), the same on every machine."""
    bits = np.frombuffer(hashlib.shake_256(f"{seed}:{code}".encode()).digest((dimensions + 7) // 8), np.uint8)
    return 2 * np.unpackbits(bits)[:dimensions].astype(np.int8) - 1


def trigram_vectors(a: np.ndarray, b: np.ndarray, c: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """One row per trigram: its letters' vectors, rotated by place, multiplied."""
    letters, at = np.unique(np.concatenate([a, b, c]), return_inverse=True)
    own = np.stack([letter_vector(int(x), dimensions, seed) for x in letters])
    a, b, c = np.split(at, 3)
    out = np.roll(own, 2, axis=1)[a]
    out *= np.roll(own, 1, axis=1)[b]
    out *= own[c]
    return out.astype(np.float32)


def bundles(texts: list[str], groups: np.ndarray, n_groups: int, dimensions: int, seed: int) -> np.ndarray:
    """Sums of the trigram vectors of all texts of each group. A trigram is a letter with its two neighbours; what is no letter is an edge."""
    out = np.zeros((n_groups, dimensions))
    codes, owners, held = [], [], 0

    def flush() -> None:
        nonlocal codes, owners, held
        if not codes:
            return
        s, of = np.concatenate(codes), np.repeat(np.array([g for g, _ in owners]), [n for _, n in owners])
        letters = np.flatnonzero(np.bincount(s)) if len(s) else s
        small = np.zeros(int(letters[-1]) + 1, np.int64)
        small[letters] = np.arange(len(letters))
        # Every slice begins and ends with a character that is context only, so no centre lies at an end.
        centre = np.flatnonzero((s != 0) & ~np.concatenate(edges))
        k = len(letters)
        keys = (small[s[centre - 1]] * k + small[s[centre]]) * k + small[s[centre + 1]]
        seen, at = (np.unique(keys, return_inverse=True) if k > 200 else _by_counting(keys, k ** 3))
        of = of[centre]
        for start in range(0, len(seen), _BLOCK_TRIGRAMS):
            block = seen[start:start + _BLOCK_TRIGRAMS]
            own = (at >= start) & (at < start + len(block)) if len(seen) > _BLOCK_TRIGRAMS else slice(None)
            counts = np.bincount(of[own] * len(block) + at[own] - start, minlength=n_groups * len(block)).reshape(n_groups, len(block))
            vectors = trigram_vectors(letters[block // (k * k)], letters[block // k % k], letters[block % k], dimensions, seed)
            out[:] += counts.astype(np.float32) @ vectors  # whole numbers below 2**24: exact in any order
        codes, owners, held = [], [], 0
        edges.clear()

    edges: list[np.ndarray] = []
    for text, g in zip(texts, groups):
        for p in range(0, len(text), _SLICE_CHARS):
            some = text[max(0, p - 1):p + _SLICE_CHARS + 1]
            s = _lowered()[np.frombuffer(some.encode("utf-32-le"), np.uint32)]
            before, after = p > 0, p + _SLICE_CHARS < len(text)
            s = np.concatenate([s[:0] if before else np.zeros(1, np.uint32), s, s[:0] if after else np.zeros(1, np.uint32)])
            edge = np.zeros(len(s), bool)
            edge[0] = edge[-1] = True
            codes.append(s)
            edges.append(edge)
            owners.append((g, len(s)))
            held += len(s)
            if held >= _SLICE_CHARS:
                flush()
    flush()
    return out


def _by_counting(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys below n in order, and each key's place among them."""
    there = np.bincount(keys, minlength=n) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, at most 256 and some slices of text at once."""
    sizes, start, held = batch.column("text").to_pylist(), 0, 0
    for i, text in enumerate(sizes):
        held += len(text or "")
        if i + 1 - start >= 256 or held >= _SLICE_CHARS or i + 1 == len(sizes):
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0


def language_bundles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Rows of lang and vector (array<double>): the sum of all its documents' vectors. NULL texts and NULL languages are left out."""

    def add_up(batches):
        sums: dict[str, np.ndarray] = {}
        salt = TaskContext.get().partitionId() % _SALTS

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"lang": k, "salt": salt, "vector": v.tolist()} for k, v in sums.items()], schema=pa.schema(
                [("lang", pa.string()), ("salt", pa.int32()), ("vector", pa.list_(pa.float64()))]))

        for batch in batches:
            for some in _slices(batch):
                langs = some.column("lang").to_pylist()
                names = sorted(set(langs))
                at = {x: i for i, x in enumerate(names)}
                made = bundles(some.column("text").to_pylist(), np.array([at[x] for x in langs]), len(names), dimensions, seed)
                for name, v in zip(names, made):
                    sums[name] = sums[name] + v if name in sums else v
                if len(sums) >= 500:
                    yield rows()
                    sums.clear()
        if sums:
            yield rows()

    given = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    with arrow_rows(docs.sparkSession, 2000):
        parts = given.mapInArrow(add_up, "lang string, salt int, vector array<double>")
        summed = parts.groupBy("lang", "salt").agg(Summarizer.sum(array_to_vector(F.col("vector"))).alias("v"))
        return summed.groupBy("lang").agg(Summarizer.sum(F.col("v")).alias("v")).select("lang", vector_to_array("v").alias("vector")).where(
            F.exists("vector", lambda x: x != 0))


def predict(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS,
            seed: int = SEED) -> DataFrame:
    """Rows of doc_id, lang_pred and score for every document, languages learned from those where ``learned`` holds.

    The score is the cosine with the predicted language (below 0: 0), rounded to nine places; of equal ones the language first in
    order of its name counts. ``und`` with score 0 stands for a NULL text, one without a letter, and any text while no labelled text
    has a letter. Whole texts are read, in slices; repeated rows and ids are judged one by one; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    vectors = language_bundles(docs.where(learned), text_col, lang_col, dimensions, seed).persist()
    n = vectors.count()
    passes = -(-n // PASS_LANGUAGES)
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = T.StructType([out.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    fresh = True
    for i in range(passes):
        rows = sorted((r["lang"], r["vector"]) for r in vectors.where(F.pmod(F.xxhash64("lang"), F.lit(passes)) == i).collect())
        if not rows:
            continue
        names, own = [r[0] for r in rows], np.array([r[1] for r in rows])
        shared = spark.sparkContext.broadcast((names, (own / np.linalg.norm(own, axis=1, keepdims=True)), fresh))
        fresh = False

        def judge(batches, shared=shared):
            names, own, fresh = shared.value
            for batch in batches:
                for some in _slices(batch):
                    texts = [t or "" for t in some.column("text").to_pylist()]
                    made = bundles(texts, np.arange(len(texts)), len(texts), dimensions, seed)
                    length = np.linalg.norm(made, axis=1)
                    cosine = np.clip(np.round((made / np.where(length > 0, length, 1)[:, None]) @ own.T, 9), 0, 1)
                    best = cosine.argmax(axis=1)
                    score = cosine[np.arange(len(texts)), best]
                    pred, was = [names[b] if n > 0 else UNKNOWN for b, n in zip(best, length)], some.column("lang_pred").to_pylist()
                    old = some.column("score").to_numpy()
                    if not fresh:
                        keep = (old > score) | ((old == score) & np.array([w <= p for w, p in zip(was, pred)])) | (length == 0)
                        pred, score = [w if k else p for w, p, k in zip(was, pred, keep)], np.where(keep, old, score)
                    score = np.where(length > 0, score, 0.0)
                    yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text"), pa.array(pred, pa.string()), pa.array(score)], schema=batch.schema)

        with arrow_rows(spark, 2000):
            out = out.mapInArrow(judge, schema)
    vectors.unpersist()
    return out.select("doc_id", "lang_pred", "score")
