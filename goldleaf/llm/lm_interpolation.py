"""Language-model scoring by deleted interpolation.

p(w | h) mixes the maximum-likelihood estimates of all n-gram orders and a uniform share for unknown words.
The weights depend on how often the longest seen context occurred (buckets by powers of two) and are learned
by expectation-maximisation on the counts of held-out training documents, under estimates from the others;
the model that scores then counts all training documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm import chunks as C
from goldleaf.session import scratch_path

#: Context frequencies of 2**15 and more share a bucket.
TOP_BUCKET = 15
COUNTED, TUNING, OTHER = 0, 1, 2
#: Words per chunk: the n-grams of a chunk and their counts take some 40 MB in a Python worker.
CHUNK_WORDS = 375_000
#: Keys that a shard of n-grams sums, on average, in some 30 MB.
SHARD_KEYS = 1_000_000
#: Tokens whose estimates are computed at once.
BLOCK = 1 << 18
#: Bytes of chunks that a worker is given at once while n-grams are counted, else those of a whole input split.
BATCH_BYTES = 4 << 20
_BEGIN = np.uint64(0x5851F42D4C957F2D)


def _starts(row) -> np.ndarray:
    """Place of each document's first token."""
    return np.cumsum(np.concatenate([[0], row.lens[:-1]])).astype(np.int64)


def _grams(row, order: int):
    """For each n-gram order in turn: type number per token, key per type; token 0 of the vocabulary ends a document."""
    tokens, hashes, starts = C.unpack(row.tokens, np.uint32), C.unpack(row.hashes, np.uint64), _starts(row)
    number, keys = tokens, C.mix(hashes)
    yield number, keys
    for n in range(2, order + 1):
        code = np.empty(len(tokens), np.int64)  # first of the context, the (n-1)-gram that ends at the previous token
        code[1:] = number[:-1]
        code[starts] = len(keys)  # at a document's start: only beginnings
        code *= len(hashes)
        code += tokens
        code, number = np.unique(code, return_inverse=True)
        number = number.astype(np.uint32)
        ctx = np.concatenate([keys, [_BEGIN + np.uint64(n)]])[code // len(hashes)]
        keys = C.chain(ctx, hashes[code % len(hashes)])
        del code, ctx
        yield number, keys


def _asked(n: int, shards: int):
    def ask(frames):
        for pdf in frames:
            for row in pdf.itertuples():
                for number, keys in _grams(row, n):
                    pass
                by = np.argsort(keys)
                counts = None if row.role == OTHER else np.bincount(number, minlength=len(keys))[by]
                yield pd.DataFrame(C.questions(row.chunk, n, row.role, keys[by], counts, shards),
                                   columns=["chunk", "shard", "kind", "role", "keys", "counts"])
    return ask


def _counts(row, answers: pd.DataFrame, order: int, which: int, n_docs: int):
    """Per token: gram and context count of each order under one total."""
    starts, gram, context = _starts(row), [], []
    for n, (number, keys) in enumerate(_grams(row, order), 1):
        count = np.empty(len(keys), np.uint32)
        count[np.argsort(keys)] = C.told(answers, n, which)
        if n > 1:
            ctx = np.empty(len(number), np.uint32)
            ctx[1:] = gram[-1][:-1]
            ctx[starts] = n_docs
            context.append(ctx)
        gram.append(count[number])
    return gram, context


def _blocks(gram: list[np.ndarray], context: list[np.ndarray]):
    """The counts of some tokens at a time: their place, gram and context counts."""
    for a in range(0, len(gram[0]), BLOCK):
        here = slice(a, a + BLOCK)
        yield here, [c[here].astype(np.int64) for c in gram], [c[here].astype(np.int64) for c in context]


def _bucket(context: list[np.ndarray], n: int) -> np.ndarray:
    """Number of the longest seen context's order and frequency class; 0 if none was seen."""
    b = np.zeros(n, np.int64)
    for order, c in enumerate(context, 2):
        seen = c > 0
        b[seen] = (order - 1) * (TOP_BUCKET + 1) + np.minimum(np.log2(c[seen]).astype(np.int64), TOP_BUCKET)
    return b


def fit_weights(rows: DataFrame, order: int, total: int, distinct: int, rounds: int = 12, tol: float = 1e-4) -> dict[int, list[float]]:
    """EM over held-out counts: rows of bucket, gram counts c1.., context counts x2.., and times seen k.

    Each round is one aggregation over the rows; only sums per bucket (at most 16 per order) reach the driver.
    A bucket's weights start even over its orders and carry one token's worth of that start as a prior.
    """
    parts = [F.lit(1.0 / (distinct + 1)), F.col("c1") / F.lit(float(max(total, 1)))]
    parts += [F.when(F.col(f"x{n}") > 0, F.col(f"c{n}") / F.col(f"x{n}")).otherwise(0.0) for n in range(2, order + 1)]
    found = [r["b"] for r in rows.select("b").distinct().collect()]
    even = {b: [1.0 / (2 + b // (TOP_BUCKET + 1))] * (2 + b // (TOP_BUCKET + 1)) for b in found}
    weights = {b: w + [0.0] * (order + 1 - len(w)) for b, w in even.items()}
    spark = rows.sparkSession
    before = None
    for _ in range(rounds if found else 0):
        table = spark.createDataFrame([(b, *w) for b, w in weights.items()],
                                      "b long, " + ", ".join(f"w{i} double" for i in range(order + 1)))
        shares = [F.col(f"w{i}") * p for i, p in enumerate(parts)]
        whole = sum(shares[1:], shares[0])
        mixed = rows.join(F.broadcast(table), "b").select("b", "k", whole.alias("p"), *[s.alias(f"s{i}") for i, s in enumerate(shares)])
        got = mixed.groupBy("b").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log("p")).alias("ll"),
                                     *[F.sum(F.col("k") * F.col(f"s{i}") / F.col("p")).alias(f"e{i}") for i in range(order + 1)]).collect()
        for r in got:
            prior = even[r["b"]] + [0.0] * (order + 1)
            weights[r["b"]] = [(r[f"e{i}"] + prior[i]) / (r["k"] + 1.0) for i in range(order + 1)]
        ll = sum(r["ll"] for r in got)
        if before is not None and abs(ll - before) <= tol * abs(before):
            break
        before = ll
    return weights


@C.removes_shuffles
def score(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
          chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Score every row's whole text under a model of the rows where ``trains`` is true (NULL: false).

    Tokens are the words with A-Z lower-cased, then one end. Returns one row per input row: ``doc_id, trained,
    n_tokens, n_known`` (tokens seen in training), ``train_tokens, train_types, base_score`` (add-half unigram)
    and ``score``, both log10 probabilities of the text. A tenth of the training rows, by hash of id, are the held-out
    counts that set the weights; every training row counts in the final model.

    NULL and empty texts are the end token alone. Repeated rows count and are scored one by one; NULL ids are
    ids like any other. Without training rows every text has probability 1 (the uniform share over no types);
    without held-out ones the weights stay even. An empty table gives no rows. Other columns are ignored. A document is never cut:
    one of more than ``chunk_words`` words makes a larger chunk, held whole by one task.

    Counts of n-grams are summed by key range, one order after the other, so a frequent n-gram is one entry per chunk, and no task or driver
    holds a table that grows with the corpus.
    """
    spark = docs.sparkSession
    trained = F.coalesce(trains, F.lit(False))
    tuning = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("held-out")), F.lit(10)) == 0
    role = F.when(~trained, OTHER).when(tuning, TUNING).otherwise(COUNTED)
    chunks = C.write_chunks(docs, id_col, text_col, "lm-chunks", lower=True, end_token=True, role=role, chunk_words=chunk_words)
    shards = C.shard_count(chunks, C.SHARD_KEYS / SHARD_KEYS)
    answers = None
    for n in range(1, order + 1):  # each order's questions are gone before the next are asked
        asked = chunks.select("chunk", "role", "lens", "tokens", "hashes").mapInPandas(_asked(n, shards), C.ASK)
        with C.arrow_bytes(spark, BATCH_BYTES):
            told = C.answer(asked, ((COUNTED, TUNING), (COUNTED,)), scratch_path(spark, f"lm-counts-{n}"), told_to=(None, (TUNING,)))
        answers = told if answers is None else answers.unionByName(told)
    sums = answers.where("chunk = -1 and kind = 1").agg(*[F.coalesce(F.sum(F.get("sums", F.lit(i))), F.lit(0)).alias(f"s{i}") for i in range(4)]).first()
    docs_in = {r["role"]: r["n"] for r in chunks.groupBy("role").agg(F.sum(F.size("ids")).alias("n")).collect()}
    n_all, v_all, n_part, v_part = sums
    docs_part, docs_all = docs_in.get(COUNTED, 0), docs_in.get(COUNTED, 0) + docs_in.get(TUNING, 0)
    replies = answers.where("chunk >= 0")
    names = ["b", "k", *[f"c{n}" for n in range(1, order + 1)], *[f"x{n}" for n in range(2, order + 1)]]

    def held_out(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        made = []
        for row in left.itertuples():
            for _, gram, context in _blocks(*_counts(row, right, order, 1, docs_part)):
                keys, k = np.unique(np.stack([_bucket(context, len(gram[0])), *gram, *context]), axis=1, return_counts=True)
                made.append(pd.DataFrame(np.concatenate([keys[:1], k[None], keys[1:]]).T, columns=names))
        return pd.concat(made) if made else pd.DataFrame(columns=names)

    needed = ["chunk", "ids", "lens", "tokens", "hashes"]
    of_tuning = chunks.where(F.col("role") == TUNING)
    tuning_replies = replies.join(of_tuning.select("chunk"), "chunk", "left_semi")
    em = (of_tuning.select(*needed).groupBy("chunk").cogroup(tuning_replies.groupBy("chunk"))
          .applyInPandas(held_out, ", ".join(f"{c} long" for c in names)))
    em = em.groupBy(*[c for c in names if c != "k"]).agg(F.sum("k").alias("k"))
    em_path = scratch_path(spark, "lm-held-out")
    em.write.parquet(em_path)
    weights = fit_weights(spark.read.parquet(em_path), order, n_part, v_part)

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((order * (TOP_BUCKET + 1), order + 1))
        for b in range(len(table)):
            known = 2 + b // (TOP_BUCKET + 1)
            nearest = min((x for x in weights if x // (TOP_BUCKET + 1) == known - 2), key=lambda x: (abs(x - b), x), default=None)
            table[b, :known] = weights[nearest][:known] if nearest is not None else 1.0 / known
        out = []
        for row in left.itertuples():
            n = sum(row.lens)
            known, base, log_p = np.empty(n, bool), np.empty(n), np.empty(n)
            for here, gram, context in _blocks(*_counts(row, right, order, 0, docs_all)):
                c, bucket = gram[0].astype(np.float64), _bucket(context, len(gram[0]))
                p = table[bucket, 0] / (v_all + 1.0) + table[bucket, 1] * (c / n_all if n_all else 1.0)
                for i, (g, x) in enumerate(zip(gram[1:], context), 2):
                    p += table[bucket, i] * np.divide(g, x, out=np.zeros(len(c)), where=x > 0)
                known[here], base[here], log_p[here] = c > 0, np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1))), np.log10(p)
            at = _starts(row)
            out.append(pd.DataFrame({"doc_id": row.ids, "trained": row.role != OTHER, "n_tokens": np.asarray(row.lens, np.int64),
                                     "n_known": np.add.reduceat(known.astype(np.int64), at), "train_tokens": n_all, "train_types": v_all,
                                     "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(log_p, at)}))
        return pd.concat(out) if out else pd.DataFrame()

    id_type = docs.schema[id_col].dataType.simpleString()
    result = (chunks.select(*needed, "role").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(
        scored, "doc_id string, trained boolean, n_tokens long, n_known long, train_tokens long, train_types long, "
                "base_score double, score double"))
    return result.withColumn("doc_id", F.col("doc_id").cast(id_type))
