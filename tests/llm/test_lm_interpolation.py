import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from goldleaf.llm import chunks, lm_interpolation
from goldleaf.llm.queries import op1_interpolated_lm
from goldleaf.session import scratch_path

TEXTS = [(1, "the cat sat on the mat"), (2, "The cat sat"), (3, None), (4, ""), (5, "the the the THE dog"), (6, "a dog sat on the mat"),
         (7, "the cat\tsat\non the mat"), (8, "zebra"), (None, "the cat sat on a mat"), (1, "the cat sat on the mat"), (9, "x " * 3000)]


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]


@pytest.mark.parametrize("order", [2, 3])
def test_counts_base_and_proper_distribution(spark, order):
    df = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, score string")
    got = lm_interpolation.score(df, F.col("doc_id") % 4 != 3, order=order, chunk_words=10).collect()
    assert len(got) == len(TEXTS)
    train = Counter(w for i, t in TEXTS if i is not None and i % 4 != 3 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in TEXTS:
        ws = tokens(t)
        base = sum(math.log10((train[w] + .5) / (n + .5 * (v + 1))) for w in ws)
        want[(i, len(ws), sum(w in train for w in ws), round(base, 6))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and {r.train_types for r in got} == {v}
    assert all(r.score <= 0 for r in got)


def test_different_texts_share_less_than_one(spark):
    """All texts of up to two words over the vocabulary: their probabilities are positive and sum to less than one."""
    vocab = ["a", "b", "c"]
    train = [(i, " ".join(vocab[(i * j) % 3] for j in range(1, 9))) for i in range(100, 160)]
    test = [(1, "")] + [(1, w) for w in vocab] + [(1, f"{w} {w2}") for w in vocab for w2 in vocab]
    df = spark.createDataFrame(train + test, "doc_id long, text string")
    rows = lm_interpolation.score(df, F.col("doc_id") >= 100).where("doc_id = 1").collect()
    assert len(rows) == len(test)
    assert all(r.score < 0 for r in rows) and sum(10 ** r.score for r in rows) < 1


def test_em_matches_brute_force(spark):
    """Weights of a two-bucket table against a plain EM loop."""
    rows = [(0, 5, 3, 0, 0), (0, 2, 0, 0, 0), (17, 4, 2, 1, 2), (17, 3, 1, 0, 2), (17, 1, 4, 2, 3)]
    df = spark.createDataFrame(rows, "b long, k long, c1 long, c2 long, x2 long")
    got = lm_interpolation.fit_weights(df, 2, total=10, distinct=4, rounds=5, tol=0.0)
    want = {0: [.5, .5, 0.], 17: [1 / 3] * 3}
    start = {k: list(v) for k, v in want.items()}
    for _ in range(5):
        new = {}
        for b in want:
            e, n = [0.] * 3, 0
            for rb, k, c1, c2, x2 in rows:
                if rb == b:
                    s = [want[b][0] / 5, want[b][1] * c1 / 10, want[b][2] * (c2 / x2 if x2 else 0)]
                    e = [x + k * y / sum(s) for x, y in zip(e, s)]
                    n += k
            new[b] = [(x + y) / (n + 1) for x, y in zip(e, start[b])]
        want = new
    assert {b: [round(x, 9) for x in w] for b, w in got.items()} == {b: [round(x, 9) for x in w] for b, w in want.items()}
    assert all(abs(sum(w) - 1) < 1e-9 for w in got.values())


def test_empty_table_and_no_training(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_interpolation.score(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lm_interpolation.score(one, F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, abs(r.score) < 1e-12) == (3, 0, 0, 0.0, True)


def test_query_beats_the_base_on_held_out_texts(spark):
    got = op1_interpolated_lm(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_query_uses_contexts_of_two_words(spark, workdir):
    """Pairs of words alike in every text: only the two words before tell which one follows."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    train = [(i, ("a b c", "d b e")[n % 2]) for n, i in enumerate(i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1)]
    rows = train + [(held[0], "a b c"), (held[1], "a b e")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{workdir}/documents.parquet")
    got = {r.doc_id: r.score for r in op1_interpolated_lm(spark, workdir).collect()}
    assert got[held[0]] > got[held[1]] + 0.3


def test_packing_round_trip():
    import numpy as np

    for a in (np.array([], np.uint64), np.array([0, 2**63, 5], np.uint64), np.arange(1000, dtype=np.uint32)):
        assert (chunks.unpack(chunks.pack(a), a.dtype) == a).all()
    assert [w for p in chunks.word_lists(b"ab cd\tef  gh", 3) for w in p] == b"ab cd\tef  gh".split()


def test_orders_are_counted_one_after_the_other(spark, monkeypatch):
    """Every order has its own counts, and no shuffle of a query that has ended is left."""
    made = []
    monkeypatch.setattr(lm_interpolation, "scratch_path", lambda s, name: made.append(name) or scratch_path(s, name))
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    lm_interpolation.score(df, F.col("doc_id") % 4 != 3, order=3, chunk_words=10)
    assert [x for x in made if x.startswith("lm-counts")] == ["lm-counts-1", "lm-counts-2", "lm-counts-3"]
    assert tracker.shuffleStatuses().size() <= before


def test_blocks_of_a_chunk_score_alike(spark, monkeypatch):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(1)
    rows = lambda: sorted(((r.doc_id, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in
                           lm_interpolation.score(df, F.col("doc_id") % 4 != 3, order=3).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(lm_interpolation, "BLOCK", 7)
    gram = [lm_interpolation.np.arange(20, dtype="uint32")] * 3
    assert [len(g[0]) for _, g, _ in lm_interpolation._blocks(gram, gram[1:])] == [7, 7, 6]
    assert rows() == whole


def _merge_of(monkeypatch, totals, **kw):
    """The function that ``chunks.answer`` applies to each shard."""
    caught = []

    class Asked:
        def groupBy(self, *names):
            return self

        def applyInPandas(self, f, schema):
            caught.append(f)
            raise LookupError

    with pytest.raises(LookupError):
        chunks.answer(Asked(), totals, "nowhere", **kw)
    return caught[0]


def _shard(lists, roles, counts):
    import pandas as pd

    return pd.DataFrame([(i, 0, 1, r, chunks.pack(k), b"" if c is None else chunks.pack(c)) for i, (k, r, c) in enumerate(zip(lists, roles, counts))],
                        columns=["chunk", "shard", "kind", "role", "keys", "counts"])


@pytest.mark.parametrize("range_keys", [1, 7, 1 << 18])
def test_ranges_of_a_shard_sum_like_the_whole(monkeypatch, range_keys):
    import numpy as np

    monkeypatch.setattr(chunks, "RANGE_KEYS", range_keys, raising=False)
    rng = np.random.default_rng(1)
    pool = np.concatenate([rng.integers(0, 2**64, 40, np.uint64), np.array([0, 2**64 - 1, 2**63], np.uint64)])
    for given in ([np.sort(rng.choice(pool, n, replace=False)) for n in (43, 1, 17, 30, 0)], [pool[:1], pool[:1], pool[:1], pool[:0], pool[:1]]):
        roles, counts = [0, 1, 2, 0, 1], [rng.integers(1, 9, len(k)).astype(np.uint32) if i != 3 else None for i, k in enumerate(given)]
        want = [Counter(), Counter()]
        for k, r, c in zip(given, roles, counts):
            for key, n in zip(k.tolist(), [1] * len(k) if c is None else c.tolist()):
                want[0][key] += n * (r in (0, 1))
                want[1][key] += n * (r == 0)
        got = _merge_of(monkeypatch, ((0, 1), (0,)), told_to=(None, (1,)), cap=20)(_shard(given, roles, counts))
        assert got["chunk"].tolist() == [0, 1, 2, 3, 4, -1]
        for k, r, told in zip(given, roles, got["totals"]):
            assert chunks.unpack(told[0], np.uint32).tolist() == [min(20, want[0][x]) for x in k.tolist()]
            assert chunks.unpack(told[1], np.uint32).tolist() == ([min(20, want[1][x]) for x in k.tolist()] if r == 1 else [])
        assert got["sums"].iloc[-1] == [y for w in want for y in (sum(w.values()), sum(v > 0 for v in w.values()))]


def test_a_shard_is_summed_in_little_memory(monkeypatch):
    """No sorted copies, places and totals of a whole shard at once: about 75 bytes a key before."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(2)
    lists = [np.unique(rng.integers(0, 2**64, 100_000, np.uint64)) for _ in range(10)]
    shard = _shard(lists, [0] * 9 + [1], [np.ones(len(k), np.uint32) for k in lists])
    merge = _merge_of(monkeypatch, ((0, 1), (0,)), told_to=(None, (1,)))
    tracemalloc.start()
    try:
        merge(shard)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 45 * sum(map(len, lists))


def test_a_worker_is_given_few_chunks_at_once(spark, monkeypatch):
    """All chunks of an input split came as one batch before."""
    real, key = lm_interpolation._asked, "spark.sql.execution.arrow.maxBytesPerBatch"

    def asked(n, shards):
        ask = real(n, shards)

        def alone(frames):
            for f in frames:
                if len(f) > 1:
                    raise ValueError(f"{len(f)} chunks in a batch")
                yield from ask([f])
        return alone

    monkeypatch.setattr(lm_interpolation, "_asked", asked)
    monkeypatch.setattr(lm_interpolation, "BATCH_BYTES", 1, raising=False)
    before = spark.conf.get(key)
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").coalesce(1)
    assert lm_interpolation.score(df, F.col("doc_id") % 4 != 3, order=3, chunk_words=10).count() == len(TEXTS)
    assert spark.conf.get(key) == before


def test_a_default_chunk_and_shard_take_little_memory(monkeypatch):
    """The n-grams of a chunk with their counts, and the sums of a shard: 67 and 55 MB before."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n, words = lm_interpolation.CHUNK_WORDS, 60_000
    row = SimpleNamespace(lens=[250] * (n // 250), tokens=chunks.pack((words * rng.random(n) ** 3).astype(np.uint32)),
                          hashes=chunks.pack(rng.integers(0, 2**64, words, np.uint64)))
    told = pd.DataFrame([(1, 0, order, [chunks.pack(np.ones(len(keys), np.uint32))]) for order, (_, keys) in enumerate(lm_interpolation._grams(row, 3), 1)],
                        columns=["chunk", "shard", "kind", "totals"])
    lists = [np.unique(rng.integers(0, 2**64, getattr(lm_interpolation, "SHARD_KEYS", chunks.SHARD_KEYS) // 10, np.uint64)) for _ in range(10)]
    shard = _shard(lists, [0] * 9 + [1], [np.ones(len(k), np.uint32) for k in lists])
    merge = _merge_of(monkeypatch, ((0, 1), (0,)), told_to=(None, (1,)))
    peaks = []
    for f in (lambda: lm_interpolation._counts(row, told, 3, 0, 9), lambda: merge(shard)):
        tracemalloc.start()
        try:
            f()
            peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        finally:
            tracemalloc.stop()
    assert peaks[0] < 45 and peaks[1] < 40, peaks
