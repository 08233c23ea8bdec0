import hashlib
import random
import re

import numpy as np
import pytest

from goldleaf.llm import chunks, substring_dedup
from goldleaf.llm.queries import op2_automaton_dedup


def brute(rows, window):
    """Rows of distinct (id, words) in corpus order; equal rows get the result of the first."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    sha = lambda ws: hashlib.sha256(" ".join(ws).encode()).digest()
    order = sorted({(d is not None, d or 0, int.from_bytes(sha(ws)[:8], "big", signed=True), tuple(ws)) for d, ws in split})
    first, result = {}, {}
    for has, d, _, ws in order:
        gone = set()
        for i in range(len(ws) - window + 1):
            w = ws[i:i + window]
            if w in first:
                gone.update(range(i, i + window))
            else:
                first[w] = True
        kept = [w for i, w in enumerate(ws) if i not in gone]
        result[(d if has else None, ws)] = (len(ws), len(gone), sha(kept).hex())
    return sorted(((d, *result[(d, tuple(ws))]) for d, ws in split), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def planted(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    shared = [[rng.choice(vocab) for _ in range(rng.choice([19, 20, 25, 70]))] for _ in range(6)]
    rows = []
    for i in range(70):
        ws = []
        for _ in range(rng.choice([0, 1, 2, 4])):
            ws += [rng.choice(vocab) for _ in range(rng.randrange(30))]
            ws += rng.choice(shared)
        rows.append((rng.randrange(500), rng.choice([" ", "\n", "  "]).join(ws)))
    rows += [(600, None), (601, ""), (602, " ".join(["a"] * 90)), (603, " ".join(["a"] * 41)), (604, " ".join(["a", "b"] * 40)),
             (None, rows[5][1]), (605, rows[5][1]), rows[7], rows[7], (606, rows[7][1]), (607, " ".join(shared[3] * 3))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,most", [(1, 1000), (2, 1000), (3, 1), (4, 0)])
def test_against_brute_force(spark, seed, most):
    rows = planted(seed)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start long")
    got = substring_dedup.remove_repeats(df, chunk_words=300, shard_segments=20, anchor_segments=most)
    assert result(got) == brute(rows, 20)


def test_string_ids_spans_and_empty_table(spark):
    words = [f"x{i}" for i in range(30)]
    df = spark.createDataFrame([("b", " ".join(words + ["new"])), ("a", " ".join(words))], "doc_id string, text string")
    got = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {"a": (0, None), "b": (30, [[30, 31]])}
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_automaton_matches_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        added = [[rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(4)]
        a = substring_dedup.SuffixAutomaton()
        for s in added:
            a.add(s)
        text = [rng.randrange(4) for _ in range(25)]
        inside = lambda x: any(s[i:i + len(x)] == x for s in added for i in range(len(s) - len(x) + 1))
        want = [max(n for n in range(e + 2) if n == 0 or inside(text[e + 1 - n:e + 1])) for e in range(25)]
        assert a.matches(text) == want


def test_query_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op2_automaton_dedup(spark, path)) == brute(rows, 20)


def test_runs_of_a_whole_chunk():
    """Runs found over all texts at once against each text's windows one by one; texts shorter than a window have none."""
    rng = np.random.default_rng(3)
    lens = np.array([0, 5, 30, 19, 20, 21, 200, 0, 64, 3])
    h = chunks.mix(rng.integers(0, 9, lens.sum()).astype(np.uint64))  # few words, so anchors tie
    starts, ns, own, bounds = substring_dedup._runs(h, lens, 20, 8)
    keys = chunks.window_keys(h, 8)
    want, first = [], []
    for begin, n in zip(np.cumsum(lens) - lens, lens):
        first.append(len(want))
        before = None
        for i in range(begin, begin + n - 19):
            at = i + int(np.argmin(keys[i:i + 13]))
            if at == before:
                want[-1][1] += 1
            else:
                want.append([i, 1, int(chunks.mix(keys[at:at + 1])[0])])
            before = at
    assert [list(map(int, r)) for r in zip(starts, ns, own)] == want
    assert bounds.tolist() == [*first, len(want)]
    assert substring_dedup._runs(h[:5], np.array([0, 5]), 20, 8)[3].tolist() == [0, 0, 0]


def test_a_default_chunk_takes_little_memory():
    """The anchors of a chunk: 61 MB before."""
    import inspect
    import tracemalloc

    n = inspect.signature(substring_dedup.remove_repeats).parameters["chunk_words"].default
    h = np.random.default_rng(5).integers(0, 2**64, n, np.uint64)
    lens = np.full(n // 250, 250)
    tracemalloc.start()
    try:
        substring_dedup._runs(h, lens, 20, 8)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 50, peak
