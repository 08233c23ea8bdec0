import random
import re

import pytest

from goldleaf.llm import chunks, jaccard_join
from goldleaf.llm.graph import components
from goldleaf.llm.queries import op5_adaptive_jaccard
from goldleaf.session import checkpoint_root, scratch_path


def shingles(text, k):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)) if len(ws) >= k else frozenset([tuple(ws)])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for hs in holders.values():
        for x in range(len(hs)):
            for y in range(x):
                if (hs[y], hs[x]) not in seen:
                    seen.add((hs[y], hs[x]))
                    a, b = sets[hs[y]], sets[hs[x]]
                    if 100 * len(a & b) >= percent * len(a | b):
                        i, j = sorted((root(hs[x]), root(hs[y])))
                        parent[j] = i
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 60), (2, 100)])
def test_against_all_pairs(spark, k, percent):
    rng = random.Random(k * percent)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 6, 30, 60, 90]))]
        for _ in range(rng.choice([1, 2, 12])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                t[rng.randrange(len(t))] = f"w{rng.randrange(400)}"
            if rng.random() < .4:
                t += ["the", "common", "line", "of", "all", "texts", "here"]
            rows.append((rng.randrange(1000), " ".join(t)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (None, rows[0][1]), (None, "lone words"),
             rows[3], rows[3]]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n long")
    assert result(jaccard_join.jaccard_components(df, k, percent, chunk_words=200)) == brute(rows, k, percent)


def test_large_group_of_near_copies_with_chains_and_strays(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows, now = [], list(base)
    for i in range(60):  # a drifting chain: ends far apart, neighbours linked
        now[i * 2] = f"c{i}"
        rows.append((i, " ".join(now)))
    for i in range(60):  # copies of the base with too many or few edits
        t = list(base)
        for _ in range(rng.choice([1, 2, 5, 8])):
            t[rng.randrange(120)] = f"d{i}x{rng.randrange(99)}"
        rows.append((100 + i, " ".join(t)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard_join.jaccard_components(df, 3, 90)) == brute(rows, 3, 90)


def test_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_query_against_all_pairs(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert result(op5_adaptive_jaccard(spark, path)) == brute(rows, 3, 90)


def test_finished_steps_leave_no_files(spark, monkeypatch):
    """Only frames that the result reads stay on disk: no chunks, no counts, and no shuffle of a query that has ended."""
    import pathlib

    root = pathlib.Path(checkpoint_root(spark)) / "goldleaf"
    made = []
    monkeypatch.setattr(jaccard_join, "scratch_path", lambda s, name: made.append(p := scratch_path(s, name)) or p)
    monkeypatch.setattr(chunks, "scratch_path", jaccard_join.scratch_path)
    rows = [(i, " ".join(f"w{(i // 3 * 50 + j) % 400}" for j in range(60))) for i in range(90)]
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    linked = jaccard_join.jaccard_components(df, k=3, percent=90)
    assert tracker.shuffleStatuses().size() <= before
    left = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in made if (root / p.rsplit("/", 1)[1]).exists()}
    assert left.isdisjoint({"join-chunks", "join-picked", "join-counts"})
    assert result(linked) == brute(rows, 3, 90)


def test_chunks_cut_to_their_classes(spark):
    """Chunks of which no, some, and all but one document are copies."""
    base = [" ".join(f"v{i}x{j}" for j in range(40)) for i in range(12)]
    texts = base + base[:6] * 2 + [base[3]] * 10 + [t + " more" for t in base]
    rows = list(enumerate(texts)) + [(100, None), (101, "one"), (102, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert result(jaccard_join.jaccard_components(df, k=3, percent=90, chunk_words=400)) == brute(rows, 3, 90)
