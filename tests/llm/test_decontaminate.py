import random
import re
from collections import Counter

from pyspark.sql import functions as F

from goldleaf.llm import decontaminate


def norm(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t.translate({ord(c): None for c in decontaminate.PUNCTUATION}))


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items, percent):
    out = []
    for d, t in docs:
        w, spans = norm(t), set()
        for i, it in items:
            v = norm(it)
            if i is None or not v:
                continue
            k = min(5, len(v))
            a, ca = grams(w, k), Counter(grams(v, k))
            where = {}
            for j, g in enumerate(grams(v, k)):
                where.setdefault(g, []).append(j)
            for s in {max(0, min(p - j, len(w) - len(v))) for p, g in enumerate(a) for j in where.get(g, ())}:
                cw = Counter(grams(w[s:s + len(v)], k))
                if 100 * sum((ca & cw).values()) >= percent * sum((ca | cw).values()):
                    spans.add((i, s, min(s + len(v), len(w))))
        out.append((d, bool(spans), ",".join(sorted({x[0] for x in spans})), ",".join(":".join(map(str, x)) for x in sorted(spans))))
    return sorted(out, key=str)


def test_against_every_aligned_window(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(300)]
    items = [(f"i{n}", " ".join(rng.choice(vocab) for _ in range(n))) for n in (1, 3, 4, 5, 6, 20, 20, 35, 60)]
    items += [("rep", "a b a b a b a b a b a b a b"), ("none", ""), ("null", None), (None, "w x y z a b"), items[6], ("mark", "Ça VA, bien. Oui? non! si")]
    docs = [(100, None), (101, ""), (102, "v1"), (103, "a b a b a b a b a b a b a b a b a b"), (104, "ça va bien oui non si et puis"), (None, items[7][1])]
    for n in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 10, 200]))]
        _, t = rng.choice(items[4:9])
        t = t.split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            at = rng.randrange(len(t))
            rng.choice([lambda: t.__setitem__(at, "edit"), lambda: t.insert(at, "new"), lambda: t.pop(at) if len(t) > 1 else None])()
        at = rng.randrange(len(w) + 1)
        docs.append((n, " ".join(w[:at] + t + w[at:]).upper() + ("." if n % 2 else "")))
    docs += docs[8:10]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items, "item_id string, text string")
    got = sorted(((r.doc_id, r.contaminated, r.item_ids, r.spans) for r in decontaminate.find_leaks(df, it).collect()), key=str)
    want = brute(docs, items, 80)
    assert got == want
    assert 30 < sum(r[1] for r in want) < len(want)
    assert decontaminate.find_leaks(df.limit(0), it).count() == 0
    assert {r.contaminated for r in decontaminate.find_leaks(df, it.limit(0)).collect()} == {False}


def test_index_finds_every_fingerprint_within_the_radius():
    rng = random.Random(4)
    near = lambda x, y: any(bin((x ^ y) >> (8 * b) & 255).count("1") <= decontaminate.RADIUS // decontaminate.BLOCKS for b in range(8))
    for _ in range(3000):
        x, y = rng.getrandbits(64), 0
        for b in rng.sample(range(64), rng.randrange(decontaminate.RADIUS + 1)):
            y |= 1 << b
        assert near(x, x ^ y)


def test_simhash_bits(spark):
    h = [[1, 3, -1], [2 ** 62, -(2 ** 63), 5, 5]]
    got = [r.f for r in spark.createDataFrame([(x,) for x in h], "h array<long>").select(decontaminate.simhash(F.col("h")).alias("f")).collect()]
    for x, f in zip(h, got):
        want = sum(1 << b for b in range(64) if 2 * sum((v >> b) & 1 for v in x) > len(x))
        assert f % 2 ** 64 == want


def test_recall_against_all_windows_of_the_documents(spark):
    """Brute force here slides over every start, not only those that put a shared shingle at the same place."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(400)]
    items = [(f"i{n}", [rng.choice(vocab) for _ in range(rng.choice([20, 30, 45]))]) for n in range(12)]
    docs = []
    for n in range(300):
        w = [rng.choice(vocab) for _ in range(120)]
        t = list(rng.choice(items)[1])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(t))
            rng.choice([lambda: t.__setitem__(at, "edit"), lambda: t.insert(at, "new"), lambda: t.pop(at)])()
        at = rng.randrange(121)
        docs.append((n, " ".join(w[:at] + t + w[at:])))
    truth = set()
    for d, t in docs:
        w = t.split()
        for i, v in items:
            ci = Counter(grams(v, 5))
            for s in range(len(w) - len(v) + 1):
                cw = Counter(grams(w[s:s + len(v)], 5))
                if 100 * sum((ci & cw).values()) >= 80 * sum((ci | cw).values()):
                    truth.add((d, i))
                    break
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(v)) for i, v in items], "item_id string, text string")
    got = {(r.doc_id, i) for r in decontaminate.find_leaks(df, it).collect() for i in r.item_ids.split(",") if i}
    assert got <= truth and len(truth) > 60
    assert len(got) >= 0.97 * len(truth)


def test_long_text_and_a_passage_in_a_third_of_all_rows(spark):
    rng = random.Random(9)
    item = " ".join(f"q{i}" for i in range(30))
    long = " ".join(rng.choice(["a", "b", "c"]) + str(rng.randrange(5000)) for _ in range(200_000))
    rows = [(0, long + " " + item + " " + long)] + [(n, f"own{n} words {item if n % 3 == 0 else ''} end") for n in range(1, 301)]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"),
                                   spark.createDataFrame([("x", item), ("y", long[:3000])], "item_id string, text string")).collect()
    assert {r.doc_id for r in got if "x" in r.item_ids.split(",")} == {n for n in range(301) if n % 3 == 0}
    assert [r.spans for r in got if r.doc_id == 0] == [f"x:200000:200030,y:0:{n},y:200030:{200030 + n}" for n in [len(long[:3000].split())]] and len(got) == 301


def test_an_index_beyond_the_broadcast_bound_gives_the_same_rows(spark, monkeypatch):
    item = " ".join(f"q{i}" for i in range(25))
    df = spark.createDataFrame([(n, f"z{n} {item} y{n}" if n % 2 else f"z{n}") for n in range(20)], "doc_id long, text string")
    it = spark.createDataFrame([("a", item), ("b", item), ("b", item + " more words of it")], "item_id string, text string")
    find = lambda: sorted(map(tuple, decontaminate.find_leaks(df, it).collect()))
    want = find()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 3)
    assert find() == want and sum(r[1] for r in want) == 10
