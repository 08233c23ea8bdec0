import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from goldleaf.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, part string, n long, ids string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 9, "y", 1) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least, longest, top, percent):
    out = []
    langs = {}
    for text, lang in rows:
        langs.setdefault(lang if lang is not None else "und", []).append(text or "")
    for lang, texts in langs.items():
        f, n = Counter(), 0
        for t in texts:
            t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", t):
                w = re.findall("[^ \t]+", piece)
                n += len(w)
                for m in range(1, longest + 1):
                    f.update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items())
            if not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(seed):
    rng = random.Random(seed)
    words = ["a", "B", "b", "cc", "ç", "d'", "\x00", "日本", "e f"]
    rows = [(rng.choice(["", " ", ". "]).join(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", "\n", "! "]) for _ in range(rng.randrange(40))), rng.choice(["en", "fr", None, "und"])) for _ in range(60)]
    return rows + [(None, "en"), ("", "en"), (". , ;", "fr"), ("a b cc a b cc a b cc", "en")] * 2


def test_equals_brute_force_however_it_is_parted(spark):
    rows = made(1)
    for budget, chunk in ((4, 30), (40, 500), (10 ** 6, 10 ** 6)):
        got = co.collocations(frame(spark, rows).repartition(5), least=3, top=25, budget=budget, chunk_words=chunk)
        assert rows_of(got) == brute(rows, 3, 5, 25, 100)


def test_absorbing_share_and_lengths(spark):
    rows = made(2)
    for percent, longest in ((60, 4), (100, 2)):
        assert rows_of(co.collocations(frame(spark, rows), least=4, longest=longest, absorbed_percent=percent)) == brute(rows, 4, longest, 2000, percent)


def test_one_hot_prefix_in_one_very_long_text(spark):
    rows = [("the the " * 30_000 + "end", "en"), ("the end. " * 50, "en")]
    got = rows_of(co.collocations(frame(spark, rows), least=50, budget=3, chunk_words=1000))
    assert got == brute(rows, 50, 5, 2000, 100)


def test_ties_go_by_bytes_and_the_list_ends(spark):
    rows = [(" . ".join(f"{a} {b}" for a, b in (("x", "é"), ("x2", "z"), ("x3", "日"), ("x4", "y"))), "en")] * 3
    got = co.collocations(frame(spark, rows), least=3, top=2)
    assert [(r[1], r[2]) for r in rows_of(got)] == [(1, "x é"), (2, "x2 z")]


def test_no_rows_without_candidates(spark):
    for rows in ([], [(None, None)], [("a b c", "en")]):
        assert co.collocations(frame(spark, rows), least=2).count() == 0


def test_products_beyond_64_bits(spark):
    big = 4 * 10 ** 12
    batch = spark.createDataFrame([("en", [1, 2], big, 10 * big, [(1, big, big)])], "part string, ids array<long>, a long, n long, cuts array<struct<k int, l long, r long>>")
    assert batch.mapInArrow(co._score, co._SCORED).first()["score"] == 1000 * big * 10 * big // (big * big)


def test_vertical_partition_parts_only_what_exceeds_the_budget(spark):
    leaves = [np.array(c, np.int64) for c in ([1, 1, 1, 1, 2, 3], [1, 1, 2, 3, 0, 4])]
    row = {c: bytearray(co.pack(v)) for c, v in zip(("w1", "w2"), leaves)}
    df = spark.createDataFrame([row], "w1 binary, w2 binary")
    plan = co.vertical_partition(df, 2, 3, 6)
    assert [len(h) for h, _ in plan] == [1, 0]
    of, levels = co._groups(leaves, plan)
    assert Counter(of.tolist()).most_common(1)[0][1] <= 3 and len(set(of[:2])) == 1 and levels.tolist() == [2, 2, 2, 2, 1, 1]


def test_whole_table_columns_and_ranks(spark):
    from goldleaf.llm.queries import QUERIES

    got = QUERIES["op11_suffix_collocations"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.groupBy("lang").agg((F.max("rank") - F.count("*")).alias("x")).where("x != 0").count() == 0
