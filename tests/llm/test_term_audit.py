import re
from itertools import permutations

import numpy as np

from goldleaf.llm import term_audit as ta
from goldleaf.llm.chunks import unpack
from goldleaf.llm.dictionary import spelled
from goldleaf.session import scratch_path

DOCS = "doc_id long, text string, source string, failed int, part string"
LABELS = "doc_id long, quality int, toxic int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], DOCS)


def fails(doc_id, text, firsts):
    w = re.findall("[^\x20\x09-\x0D]+", text)
    out = set()
    if len(w) < 200:
        out.add("A")
    if 100 * len(set(w)) < 50 * len(w):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    if doc_id is not None and firsts.get(text) is not None and firsts[text] < doc_id:
        out.add("E")
    return out


def brute(docs, labels):
    firsts = {}
    for i, t, _ in docs:
        if i is not None:
            firsts[t or ""] = min(firsts.get(t or "", i), i)
    judged = [(p or "", fails(i, t or "", firsts), any(x[0] == i and x[1] == 1 for x in labels if i is not None),
               any(x[0] == i and x[2] == 1 for x in labels if i is not None)) for i, t, p in docs]
    out = []
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        rows, removed = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [j for j in own if f in j[1] and not before & j[1]]
                removed[f] += len(here)
                rows.append((part, order, step, sum(not (before | {f}) & j[1] for j in own), len(here), sum(f in j[1] and bool(before & j[1]) for j in own),
                             sum(j[1] == {f} for j in own), sum(j[2] for j in here), sum(j[3] for j in here), f))
        out += [(*r[:-1], removed[r[-1]]) for r in rows]
    return sorted(out)


TEXTS = ["", None, "few words", " ".join(f"w{i}" for i in range(250)), "same " * 300, " ".join(f"Word{i} LOUD" for i in range(150)),
         " ".join(f"é{i}" for i in range(220)) + " 100%", "x" * 300_000, " ".join(f"w{i % 180}" for i in range(70_000)) + " #", "A" * 3 + "é" * 147]


def test_equals_brute_force(spark):
    docs = [(i, TEXTS[i % len(TEXTS)], ["a", "b", None, ""][i % 4]) for i in range(40)]
    docs += [(3, TEXTS[3], "a"), (3, TEXTS[3], "b"), (None, TEXTS[3], "a"), (None, None, "c"), (99, "only here", "one")]
    labels = [(i, i % 3 % 2, (i // 2) % 2) for i in range(0, 40, 2)] + [(4, 1, None), (None, 1, 1), (6, None, 1), (6, 1, 0)]
    got = ta.audit(docs_of(spark, docs).repartition(4), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_empty_tables(spark):
    assert ta.audit(docs_of(spark, []), spark.createDataFrame([], LABELS)).count() == 0
    got = ta.audit(docs_of(spark, [(1, None, None)]), spark.createDataFrame([], LABELS))
    assert got.count() == 600 and got.where("part = '' and good_lost = 0").count() == 600


def test_matrix_holds_every_count_under_one_number_per_word(spark):
    docs = [(i, t, "s") for i, t in enumerate(TEXTS)]
    shards, words = ta.document_term_matrix(docs_of(spark, docs).repartition(3), scratch_path(spark, "matrix"))
    of = {r["id"]: (r["word"], r["total"]) for r in spelled(words).collect()}
    assert len(of) == len({w for w, _ in of.values()})
    seen = {}
    for r in shards.collect():
        at, ids, data = unpack(r["indptr"], np.int64), unpack(r["indices"], np.int64), unpack(r["data"], np.int64)
        for k, doc in enumerate(r["doc_ids"]):
            own = {of[i][0]: n for i, n in zip(ids[at[k]:at[k + 1]].tolist(), data[at[k]:at[k + 1]].tolist())}
            assert r["n_words"][k] == sum(own.values()) and r["n_distinct"][k] == len(own)
            seen[int(doc)] = own
    for i, t, _ in docs:
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        assert seen[i] == {x: w.count(x) for x in set(w)} if len(w) < 1000 else seen[i].keys() == set(w)
    assert all(total == sum(c.get(w, 0) for c in seen.values()) for w, total in of.values())


def test_string_ids_are_compared_as_strings(spark):
    df = spark.createDataFrame([("b", "t", "s"), ("a", "t", "s"), ("10", "u", "s"), ("9", "u", "s")], "doc_id string, text string, source string")
    got = {r["doc_id"]: r["failed"] & 16 for r in ta.failures(df).collect()}
    assert got == {"a": 0, "b": 16, "10": 0, "9": 16}
