import random
import re

import pytest

from goldleaf.llm import quality

SPACE = "[\x20\x09-\x0D]"
DOCS = "doc_id long, text string, words string, kept string"


def features(text):
    w = [x for x in re.split(SPACE + "+", text) if x]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = {}
    for g in windows:
        counts[g] = counts.get(g, 0) + 1
    covered = {i + o for i, g in enumerate(windows) if counts[g] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
            "n_upper": len(re.findall("[A-Z]", text)), "n_lower": len(re.findall("[a-z]", text)), "n_marks": len(re.findall("[!?]", text)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def rejecting(f):
    n = f["n_words"]
    return {name for name, no in {
        "too_few_words": n < 50, "word_length": f["word_chars"] < 2 * n or f["word_chars"] > 14 * n, "symbols": 10 * f["n_symbols"] > n,
        "shouting": f["n_upper"] > f["n_lower"], "marks": 3 * f["n_marks"] > n,
        "dup_lines": f["n_dup_lines"] > 2 and 100 * f["n_dup_lines"] > 30 * f["n_lines"],
        "repeat_words": 100 * f["n_repeat_words"] > 50 * n}.items() if no}


def texts():
    rng = random.Random(1)
    plain = lambda n: " ".join(f"word{rng.randrange(4000)}" for _ in range(n))
    rows = [None, "", " \t\n\x0b", "one", plain(49), plain(50), plain(300), plain(80).upper(), "a b c " * 40, "été " * 60, "x" * 900 + " y" * 60]
    rows += [plain(60) + " #" * n for n in (5, 6, 7, 8)] + [plain(60) + " what?!" * n for n in (10, 29, 30, 40)]
    rows += ["\n".join([plain(12)] * n + [plain(12) for _ in range(8)]) for n in (2, 3, 4, 9)]
    rows += [(plain(20) + " ") * 2 + plain(n) for n in (39, 40, 41, 60)] + ["\n\n".join([plain(5), "same line here"] * 9)]
    rows += [plain(rng.randrange(1, 200)) + rng.choice(["", "!", " same words here" * 9]) for _ in range(40)]
    return rows + rows[4:8]


@pytest.fixture(scope="module")
def rows():
    return [(None if i % 11 == 3 else i % 50, t, "clash", "clash") for i, t in enumerate(texts())]


def test_features_and_verdicts_against_brute_force_in_any_order(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    want = sorted(((i, *features(t or "").values(), not rejecting(features(t or ""))) for i, t, *_ in rows), key=str)
    names = tuple(features(""))
    orders = [None, [r.name for r in quality.RULES], [r.name for r in reversed(quality.RULES)]]
    for order in orders:
        got = quality.cascade(df, order=order, features=names).collect()
        assert sorted(((r.doc_id, *[r[n] for n in names], r.kept) for r in got), key=str) == want
        assert all((r.rejected_by is None) == r.kept for r in got)
    kept = [r[-1] for r in want]
    assert 10 < sum(kept) < len(kept) - 10


def test_first_rule_in_the_order_is_named(spark, rows):
    order = ["repeat_words", "marks", "shouting", "dup_lines", "symbols", "word_length", "too_few_words"]
    got = quality.cascade(spark.createDataFrame(rows, DOCS), order=order, keep=("text", "words")).collect()
    for r in got:
        hit = rejecting(features(r.text or ""))
        assert r.rejected_by == next((n for n in order if n in hit), None) and r.words == "clash"


def test_order_is_rejections_per_cost():
    stats = [{"rule": "dear", "cost": 4.0, "rejects": 0.8}, {"rule": "cheap", "cost": 1.0, "rejects": 0.3},
             {"rule": "b_none", "cost": 1.0, "rejects": 0.0}, {"rule": "a_none", "cost": 1.0, "rejects": 0.0}, {"rule": "quick_none", "cost": 0.5, "rejects": 0.0}]
    assert quality.learned_order(stats) == ["cheap", "dear", "quick_none", "a_none", "b_none"]


def test_sample_covers_all_partitions_and_lengths(spark):
    """Every third row is over 20,000 characters and rejected; the first partitions hold none of them."""
    bad = "same words here " * 1500
    rows = [(i, f"own text {i} " * 30 if i < 400 else bad) for i in range(600)]
    stats = {s["rule"]: s for s in quality.measure(spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(12, "doc_id"), sample_rows=300)}
    assert set(stats) == {r.name for r in quality.RULES} and all(s["cost"] > 0 for s in stats.values())
    alone = {s["rule"]: s["rejects"] for s in quality.measure(spark.createDataFrame(rows[:400], "doc_id long, text string"))}
    assert stats["repeat_words"]["rejects"] == 1.0 and alone["repeat_words"] == 1.0
    lengths = quality.Rule("long", "word_chars > 10000", ("word_chars",))
    share = quality.measure(spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(12, "doc_id"), [lengths], sample_rows=300)[0]["rejects"]
    assert 0.2 < share < 0.5


def test_empty_table_and_kept_rows(spark, rows):
    df = spark.createDataFrame(rows, DOCS)
    assert quality.cascade(df.limit(0)).count() == 0
    assert [s["rejects"] for s in quality.measure(df.limit(0))] == [0.0] * len(quality.RULES)
    kept = quality.kept_rows(df.withColumnRenamed("kept", "source"), ("doc_id", "text", "source"))
    want = sorted(((i, t, "clash") for i, t, *_ in rows if not rejecting(features(t or ""))), key=str)
    assert kept.columns == ["doc_id", "text", "source"] and sorted(map(tuple, kept.collect()), key=str) == want


def test_very_long_text(spark):
    rng = random.Random(2)
    t = "\n".join(" ".join(f"w{rng.randrange(300)}" for _ in range(20)) for _ in range(10_000))
    f = features(t)
    got = quality.cascade(spark.createDataFrame([(1, t)], "doc_id long, text string"), features=tuple(f)).first()
    assert {n: got[n] for n in f} == f and got.kept == (not rejecting(f))
