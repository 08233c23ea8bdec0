import numpy as np
from pyspark.sql import functions as F

from goldleaf.llm import hypervectors as hv
from goldleaf.llm.queries import QUERIES

DIM, SCHEMA = 256, "doc_id long, text string, lang string, score double, lang_pred string, vector int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, "xx", 3) for i, t, lang in rows], SCHEMA)


def slow_bundle(text, dim=DIM):
    """Letter by letter, with the vectors of the definition."""
    codes = [0, *((ord(c.lower()) if len(c.lower()) == 1 else ord(c)) if c.isalpha() else 0 for c in text or ""), 0]
    out = np.zeros(dim)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            v = [hv.letter_vector(x, dim, hv.SEED).astype(int) for x in (a, b, c)]
            out += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return out


def slow_predict(rows, learned, dim=DIM):
    sums = {}
    for i, t, lang in rows:
        if learned(i) and lang is not None and slow_bundle(t, dim).any():
            sums[lang] = sums.get(lang, 0) + slow_bundle(t, dim)
    out = []
    for i, t, _ in rows:
        v = slow_bundle(t, dim)
        ranked = sorted((-round(min(1, max(0, v @ s / np.linalg.norm(v) / np.linalg.norm(s))), 9), lang) for lang, s in sums.items()) if v.any() else []
        out.append((i, ranked[0][1] if ranked else "und", round(-ranked[0][0], 6) if ranked else 0.0))
    return sorted(out, key=str)


ROWS = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "THE other, then!", "en"), (4, "les autres été", "fr"), (5, None, "en"),
        (6, "", "fr"), (7, "12 34 !?", "en"), (8, "ein Straße ΔΣ", "de"), (9, "the dog", None), (10, "le chien", None), (11, "I", "en"), (12, "İı 日本語の", None),
        (1, "the cat and the dog", "en"), (None, "und then", None)]


def judged(df):
    return sorted(((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    learned = F.coalesce(F.col("doc_id"), F.lit(0)) < 9
    got = hv.predict(frame(spark, ROWS).repartition(3), learned, dimensions=DIM)
    assert judged(got) == slow_predict(ROWS, lambda i: (i or 0) < 9)


def test_passes_over_few_languages_each_agree(spark, monkeypatch):
    learned = F.coalesce(F.col("doc_id"), F.lit(0)) < 9
    monkeypatch.setattr(hv, "PASS_LANGUAGES", 1)
    got = hv.predict(frame(spark, ROWS), learned, dimensions=DIM)
    assert judged(got) == slow_predict(ROWS, lambda i: (i or 0) < 9)


def test_equal_languages_go_by_name_and_prediction_ignores_lang(spark):
    rows = [(1, "same text", "zz"), (2, "same text", "aa"), (3, "same text", "zz"), (4, "same text", None)]
    got = hv.predict(frame(spark, rows), F.col("doc_id") < 3, dimensions=DIM)
    assert {r["lang_pred"] for r in got.collect()} == {"aa"}


def test_nothing_learned_and_empty_table(spark):
    assert judged(hv.predict(frame(spark, ROWS[:3]), F.lit(False))) == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert hv.predict(frame(spark, []), F.lit(True)).count() == 0
    only = [(1, "12", "en"), (2, "word", None)]
    assert judged(hv.predict(frame(spark, only), F.lit(True))) == [(1, "und", 0.0), (2, "und", 0.0)]


def test_slices_and_blocks_change_nothing(monkeypatch):
    texts = ["", "abc déf" * 40, "x", "日本 語" * 30, "a b c"]
    groups = np.array([0, 1, 1, 2, 0])
    whole = hv.bundles(texts, groups, 3, DIM, hv.SEED)
    assert np.array_equal(whole, np.stack([sum(slow_bundle(t) for t, g in zip(texts, groups) if g == k) for k in range(3)]))
    monkeypatch.setattr(hv, "_SLICE_CHARS", 7)
    monkeypatch.setattr(hv, "_BLOCK_TRIGRAMS", 5)
    assert np.array_equal(hv.bundles(texts, groups, 3, DIM, hv.SEED), whole)


def test_very_long_text(spark):
    rows = [(1, "the cat and " * 400_000, "en"), (2, "le chat et " * 10, "fr"), (3, "the cat", None)]
    assert [r[1] for r in judged(hv.predict(frame(spark, rows), F.col("doc_id") < 3))] == ["en", "fr", "en"]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op13_hyperdimensional_language"](spark, d).where("held_out")
    truth = spark.read.parquet(f"{d}/documents.parquet").where("lang is not null and text rlike '[a-zA-Z]'").select("doc_id", "lang")
    hits = got.join(truth, "doc_id").agg(F.avg(F.when(F.col("lang") == F.col("lang_pred"), 1.0).otherwise(0.0)).alias("x"), F.count("*").alias("n")).first()
    assert hits["n"] > 150 and hits["x"] > 0.98
