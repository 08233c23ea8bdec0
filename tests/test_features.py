"""Feature preparation: exact quantile, split, scaling, sequence windows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.operators import features as fe


@pytest.mark.parametrize("seed,dups", [(1, False), (2, True)])
def test_exact_quantile_matches_numpy(spark, seed, dups):
    rng = random.Random(seed)
    vals = [rng.randrange(0, 10**12) for _ in range(5000)]
    if dups:  # a third of all rows share one value
        vals += [123456789] * 2500
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v long")
    for q in (0.0, 0.1, 0.5, 0.8, 1.0):
        got = fe.exact_quantile(df, F.col("v"), q, buckets=64, collect_max=50)
        assert got == pytest.approx(float(np.quantile(np.array(vals, dtype=np.float64), q)), rel=1e-12)


def _frame(spark):
    rows = []
    for p in range(3):
        for i in range(12):
            rows.append((f"P{p}" if p else None, dt.datetime(2025, 1, 1 + i, p), float(i), i % 2 == 0, "GK" if p else "XX"))
    return spark.createDataFrame(rows, "player_name string, kickoff_time timestamp, total_points double, "
                                       "was_home boolean, position string")


def test_encode_fill_and_split(spark):
    df = fe.encode(_frame(spark).withColumn("fixture_difficulty", F.lit(None).cast("int")))
    r = df.where("player_name = 'P1'").first()
    assert (r.pos_GK, r.pos_DEF, r.pos_MID, r.pos_FWD) == (1, 0, 0, 0) and r.fixture_difficulty == 3.0
    assert df.where("player_name IS NULL").first().pos_GK == 0
    split, cutoff = fe.time_split(df)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 36 and counts["test"] > 0
    assert split.where("split = 'train'").agg(F.max("kickoff_time")).first()[0] <= \
        split.where("split = 'test'").agg(F.min("kickoff_time")).first()[0]


def test_minmax_constant_and_no_clipping(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(4.0, 7.0)], "a double, b double")
    params = fe.fit_minmax(train, ["a", "b"])
    tr = sorted(tuple(r) for r in fe.apply_minmax(train, params).collect())
    assert tr == [(0.0, 0.0), (1.0, 0.0)]                     # constant column -> 0
    assert tuple(fe.apply_minmax(test, params).first()) == (1.5, 2.0)  # outside the fit: not clipped


def test_sequences_stay_within_player_and_keep_null_targets(spark):
    df = _frame(spark).withColumn("split", F.lit("train"))
    df = df.withColumn("total_points", F.when(F.col("total_points") == 7, None).otherwise(F.col("total_points")))
    df = df.withColumn("ctx_a", F.lit(1.0))
    s = fe.sequences(df, ("split", "player_name"), ("kickoff_time",), 5, 3, ["total_points"], ["ctx_a"], "total_points")
    rows = s.collect()
    assert len(rows) == 2 * (12 - 5 - 3 + 1)                  # NULL player dropped; 5 windows per player
    for r in rows:
        assert len(r.seq) == 5 and len(r.y) == 3
    anchor = [r for r in rows if r.player_name == "P1" and r.kickoff_time.day == 6][0]
    assert [x.total_points for x in anchor.seq] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert list(anchor.y) == [5.0, 6.0, None]                 # NULL target keeps its slot


def test_exact_quantile_wide_range_is_exact(spark):
    rng = random.Random(11)
    vals = [rng.randrange(-2**61, 2**61) for _ in range(3000)] + [2**61, -2**61, 0, 1, -1]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    s = sorted(vals)
    for q in (0.25, 0.8, 0.999):
        h = (len(s) - 1) * q
        i = int(h)
        want = float(s[i]) if i + 1 >= len(s) else s[i] + (h - i) * (s[i + 1] - s[i])
        assert fe.exact_quantile(df, F.col("v"), q, buckets=16, collect_max=20) == want


def test_quantiles_of_many_ranks_read_the_input_twice(spark, workdir, monkeypatch):
    rng = random.Random(5)
    vals = [rng.randrange(10**9) for _ in range(30_000)] + [777_777_777] * 15_000  # a third of all rows share one value
    spark.createDataFrame([(v,) for v in vals] + [(None,)], "v long").write.parquet(workdir)
    sources, plain = [], fe._value_at
    monkeypatch.setattr(fe, "_value_at", lambda values, *a: sources.extend(values.inputFiles()) or plain(values, *a))
    qs = [0.0, 0.01, 0.2, 0.5, 0.8, 0.80001, 0.99, 1.0]
    got = fe.exact_quantiles(spark.read.parquet(workdir), F.col("v"), qs, accuracy=1000, buckets=64, collect_max=20)
    want = [float(np.quantile(np.array(vals, dtype=np.float64), q)) for q in qs]
    assert got == pytest.approx(want, rel=1e-12)
    assert sources and not [f for f in sources if workdir in f]  # ranks are looked up in the stored counts, not in the input
    assert fe.exact_quantiles(spark.read.parquet(workdir).where("v < 0"), F.col("v"), qs) == [None] * len(qs)


def test_quantile_missed_by_the_sketch_is_found_in_the_input(spark, monkeypatch):
    df = spark.createDataFrame([(v,) for v in range(3000)], "v long")
    monkeypatch.setattr(fe, "_brackets", lambda pairs: [(10, 20), (2500, 2600)])
    qs = [0.0, 0.4, 0.99]
    assert fe.exact_quantiles(df, F.col("v"), qs, accuracy=100, buckets=8, collect_max=4) == pytest.approx([0.0, 1199.6, 2969.01])
