"""Least squares from the Gram matrix, and boosted rounds that stop early."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldleaf.operators import least_squares as ls


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)) * [1, 10, 0.1] + [5, 0, 100]
    y = 2 + x @ [1.5, -0.25, 4] + rng.normal(size=400)
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(7)


def test_equals_the_direct_solution(spark, line):
    x, y, df = line
    want = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    fit = ls.fit_linear(df, ["a", "b", "c"], "y")
    assert fit.n == 400 and np.allclose([fit.intercept, *fit.weights], want, atol=1e-6)
    got = ls.errors(df, "y", fit.predicted()).first()
    err = y - np.column_stack([np.ones(len(x)), x]) @ want
    assert got["n"] == 400 and abs(got["mae"] - abs(err).mean()) < 1e-6 and abs(got["mse"] - (err ** 2).mean()) < 1e-6
    assert all(abs(w) < 1e-3 for w in ls.fit_linear(df, ["a", "b", "c"], "y", ridge=1e6).weights)


def test_nulls_constants_copies_and_no_rows(spark, line):
    _, _, df = line
    odd = df.withColumn("k", F.lit(3)).withColumn("a2", F.col("a") * 2).withColumn("y", F.when(F.col("id") % 4 > 0, F.col("y")))
    fit, plain = ls.fit_linear(odd, ["a", "a2", "k"], "y"), ls.fit_linear(odd, ["a"], "y")
    assert fit.n == 300 and abs(fit.weights[2]) < 1e-9 and abs(fit.weights[0] + 2 * fit.weights[1] - plain.weights[0]) < 1e-6
    assert ls.fit_linear(df.limit(0), ["a"], "y") is None and ls.fit_linear(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y") is None
    none = ls.fit_linear(odd, [], "y")
    assert none.weights == () and abs(none.intercept - odd.agg(F.avg("y")).first()[0]) < 1e-9


def test_boosting_stops_early_and_validation_rows_are_not_fitted(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("part"), F.when(F.col("id") % 50 > 0, (F.col("id") * 7 % 100).cast("double")).alias("x"),
                                  F.rand(5).alias("noise"))
    df = df.withColumn("y", F.coalesce(F.col("x"), F.lit(0)) * F.col("x") % 37 + F.col("x") + F.col("noise")).checkpoint()
    model = ls.fit_boosted(df.where("part < 2"), ["x"], "y", F.col("part") == 1, max_rounds=60)
    assert 1 < model.getNumTrees < 60
    unseen = ls.apply_boosted(model, df.where("part = 2"), ["x"], "p")
    assert unseen.columns == [*df.columns, "p"] and ls.errors(unseen, "y", F.col("p")).first()["mse"] < 300
    lied = df.where("part < 2").withColumn("y", F.when(F.col("part") == 1, -10000.0).otherwise(F.col("y")))
    other = ls.fit_boosted(lied, ["x"], "y", F.col("part") == 1, max_rounds=60)
    assert ls.apply_boosted(other, df, ["x"], "p").agg(F.min("p")).first()[0] > -100
