"""Multi-step points forecaster on the sequence samples, trained with Spark ML.

The reference trains a neural network on the driver. Here each horizon step gets one
distributed linear model over the flattened (past x features + context) vector, fitted
on the training split and scored on the held-out split; metrics are aggregated on the
cluster. Only model coefficients and the metric rows are small enough to reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.features import CONTEXT_FEATURES, FUTURE_LEN, PAST_LEN, SEQUENCE_FEATURES


def flatten_samples(samples: DataFrame, keys: Sequence[str], features: Sequence[str] = SEQUENCE_FEATURES,
                    context: Sequence[str] = CONTEXT_FEATURES, past: int = PAST_LEN,
                    future: int = FUTURE_LEN) -> DataFrame:
    """seq/ctx/y arrays -> scalar columns x<t>_<feature> (t=1 oldest), ctx columns, y1..y<future>."""
    xs = [F.col("seq")[t - 1][f].alias(f"x{t}_{f}") for t in range(1, past + 1) for f in features]
    cs = [F.col("ctx")[c].alias(c) for c in context]
    ys = [F.col("y")[h - 1].alias(f"y{h}") for h in range(1, future + 1)]
    return samples.select(*keys, *xs, *cs, *ys)


def input_columns(features: Sequence[str] = SEQUENCE_FEATURES, context: Sequence[str] = CONTEXT_FEATURES,
                  past: int = PAST_LEN) -> list[str]:
    return [f"x{t}_{f}" for t in range(1, past + 1) for f in features] + list(context)


def fit_forecast(train: DataFrame, future: int = FUTURE_LEN, reg: float = 0.01, max_iter: int = 50):
    """One ``LinearRegression`` per horizon step; rows with a NULL target for a step are skipped."""
    assembler = VectorAssembler(inputCols=input_columns(), outputCol="features", handleInvalid="keep")
    data = assembler.transform(train)
    models = []
    for h in range(1, future + 1):
        lr = LinearRegression(featuresCol="features", labelCol=f"y{h}", predictionCol=f"p{h}",
                              regParam=reg, elasticNetParam=0.0, maxIter=max_iter)
        models.append(lr.fit(data.where(F.col(f"y{h}").isNotNull())))
    return assembler, models


def forecast(assembler, models, df: DataFrame) -> DataFrame:
    out = assembler.transform(df)
    for m in models:
        out = m.transform(out)
    return out.drop("features")


def metrics(scored: DataFrame, target_range: float = 1.0, future: int = FUTURE_LEN) -> DataFrame:
    """MAE / MSE per step in scaled units, and MAE in target units (scaled error x range)."""
    parts = []
    for h in range(1, future + 1):
        err = F.col(f"y{h}") - F.col(f"p{h}")
        parts.append(scored.where(F.col(f"y{h}").isNotNull()).agg(
            F.lit(h).alias("step"), F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
            F.avg(err * err).alias("mse"), (F.avg(F.abs(err)) * F.lit(target_range)).alias("mae_points")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
