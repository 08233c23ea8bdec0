"""Linear least squares and boosted trees for the forecaster, fitted from distributed sums and rounds.

``fit_linear`` needs one pass: every task adds up the products of its rows' columns (the Gram matrix), the matrices are
summed, and the driver solves one system whose size is the number of columns. ``fit_boosted`` adds trees until an
own validation split stops improving.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Partial matrices are summed in so many groups, so that no task adds up those of all others.
_SALTS = 64


def gram(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Sums of products of 1 and all columns, over the rows without NULL in any of them; (p+1) x (p+1)."""
    p = len(columns) + 1

    def products(batches):
        total = np.zeros((p, p))
        for batch in batches:
            rows = np.column_stack([np.ones(batch.num_rows), *(c.to_numpy(zero_copy_only=False) for c in batch.columns)])
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % _SALTS], pa.int32()),
                                          pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["salt", "m"])

    given = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    parts = given.mapInArrow(products, "salt int, m array<double>").groupBy("salt").agg(Summarizer.sum(array_to_vector(F.col("m"))).alias("m"))
    found = parts.select(vector_to_array("m").alias("m")).collect()  # at most _SALTS matrices
    return sum((np.array(r["m"]).reshape(p, p) for r in found), np.zeros((p, p)))


@dataclass(frozen=True)
class Linear:
    """A fitted line: y = intercept + sum of weights times inputs. ``n`` rows were used."""

    inputs: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    n: int

    def predicted(self) -> Column:
        out = F.lit(self.intercept)
        for c, w in zip(self.inputs, self.weights):
            out = out + F.col(c) * F.lit(w)
        return out


def fit_linear(df: DataFrame, inputs: Sequence[str], target: str, ridge: float = 0.0) -> Linear | None:
    """Least squares of ``target`` on ``inputs`` with an intercept (``ridge`` times n penalises the weights only); None without rows.

    Inputs that do not vary, or depend on others, get the solution of least length.
    """
    g = gram(df, [*inputs, target])
    n = int(g[0, 0])
    if not n:
        return None
    means = g[0] / n
    centred = g / n - np.outer(means, means)
    k = len(inputs)
    weights = np.linalg.lstsq(centred[1:k + 1, 1:k + 1] + ridge * np.eye(k), centred[1:k + 1, k + 1], rcond=1e-10)[0] if k else np.empty(0)
    return Linear(tuple(inputs), float(means[k + 1] - weights @ means[1:k + 1]), tuple(float(w) for w in weights), n)


def fit_boosted(df: DataFrame, inputs: Sequence[str], target: str, validation: Column, max_rounds: int = 50, tolerance: float = 0.01,
                depth: int = 3, step: float = 0.2, seed: int = 7) -> GBTRegressionModel:
    """Boosted regression trees, stopped once a round lowers the error on the ``validation`` rows by less than ``tolerance``.

    Validation rows choose the number of rounds and are never fitted; keep a third split for scoring. Rows with a NULL target are left out, NULL
    inputs count as 0. Adds the column ``prediction``.
    """
    data = VectorAssembler(inputCols=list(inputs), outputCol="features").transform(
        df.where(F.col(target).isNotNull()).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in inputs],
                                                    F.col(target).cast("double").alias(target), F.coalesce(validation, F.lit(False)).alias("__validation")))
    return GBTRegressor(featuresCol="features", labelCol=target, maxIter=max_rounds, maxDepth=depth, stepSize=step, seed=seed, validationTol=tolerance,
                        validationIndicatorCol="__validation", cacheNodeIds=True, checkpointInterval=10).fit(data)


def apply_boosted(model: GBTRegressionModel, df: DataFrame, inputs: Sequence[str], out: str) -> DataFrame:
    filled = df.withColumns({f"__in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs})
    scored = model.transform(VectorAssembler(inputCols=[f"__in_{c}" for c in inputs], outputCol="features").transform(filled))
    return scored.withColumnRenamed("prediction", out).drop("features", *[f"__in_{c}" for c in inputs])


def errors(scored: DataFrame, target: str, predicted: Column) -> DataFrame:
    """One row: n, mae and mse over the rows with a target and a prediction."""
    err = F.col(target) - predicted
    return scored.agg(F.count(err).alias("n"), F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"))
