"""Row expectations: named SQL predicates that either warn (keep, count) or drop.

A predicate that evaluates to NULL counts as failed (and is dropped by a drop rule).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"  # "warn" keeps the row, "drop" removes it

    def __post_init__(self):
        if self.action not in ("warn", "drop"):
            raise ValueError(f"unknown expectation action {self.action!r}")

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def apply_expectations(df: DataFrame, rules: Sequence[Expectation], observation: Observation | None = None) -> DataFrame:
    """Keep rows passing every drop rule; optionally count failures per rule as the data flows.

    The counts are gathered with ``observe`` (no extra pass over the data); read them from
    ``observation.get`` after an action. All drop rules are ANDed into one filter.
    """
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("__rows")]
        metrics += [F.count_if(~r.passed()).alias(r.name) for r in rules]
        df = df.observe(observation, *metrics)
    keep = None
    for r in rules:
        if r.action == "drop":
            keep = r.passed() if keep is None else keep & r.passed()
    return df if keep is None else df.where(keep)


def expectation_report(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: (rule, action, failed, total, kept) from a single aggregation pass.

    ``kept`` is the number of rows that survive all drop rules together.
    """
    drop = [r.passed() for r in rules if r.action == "drop"]
    keep_all = F.lit(True)
    for c in drop:
        keep_all = keep_all & c
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(keep_all).alias("kept")]
    aggs += [F.count_if(~r.passed()).alias(f"f{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"f{i}").alias("failed"))
        for i, r in enumerate(rules)
    ])).alias("r")
    return wide.select(rows, "total", "kept").select("r.rule", "r.action", "r.failed", "total", "kept")
