"""Join helpers that keep broadcasts size-checked and NULL keys explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_row(df: DataFrame) -> DataFrame:
    """Broadcast a global (ungrouped) aggregate: it has exactly one row by construction."""
    return F.broadcast(df)


#: Most rows of a frame that ``bounded_broadcast`` broadcasts.
BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a frame of fixed-width columns if it has at most ``rows`` rows (counted); else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), keys kept once from the left."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])
