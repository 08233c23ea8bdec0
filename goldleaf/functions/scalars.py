"""Scalar column expressions shared by the silver and gold layers.

All are built-in Spark expressions (no Python UDFs), so they fuse into
whole-stage codegen and behave the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position code -> label used by the player dimension.
# Codes outside this table map to NULL (CASE without ELSE).
POSITION_LABELS = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, scale: int) -> Column:
    """ROUND(x, n) half-up on the decimal value of ``x``, returned as double.

    Going through DECIMAL(38,10) makes the result independent of float summation
    order and of the engine's binary rounding, so two engines computing the same
    average agree to the last digit.
    """
    return F.round(_col(c).cast("decimal(38,10)"), scale).cast("double")


def nullif_zero(c: str | Column) -> Column:
    """NULLIF(x, 0)."""
    x = _col(c)
    return F.when(x != 0, x)


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """num / NULLIF(den, 0) in double arithmetic (NULL instead of a divide-by-zero)."""
    return _col(num).cast("double") / nullif_zero(_col(den).cast("double"))


def tenths_to_units(c: str | Column) -> Column:
    """Price stored in tenths (e.g. 55) to units (5.5), always double."""
    return _col(c).cast("double") / F.lit(10.0)


def full_name(first: str | Column, second: str | Column) -> Column:
    """first || ' ' || second; NULL when either part is NULL (concat, not concat_ws)."""
    return F.concat(_col(first), F.lit(" "), _col(second))


def position_label(code: str | Column) -> Column:
    """Simple CASE code -> label with no ELSE branch (unknown codes give NULL)."""
    c = _col(code)
    expr = None
    for k, v in POSITION_LABELS.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def snapshot_stamp(ts: str | Column) -> Column:
    """UTC file stamp ``yyyy-MM-ddTHHmmssZ`` used in landing file names."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HHmmss'Z'")
