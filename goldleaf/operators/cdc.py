"""Keyed change capture, SCD type 1 (one current row per key).

The reduction is an aggregation, not a window: ``max_by`` is order-free, has a
partial (map-side) phase, and so a key holding a third of all changes is still
combined in parallel before the shuffle. Out-of-order arrival does not matter:
the winner is decided by the sequence value, never by arrival.

Two NULL rules:

* ``ignore_null_updates=False`` - the row with the greatest sequence wins whole
  (NULLs in it overwrite).
* ``ignore_null_updates=True`` - per key *and per column* the latest non-NULL value
  wins; a NULL never replaces a stored value.

A NULL sequence comes before every other: such a change counts only where its key has no other.

The *state* form keeps the sequence that produced each value (``__seq`` or
``__seq_<col>``), so two states, or a state and a batch of changes, merge exactly
(``scd1_merge``); this is what the streaming upsert uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_SEQ = "__seq"


def _seq_col(sequence_by: str | Sequence[str] | Column) -> Column:
    if isinstance(sequence_by, Column):
        return sequence_by
    if isinstance(sequence_by, str):
        return F.col(sequence_by)
    cols = list(sequence_by)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*[F.col(c) for c in cols])


def _value_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys and not c.startswith("__seq")]


def to_state(changes: DataFrame, keys: Sequence[str], sequence_by, ignore_null_updates: bool = False) -> DataFrame:
    """Raw change rows -> state-shaped rows (every value carries its sequence)."""
    seq = _seq_col(sequence_by)
    values = _value_columns(changes, keys)
    if ignore_null_updates:
        return changes.select(*keys, *values, *[seq.alias(f"__seq_{v}") for v in values])
    return changes.select(*keys, *values, seq.alias(ROW_SEQ))


def reduce_state(state: DataFrame, keys: Sequence[str], ignore_null_updates: bool = False) -> DataFrame:
    """Group state-shaped rows by key and keep the winning value(s)."""
    values = _value_columns(state, keys)
    if ignore_null_updates:
        aggs = []
        for v in values:
            s = F.when(F.col(v).isNotNull(), F.struct(F.col(f"__seq_{v}").alias("q")))  # in a struct, NULL is the least
            aggs.append(F.max_by(F.col(v), s).alias(v))
            aggs.append(F.max(s)["q"].alias(f"__seq_{v}"))
        return state.groupBy(*keys).agg(*aggs)
    row = F.struct(*[F.col(v) for v in values])
    out = state.groupBy(*keys).agg(F.max_by(row, F.struct(ROW_SEQ)).alias("__row"), F.max(ROW_SEQ).alias(ROW_SEQ))
    return out.select(*keys, *[F.col(f"__row.{v}").alias(v) for v in values], ROW_SEQ)


def current(state: DataFrame) -> DataFrame:
    """Drop the bookkeeping sequence columns: the readable SCD-1 table."""
    return state.drop(*[c for c in state.columns if c.startswith("__seq")])


def scd1(changes: DataFrame, keys: Sequence[str], sequence_by, ignore_null_updates: bool = False) -> DataFrame:
    """Current row per key from a batch of (possibly out-of-order, duplicated) changes."""
    st = to_state(changes, keys, sequence_by, ignore_null_updates)
    return current(reduce_state(st, keys, ignore_null_updates))


def scd1_merge(state: DataFrame, changes: DataFrame, keys: Sequence[str], sequence_by,
               ignore_null_updates: bool = False) -> DataFrame:
    """Fold a batch of raw changes into an existing state; exact for any arrival order."""
    incoming = to_state(changes, keys, sequence_by, ignore_null_updates)
    return reduce_state(state.unionByName(incoming), keys, ignore_null_updates)


def scd1_state(changes: DataFrame, keys: Sequence[str], sequence_by, ignore_null_updates: bool = False) -> DataFrame:
    """State (values + sequences) of a batch of changes, ready for ``scd1_merge``."""
    return reduce_state(to_state(changes, keys, sequence_by, ignore_null_updates), keys, ignore_null_updates)
