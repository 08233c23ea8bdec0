"""Row-frame windows per key (``ROWS BETWEEN p PRECEDING AND f FOLLOWING``) that stay
parallel when one key holds a large share of all rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. That is the
right plan for ordinary keys (one exchange, shared by every window on the same key),
so it is kept for them. Keys above ``hot_rows`` rows are handled separately:

1. one partial aggregation counts rows per key; only keys above the threshold (at most
   ``total / hot_rows`` of them, and never more than ``max_hot``) reach the driver;
2. hot rows are range-partitioned on (key, order) into tasks of about
   ``goldleaf.window.taskRows`` rows: the sampled range bounds split even a single key
   across many tasks (hot rows are staged in the checkpoint folder first, so sampling the
   bounds does not recompute the input); after a sort within partitions each row gets its
   partition id and position, and the result is checkpointed so both stay fixed;
3. per (partition, key) counts give each partition's offset within its key (a window over
   at most one row per partition and key), hence an exact 0-based sequence per key;
4. the frame is evaluated per (key, bucket of ``bucket_rows`` sequence numbers), each
   bucket also receiving the ``p`` rows before it and ``f`` rows after it as halo rows
   that are dropped afterwards; every group is bounded by ``bucket_rows + p + f``.

Whole-group aggregates (``totals``) on hot keys use a partial aggregation joined back.
Results are identical to the plain window (checked by tests).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from goldleaf.plans.joins import join_null_safe
from goldleaf.session import checkpoint_root

HOT_ROWS_CONF = "goldleaf.window.hotKeyRows"
BUCKET_ROWS_CONF = "goldleaf.window.bucketRows"
TASK_ROWS_CONF = "goldleaf.window.taskRows"
DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_BUCKET_ROWS = 500_000
DEFAULT_TASK_ROWS = 1_000_000
DEFAULT_MAX_HOT = 10_000


@dataclass(frozen=True)
class Frame:
    """One windowed expression over ROWS BETWEEN ``before`` PRECEDING AND ``after`` FOLLOWING
    (negative ``after`` = ending before the current row)."""
    before: int
    after: int
    fn: Callable[[WindowSpec], Column]


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    # Ascending with NULLs first, the Spark SQL default for ORDER BY in a window.
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def rows_window(keys: Sequence[str], order: Sequence[str | Column], before: int, after: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*_order_cols(order)).rowsBetween(-before, after)


def _plain(df: DataFrame, keys, order, frames: dict[str, Frame], totals: dict[str, tuple[Sequence[str], Column]]):
    cols = [fr.fn(rows_window(keys, order, fr.before, fr.after)).alias(n) for n, fr in frames.items()]
    cols += [agg.over(Window.partitionBy(*keys, *extra)).alias(n) for n, (extra, agg) in totals.items()]
    return df.select("*", *cols)


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int, max_hot: int = DEFAULT_MAX_HOT):
    """Keys with more than ``hot_rows`` rows (NULL is a key too); None if more than ``max_hot``."""
    heavy = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
             .limit(max_hot + 1).collect())
    return None if len(heavy) > max_hot else heavy


def _sequenced(hot: DataFrame, keys, order, total_rows: int) -> DataFrame:
    """Hot rows with an exact 0-based position ``__seq`` in (key, order)."""
    parts = max(2, -(-total_rows // _conf_int(hot, TASK_ROWS_CONF, DEFAULT_TASK_ROWS)))
    sort = [F.col(k).asc_nulls_first() for k in keys] + _order_cols(order)
    ranged = (hot.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    firsts = ranged.groupBy("__pid", *keys).agg(F.min("__mid").alias("__m0"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select("__pid", *keys, "__m0", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    seq = join_null_safe(ranged, offsets, ["__pid", *keys])
    return seq.withColumn("__seq", F.col("__off") + F.col("__mid") - F.col("__m0")).drop(
        "__pid", "__mid", "__m0", "__off")


def _hot(hot: DataFrame, keys, order, frames: dict[str, Frame], totals, total_rows: int, bucket_rows: int):
    # Stage the hot rows once: the range-bound sampling job, the range shuffle and the
    # whole-group totals then read files instead of recomputing the upstream plan.
    checkpoint_root(hot.sparkSession)
    hot = hot.checkpoint(eager=True)
    seq = _sequenced(hot, keys, order, total_rows)
    pre = max([0] + [fr.before for fr in frames.values()])
    post = max([0] + [fr.after for fr in frames.values()])
    b = F.floor(F.col("__seq") / F.lit(bucket_rows)).cast("long")
    # A row is needed by the frames of rows up to ``post`` before and ``pre`` after it, however many buckets these span.
    first = F.floor((F.col("__seq") - F.lit(post)) / F.lit(bucket_rows)).cast("long")
    last = F.floor((F.col("__seq") + F.lit(pre)) / F.lit(bucket_rows)).cast("long")
    spread = seq.select("*", F.explode(F.sequence(first, last)).alias("__b")).withColumn("__halo", F.col("__b") != b)
    cols = [fr.fn(Window.partitionBy(*keys, "__b").orderBy("__seq").rowsBetween(-fr.before, fr.after)).alias(n)
            for n, fr in frames.items()]
    out = spread.select("*", *cols).where(~F.col("__halo")).drop("__b", "__halo", "__seq")
    for name, (extra, agg) in totals.items():
        sums = hot.groupBy(*keys, *extra).agg(agg.alias(name))
        out = join_null_safe(out, sums, [*keys, *extra], "left")
    return out


def over_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              frames: dict[str, Frame], totals: dict[str, tuple[Sequence[str], Column]] | None = None,
              hot_rows: int | None = None, bucket_rows: int | None = None,
              max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """Add one column per ``frames`` entry (a bounded row frame per key ordered by ``order``)
    and per ``totals`` entry (an aggregate over the whole (key + extra keys) group).

    ``order`` must end in a unique tie-breaker for the result to be deterministic.
    ``hot_rows`` (default: session conf ``goldleaf.window.hotKeyRows``, 2,000,000) is the
    row count above which a key is split across tasks; ``0`` disables the check. With more than
    ``max_hot`` such keys all rows take the split path. The result is the same on every path.
    """
    totals = totals or {}
    hot_rows = _conf_int(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS) if hot_rows is None else hot_rows
    bucket_rows = _conf_int(df, BUCKET_ROWS_CONF, DEFAULT_BUCKET_ROWS) if bucket_rows is None else bucket_rows
    if hot_rows <= 0 or df.isStreaming:
        return _plain(df, keys, order, frames, totals)
    heavy = hot_keys(df, keys, hot_rows, max_hot)
    if heavy == []:
        return _plain(df, keys, order, frames, totals)
    if heavy is None:  # skew everywhere: sequence every key
        return _hot(df, keys, order, frames, totals, df.count(), bucket_rows)
    spark = df.sparkSession
    key_df = F.broadcast(spark.createDataFrame([tuple(r[k] for k in keys) for r in heavy],
                                               df.select(*keys).schema))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(key_df[k])
        cond = c if cond is None else cond & c
    hot = df.join(key_df, cond, "left_semi")
    cold = df.join(key_df, cond, "left_anti")
    n_hot = sum(r["__n"] for r in heavy)
    result = _plain(cold, keys, order, frames, totals).unionByName(
        _hot(hot, keys, order, frames, totals, n_hot, bucket_rows))
    return result
