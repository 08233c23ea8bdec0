"""Leakage-free feature preparation for a multi-step points forecaster.

Everything stays a distributed DataFrame: one-hot and fills are column expressions,
the time split uses an exact distributed quantile, scaling statistics come from one
aggregation over the training rows, and the look-back / horizon windows are bounded
row frames (no group is ever collected to the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.windows import Frame, over_rows
from goldleaf.session import scratch_path

# The feature lists of the forecaster.
PAST_LEN = 5
FUTURE_LEN = 3
TARGET = "total_points"
SEQUENCE_FEATURES = [
    "goals_scored", "assists", "saves", "xG", "xA", "xGI", "xGC",
    "influence", "creativity", "threat", "ict_index",
    "minutes", "clean_sheets", "bonus", "bps",
    "yellow_cards", "red_cards", "own_goals", "penalties_missed",
]
POSITIONS = ["GK", "DEF", "MID", "FWD"]
CONTEXT_FEATURES = ["was_home", "fixture_difficulty", "pos_GK", "pos_DEF", "pos_MID", "pos_FWD"]
DEFAULT_DIFFICULTY = 3.0


def encode(df: DataFrame, position_col: str = "position") -> DataFrame:
    """One-hot position into four fixed 0/1 columns (unknown or NULL -> all 0), flag to int,
    missing difficulty -> 3."""
    pos = F.col(position_col)
    return df.select(
        "*",
        *[F.coalesce((pos == F.lit(p)).cast("int"), F.lit(0)).alias(f"pos_{p}") for p in POSITIONS],
    ).withColumn("was_home", F.col("was_home").cast("int")).withColumn(
        "fixture_difficulty", F.coalesce(F.col("fixture_difficulty").cast("double"), F.lit(DEFAULT_DIFFICULTY)))


def fill_defaults(df: DataFrame, features: Sequence[str] = SEQUENCE_FEATURES + CONTEXT_FEATURES) -> DataFrame:
    """Remaining NULL features -> 0. The target is deliberately not filled."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in features else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ exact distributed quantile

def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _value_at(values: DataFrame, rank: int, lo: int, hi: int, below: int, size: int, buckets: int, collect_max: int) -> int:
    """Value at a rank of (v, c) rows: ``size`` rows lie in [lo, hi], ``below`` before them.

    Each pass sums the counts in ``buckets`` equal-width buckets (one partial aggregation) and goes on in the bucket that
    holds the rank, until it is one value or few enough rows to fetch.
    """
    a, b = lo, hi
    while a < b:
        inside = values.where((F.col("v") >= a) & (F.col("v") <= b))
        if size <= collect_max:
            for v, c in sorted((r["v"], r["c"]) for r in inside.collect()):
                below += c
                if below > rank:
                    return v
        width = (b - a) // buckets + 1
        for k, c in sorted(inside.groupBy(F.expr(f"(v - {a}) div {width}").alias("k")).agg(F.sum("c")).collect()):
            if below + c > rank:
                a, b, size = a + k * width, min(b, a + (k + 1) * width - 1), c
                break
            below += c
    return a


def _brackets(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping value ranges made one; sorted."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(pairs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def exact_quantiles(df: DataFrame, col: Column, qs: Sequence[float], accuracy: int = 10_000, buckets: int = 4096,
                    collect_max: int = 4096) -> list[float | None]:
    """Exact linear-interpolation quantiles of an integral column (e.g. epoch micros), in the order asked.

    Same definition as ``quantile_cont`` / pandas: h = (n-1)q, x[floor h] + frac * (x[floor h + 1] - x[floor h]).
    The input is read twice, however many quantiles are asked:

    1. a mergeable sketch (``approx_percentile``, rank error n / ``accuracy``) gives a range of values around every wanted rank;
    2. one aggregation counts the rows between the ranges, and by value within them (a share of some 8 / ``accuracy`` of all rows for
       each quantile, stored under the scratch folder). From these counts the ranks are found exactly.

    A rank that the sketch missed is looked for in the input itself. A value that many rows share is one counted row. NULLs are
    left out; without values every quantile is None.
    """
    v = df.select(col.cast("long").alias("v")).where(F.col("v").isNotNull())
    off = 4 / accuracy
    asked = [min(1.0, max(0.0, p)) for q in qs for p in (q - off, q + off)]
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"),
                  F.percentile_approx("v", asked, accuracy).alias("p")).first()
    n, lo, hi = stats["n"], stats["lo"], stats["hi"]
    if not n:
        return [None for _ in qs]
    spots = [((n - 1) * q, int((n - 1) * q)) for q in qs]
    # A few thousand rows are one range: ranks this near to each other are not told apart by the sketch.
    near = [(lo if asked[2 * i] == 0 else stats["p"][2 * i], hi if asked[2 * i + 1] == 1 else stats["p"][2 * i + 1]) for i in range(len(qs))]
    ranges = _brackets([(lo, hi)] if n < accuracy else near)
    zone, value = F.lit(2 * len(ranges)), F.lit(None).cast("long")
    for i, (a, b) in reversed(list(enumerate(ranges))):  # zone 2i lies before range i, 2i + 1 is the range
        zone = F.when(F.col("v") < a, 2 * i).when(F.col("v") <= b, 2 * i + 1).otherwise(zone)
        value = F.when((F.col("v") >= a) & (F.col("v") <= b), F.col("v")).otherwise(value)
    path = scratch_path(df.sparkSession, "quantile-ranges")
    v.groupBy(zone.alias("zone"), value.alias("v")).agg(F.count(F.lit(1)).alias("c")).write.parquet(path)
    kept = df.sparkSession.read.schema("zone int, v long, c long").parquet(path)
    sizes = dict(kept.groupBy("zone").agg(F.sum("c")).collect())  # at most two per quantile and one
    found: dict[int, int] = {}
    for rank in sorted({r for h, r0 in spots for r in (r0, min(r0 + (h > r0), n - 1))}):
        below = 0
        for z in sorted(sizes):
            if below + sizes[z] > rank:
                break
            below += sizes[z]
        if z % 2:
            a, b = ranges[z // 2]
            found[rank] = _value_at(kept.where(F.col("zone") == z), rank, a, b, below, sizes[z], buckets, collect_max)
        else:
            a = ranges[z // 2 - 1][1] + 1 if z else lo
            b = ranges[z // 2][0] - 1 if z // 2 < len(ranges) else hi
            found[rank] = _value_at(v.withColumn("c", F.lit(1)), rank, a, b, below, sizes[z], buckets, collect_max)
    return [float(found[r]) if h == r else found[r] + (h - r) * (found[r + 1] - found[r]) for h, r in spots]


def exact_quantile(df: DataFrame, col: Column, q: float, buckets: int = 4096, collect_max: int = 4096) -> float | None:
    """One quantile by ``exact_quantiles``."""
    return exact_quantiles(df, col, [q], buckets=buckets, collect_max=collect_max)[0]


def time_split(df: DataFrame, time_col: str = "kickoff_time", q: float = 0.8,
               out: str = "split") -> tuple[DataFrame, float | None]:
    """``train`` when time <= the q-quantile of time, ``test`` when after; NULL time in neither.

    Returns the frame with the split label and the cutoff (epoch microseconds).
    """
    cutoff = exact_quantile(df, _micros(F.col(time_col)), q)
    t = _micros(F.col(time_col))
    if cutoff is None:
        return df.withColumn(out, F.lit(None).cast("string")), None
    label = F.when(t <= F.lit(cutoff), F.lit("train")).when(t > F.lit(cutoff), F.lit("test"))
    return df.withColumn(out, label), cutoff


# ------------------------------------------------------------------ scaling

def fit_minmax(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Per-column (min, max) over the training rows, NULLs ignored.

    One aggregation; only the 2 x len(cols) resulting scalars reach the driver (the fitted
    parameters, like a scaler's state).
    """
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"min_{c}"), F.max(F.col(c).cast("double")).alias(f"max_{c}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in cols}


def minmax_expr(c: str, lo: float | None, hi: float | None) -> Column:
    """(x - min) / range with range 1 for a constant column; values outside the fit are not clipped."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    rng = hi - lo
    return (F.col(c).cast("double") - F.lit(lo)) / F.lit(rng if rng != 0 else 1.0)


def apply_minmax(df: DataFrame, params: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Scale the fitted columns of ``df`` (train or test) with ``fit_minmax`` parameters."""
    return df.select(*[minmax_expr(c, *params[c]).alias(c) if c in params else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ sequence samples

def sequences(df: DataFrame, keys: Sequence[str] = ("split", "player_name"),
              order: Sequence[str] = ("kickoff_time",), past: int = PAST_LEN, future: int = FUTURE_LEN,
              features: Sequence[str] = SEQUENCE_FEATURES, context: Sequence[str] = CONTEXT_FEATURES,
              target: str = TARGET) -> DataFrame:
    """One sample per anchor row i of each group: ``seq`` = rows [i-past, i) of ``features``,
    ``ctx`` = ``context`` of row i, ``y`` = ``target`` of rows [i, i+future).

    Groups (``keys``) never mix, so no window crosses players or splits; NULL keys are
    dropped. The target is wrapped in a struct so an unfilled NULL keeps its slot.
    """
    base = df.where(F.col(keys[-1]).isNotNull())
    for k in keys[:-1]:
        base = base.where(F.col(k).isNotNull())
    item = F.struct(*[F.col(c) for c in features])
    target_item = F.struct(F.col(target).alias("v"))
    framed = over_rows(base, list(keys), list(order), {
        "seq": Frame(past, -1, lambda w: F.collect_list(item).over(w)),
        "y": Frame(0, future - 1, lambda w: F.collect_list(target_item).over(w)),
    })
    out = framed.select(*keys, *order, "seq", F.struct(*[F.col(c) for c in context]).alias("ctx"), "y")
    return out.where((F.size("seq") == past) & (F.size("y") == future)).withColumn(
        "y", F.transform("y", lambda s: s["v"]))


def sequence_counts(samples: DataFrame, split_col: str = "split") -> DataFrame:
    return samples.groupBy(split_col).agg(F.count(F.lit(1)).alias("samples"))


def profile(df: DataFrame, player_col: str = "player_name", season_col: str = "season") -> DataFrame:
    """Rows, distinct players and distinct seasons in one aggregation."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(player_col).alias("n_players"),
                  F.count_distinct(season_col).alias("n_seasons"))
