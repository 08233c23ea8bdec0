"""Registered queries for feature preparation and the forecaster (events as the player log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.functions.scalars import round_half_up
from goldleaf.operators import features as fe
from goldleaf.operators import forecast as fc
from goldleaf.operators import least_squares as ls
from goldleaf.plans import tpch_mapping as m
from goldleaf.plans.workload import register, rhu
from goldleaf.session import checkpoint_root, scratch_path

ORDER = ["kickoff_time", "event_id"]
KEYS = ["split", "player_name"]


def _k(d: str) -> str:
    return ("CAST(get_json_object(props, '$.k') AS INT)" if d == "spark"
            else "CAST(json_extract_string(props, '$.k') AS INT)")


def frame_exprs(d: str) -> list[tuple[str, str]]:
    """events -> fact-shaped rows: player = user, kickoff = ts, target = value (NULL on errors)."""
    k = _k(d)
    late = m.ts("2024-01-29 00:00:00", d)
    return [
        ("event_id", "event_id"),
        ("player_name", "CASE WHEN user_id % 37 = 0 THEN NULL ELSE 'U' || CAST(user_id AS STRING) END"),
        ("position", "CASE event_type WHEN 'click' THEN 'GK' WHEN 'view' THEN 'DEF' WHEN 'purchase' THEN 'MID' "
                     "WHEN 'signup' THEN 'FWD' END"),
        ("kickoff_time", "ts"),
        ("was_home", "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 2 = 0 END"),
        ("fixture_difficulty", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(1 + event_id % 5 AS INT) END"),
        ("total_points", "CASE WHEN event_type = 'error' THEN NULL ELSE value END"),
        ("goals_scored", f"{k} % 3"),
        ("assists", f"{k} % 2"),
        ("saves", f"CASE WHEN event_type = 'view' THEN NULL ELSE {k} % 4 END"),
        ("xG", "value / 10"),
        ("xA", f"CAST({k} AS DOUBLE) / 100"),
        ("xGI", f"(value + {k}) / 20"),
        ("xGC", "CAST(event_id % 7 AS DOUBLE) / 2"),
        ("influence", "value"),
        ("creativity", f"CAST({k} AS DOUBLE)"),
        ("threat", "CAST(user_id % 13 AS DOUBLE)"),
        ("ict_index", "value / 4"),
        ("minutes", "CAST(event_id % 91 AS INT)"),
        ("clean_sheets", "CAST(event_id % 2 AS INT)"),
        ("bonus", f"{k} % 4"),
        ("bps", f"{k} + CAST(event_id % 10 AS INT)"),
        ("yellow_cards", "CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END"),
        ("red_cards", f"CASE WHEN ts >= {late} AND event_id % 3 = 0 THEN 1 ELSE 0 END"),
        ("own_goals", "CASE WHEN user_id % 50 = 0 THEN 1 ELSE 0 END"),
        ("penalties_missed", f"CASE WHEN {k} = 0 THEN 1 END"),
    ]


def frame(spark, d):
    return m.load(spark, d, "events").select(*[F.expr(e).alias(n) for n, e in frame_exprs("spark")])


SCALED = fe.SEQUENCE_FEATURES + fe.CONTEXT_FEATURES + [fe.TARGET]


def prepared(spark, d):
    """Encoded, filled, split frame (rows with a split only) and the scaler parameters.

    The filled frame is stored once, so that the split, the scaler and the windows read its columns instead of the raw records.
    """
    path = scratch_path(spark, "encoded")
    fe.fill_defaults(fe.encode(frame(spark, d))).write.parquet(path)
    split, _ = fe.time_split(spark.read.parquet(path))
    split = split.where(F.col("split").isNotNull())
    params = fe.fit_minmax(split.where(F.col("split") == "train"), SCALED)
    return fe.apply_minmax(split, params), params


def samples(spark, d):
    scaled, params = prepared(spark, d)
    return fe.sequences(scaled, KEYS, ORDER), params


# ------------------------------------------------------------------ SQL twins

def _frame_sql() -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in frame_exprs("duckdb")) + " FROM events"


_ENC = ("SELECT * REPLACE (CAST(was_home AS INT) AS was_home, "
        "coalesce(CAST(fixture_difficulty AS DOUBLE), 3.0) AS fixture_difficulty), "
        + ", ".join(f"coalesce(CAST(position = '{p}' AS INT), 0) AS pos_{p}" for p in fe.POSITIONS) + " FROM fr")
_FILL = ("SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0) AS {c}" for c in fe.SEQUENCE_FEATURES + fe.CONTEXT_FEATURES)
         + ") FROM enc")
_SPLIT = ("SELECT *, CASE WHEN epoch_us(kickoff_time) <= (SELECT quantile_cont(epoch_us(kickoff_time), 0.8) "
          "FROM fill) THEN 'train' WHEN epoch_us(kickoff_time) > (SELECT quantile_cont(epoch_us(kickoff_time), 0.8) "
          "FROM fill) THEN 'test' END AS split FROM fill")
_STATS = ("SELECT " + ", ".join(f"min(CAST({c} AS DOUBLE)) AS min_{c}, max(CAST({c} AS DOUBLE)) AS max_{c}"
                                for c in SCALED) + " FROM sp WHERE split = 'train'")
_SCALED = ("SELECT sp.* REPLACE (" + ", ".join(
    f"(CAST(sp.{c} AS DOUBLE) - st.min_{c}) / coalesce(nullif(st.max_{c} - st.min_{c}, 0), 1) AS {c}" for c in SCALED)
    + ") FROM sp, st WHERE sp.split IS NOT NULL")

FEATURE_CTES = {"fr": _frame_sql(), "enc": _ENC, "fill": _FILL, "sp": _SPLIT, "st": _STATS, "sc": _SCALED}


def _with(body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in FEATURE_CTES.items()) + "\n" + body


def _with_more(more: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in {**FEATURE_CTES, **more}.items()) + "\n" + body


_G = "PARTITION BY split, player_name ORDER BY kickoff_time, event_id"
_X = [(t, f) for t in range(1, fe.PAST_LEN + 1) for f in fe.SEQUENCE_FEATURES]
_SEQ_SQL = _with(
    "SELECT split, player_name, kickoff_time, event_id, "
    + ", ".join(f"{rhu(f'x{t}_{f}', 9)} AS x{t}_{f}" for t, f in _X) + ", "
    + ", ".join(f"{rhu(c, 9)} AS {c}" for c in fe.CONTEXT_FEATURES) + ", "
    + ", ".join(f"{rhu(f'y{h}', 9)} AS y{h}" for h in range(1, fe.FUTURE_LEN + 1))
    + " FROM (SELECT split, player_name, kickoff_time, event_id, "
    + ", ".join(f"lag({f}, {fe.PAST_LEN + 1 - t}) OVER g AS x{t}_{f}" for t, f in _X) + ", "
    + ", ".join(fe.CONTEXT_FEATURES) + ", total_points AS y1, lead(total_points, 1) OVER g AS y2, "
    "lead(total_points, 2) OVER g AS y3, row_number() OVER g AS rn, count(*) OVER (PARTITION BY split, player_name) "
    f"AS cnt FROM sc WHERE player_name IS NOT NULL WINDOW g AS ({_G})) WHERE rn > {fe.PAST_LEN} "
    f"AND rn <= cnt - {fe.FUTURE_LEN - 1}")


# the same samples, not rounded
_SEQ_RAW_SQL = ("SELECT * FROM (SELECT split, kickoff_time, " + ", ".join(f"lag({f}, {fe.PAST_LEN + 1 - t}) OVER g AS x{t}_{f}" for t, f in _X) + ", "
                + ", ".join(fe.CONTEXT_FEATURES) + ", total_points AS y1, lead(total_points, 1) OVER g AS y2, lead(total_points, 2) OVER g AS y3, "
                "row_number() OVER g AS rn, count(*) OVER (PARTITION BY split, player_name) AS cnt FROM sc WHERE player_name IS NOT NULL "
                f"WINDOW g AS ({_G})) WHERE rn > {fe.PAST_LEN} AND rn <= cnt - {fe.FUTURE_LEN - 1}")


# ------------------------------------------------------------------ queries

@register("one_hot", _with("SELECT event_id, pos_GK, pos_DEF, pos_MID, pos_FWD, was_home, fixture_difficulty FROM enc"))
def q_one_hot(spark, d):
    """M1/M2: four fixed one-hot columns, flag to int, difficulty default 3."""
    return fe.encode(frame(spark, d)).select("event_id", *[f"pos_{p}" for p in fe.POSITIONS], "was_home",
                                            "fixture_difficulty")


@register("fill_defaults", _with(
    "SELECT event_id, " + ", ".join(fe.SEQUENCE_FEATURES + fe.CONTEXT_FEATURES) + ", total_points FROM fill"))
def q_fill_defaults(spark, d):
    """M3: NULL features -> 0, the target left NULL."""
    return fe.fill_defaults(fe.encode(frame(spark, d))).select(
        "event_id", *fe.SEQUENCE_FEATURES, *fe.CONTEXT_FEATURES, "total_points")


@register("time_split", _with("SELECT event_id, kickoff_time, split FROM sp"))
def q_time_split(spark, d):
    """Exact 0.8 time quantile (linear interpolation) as the train/test cutoff."""
    split, _ = fe.time_split(frame(spark, d))
    return split.select("event_id", "kickoff_time", "split")


@register("minmax_scale", _with(
    "SELECT event_id, split, " + ", ".join(f"{rhu(c, 9)} AS {c}" for c in SCALED) + " FROM sc"))
def q_minmax_scale(spark, d):
    """Min-max fitted on train only, applied to both splits without clipping."""
    scaled, _ = prepared(spark, d)
    return scaled.select("event_id", "split", *[round_half_up(c, 9).alias(c) for c in SCALED])


@register("sequence_windows", _SEQ_SQL)
def q_sequence_windows(spark, d):
    """5-row look-back and 3-row horizon per (split, player), flattened."""
    s, _ = samples(spark, d)
    flat = fc.flatten_samples(s, KEYS + ORDER)
    return flat.select(*[round_half_up(c, 9).alias(c) if c not in KEYS + ORDER else F.col(c) for c in flat.columns])


@register("sequence_counts", _with(
    f"SELECT split, count(*) AS samples FROM (SELECT split, row_number() OVER g AS rn, count(*) OVER "
    f"(PARTITION BY split, player_name) AS cnt FROM sc WHERE player_name IS NOT NULL WINDOW g AS ({_G})) "
    f"WHERE rn > {fe.PAST_LEN} AND rn <= cnt - {fe.FUTURE_LEN - 1} GROUP BY split"))
def q_sequence_counts(spark, d):
    """M7: samples per split."""
    s, _ = samples(spark, d)
    return fe.sequence_counts(s)


@register("forecast_metrics")
def q_forecast_metrics(spark, d):
    """Per-step linear forecaster fitted on train, MAE/MSE on the held-out split.

    No SQL oracle: model fitting is iterative (checked by rows and by pytest)."""
    s, params = samples(spark, d)
    # Iterative fitting reads the samples several times: materialize them once in the shared
    # checkpoint folder instead of recomputing split, scaling and windows for every pass.
    checkpoint_root(spark)
    flat = fc.flatten_samples(s, KEYS + ORDER).checkpoint(eager=True)
    assembler, models = fc.fit_forecast(flat.where(F.col("split") == "train"))
    lo, hi = params[fe.TARGET]
    scored = fc.forecast(assembler, models, flat.where(F.col("split") == "test"))
    return fc.metrics(scored, target_range=(hi - lo) if hi is not None and hi != lo else 1.0)


#: Inputs of the small forecaster: form (mean influence of the last rows), minutes (mean), home flag.
_FORM_INPUTS = ("form", "minutes", "was_home")


def _form_frame(spark, d):
    """Samples with the three inputs and the targets, stored: fits and scores read them again for every step."""
    s, _ = samples(spark, d)
    mean = lambda f: (sum((F.col("seq")[t][f] for t in range(1, fe.PAST_LEN)), F.col("seq")[0][f]) / fe.PAST_LEN).alias
    checkpoint_root(spark)
    return s.select("split", "kickoff_time", mean("influence")("form"), mean("minutes")("minutes"), F.col("ctx.was_home").cast("double").alias("was_home"),
                    *[F.col("y")[h - 1].alias(f"y{h}") for h in range(1, fe.FUTURE_LEN + 1)]).checkpoint(eager=True)


def _cov(a: str, b: str) -> str:
    return f"covar_pop({a}, {b})"


def _det(m) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d}) * ({i}) - ({f}) * ({g})) + ({c}) * (({d}) * ({h}) - ({e}) * ({g})))"


def _step_sql(h: int) -> str:
    """Least squares of three inputs by Cramer's rule on covariances, and the errors on the test split."""
    a = [[f"s{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    w = [f"{_det([[f't{i}' if j == k else a[i][j] for j in range(3)] for i in range(3)])} / {_det(a)}" for k in range(3)]
    sums = ", ".join(f"{_cov(_FORM_INPUTS[i], _FORM_INPUTS[j])} AS s{i}{j}" for i in range(3) for j in range(i, 3))
    cross = ", ".join(f"{_cov(x, f'y{h}')} AS t{i}" for i, x in enumerate(_FORM_INPUTS))
    means = ", ".join(f"avg({x}) AS m{i}" for i, x in enumerate(_FORM_INPUTS))
    rows = f"{' AND '.join(f'{x} IS NOT NULL' for x in _FORM_INPUTS)} AND y{h} IS NOT NULL"
    return (f"SELECT {h} AS step, n_train, count(err) AS n_test, {rhu('intercept', 6)} AS intercept, {rhu('w0', 6)} AS w_form, {rhu('w1', 6)} AS w_minutes, "
            f"{rhu('w2', 6)} AS w_home, {rhu('avg(abs(err))', 6)} AS mae, {rhu('avg(err * err)', 6)} AS mse FROM ("
            f"SELECT f.*, y{h} - (intercept + w0 * form + w1 * minutes + w2 * was_home) AS err FROM ("
            f"SELECT *, my - w0 * m0 - w1 * m1 - w2 * m2 AS intercept FROM (SELECT *, {w[0]} AS w0, {w[1]} AS w1, {w[2]} AS w2 FROM ("
            f"SELECT count(*) AS n_train, {sums}, {cross}, {means}, avg(y{h}) AS my FROM z WHERE split = 'train' AND {rows}))) f, z "
            "WHERE z.split = 'test') GROUP BY n_train, intercept, w0, w1, w2")


_Z_SQL = ("SELECT split, kickoff_time, (" + " + ".join(f"x{t}_influence" for t in range(1, fe.PAST_LEN + 1)) + f") / {fe.PAST_LEN} AS form, ("
          + " + ".join(f"x{t}_minutes" for t in range(1, fe.PAST_LEN + 1)) + f") / {fe.PAST_LEN} AS minutes, CAST(was_home AS DOUBLE) AS was_home, y1, y2, y3 FROM "
          f"({_SEQ_RAW_SQL})")


@register("forecast_eval", _with_more({"z": _Z_SQL}, " UNION ALL ".join(_step_sql(h) for h in range(1, fe.FUTURE_LEN + 1))))
def q_forecast_eval(spark, d):
    """Least squares per horizon step from one Gram matrix of the training split; coefficients, and MAE and MSE on the held-out split."""
    z, out = _form_frame(spark, d), None
    train, test = z.where(F.col("split") == "train"), z.where(F.col("split") == "test")
    for h in range(1, fe.FUTURE_LEN + 1):
        fit = ls.fit_linear(train, _FORM_INPUTS, f"y{h}")
        if fit is None:
            continue
        found = [F.lit(h).alias("step"), F.lit(fit.n).cast("long").alias("n_train"), F.col("n").alias("n_test")]
        found += [round_half_up(F.lit(v), 6).alias(c) for c, v in zip(("intercept", "w_form", "w_minutes", "w_home"), (fit.intercept, *fit.weights))]
        one = ls.errors(test, f"y{h}", fit.predicted()).select(*found, round_half_up("mae", 6).alias("mae"), round_half_up("mse", 6).alias("mse"))
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "step int, n_train long, n_test long, intercept double, w_form double, w_minutes double, w_home double, mae double, mse double")


@register("forecast_early_stop")
def q_forecast_early_stop(spark, d):
    """M8: boosted trees for the next step, fitted on the earlier four fifths of the training split, stopped by the later fifth, scored on the test
    split that neither saw. No SQL: trees are fitted in rounds (checked by tests)."""
    z = _form_frame(spark, d)
    cut = fe.exact_quantile(z.where(F.col("split") == "train"), F.unix_micros(F.col("kickoff_time").cast("timestamp")), 0.8)
    later = F.unix_micros(F.col("kickoff_time").cast("timestamp")) > F.lit(cut)
    model = ls.fit_boosted(z.where(F.col("split") == "train"), _FORM_INPUTS, "y1", later, max_rounds=20)
    scored = ls.apply_boosted(model, z.where(F.col("split") == "test"), _FORM_INPUTS, "p1")
    return ls.errors(scored, "y1", F.col("p1")).select(F.lit(model.getNumTrees).cast("int").alias("rounds"), "n", "mae", "mse")
