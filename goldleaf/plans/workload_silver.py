"""Registered queries for expectations, keyed change capture and silver projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.operators import cdc, silver
from goldleaf.operators.quality import Expectation, apply_expectations, expectation_report
from goldleaf.plans import tpch_mapping as m
from goldleaf.plans.workload import register, with_ctes
from goldleaf.sources.landing import nest

# ------------------------------------------------------------------ expectations

GAMEWEEK_WARN = Expectation("valid_gameweek", "gameweek BETWEEN 1 AND 38", "warn")
STACKED = [*m.PERFORMANCE_RULES, GAMEWEEK_WARN]


def _report_sql(rules) -> str:
    drops = " AND ".join(f"coalesce({r.predicate}, false)" for r in rules if r.action == "drop") or "true"
    parts = [
        f"SELECT '{r.name}' AS rule, '{r.action}' AS action, "
        f"CAST(count_if(NOT coalesce({r.predicate}, false)) AS BIGINT) AS failed, "
        f"count(*) AS total, CAST(count_if({drops}) AS BIGINT) AS kept FROM perf_checks"
        for r in rules
    ]
    return with_ctes(" UNION ALL ".join(parts))


@register("expect_warn_report", _report_sql([GAMEWEEK_WARN]))
def q_expect_warn_report(spark, d):
    """B1: warn-only rule: rows kept, violations counted (a NULL predicate counts as failed)."""
    return expectation_report(m.performance_checks(spark, d), [GAMEWEEK_WARN])


@register("expect_or_drop", with_ctes(
    "SELECT * FROM perf_checks WHERE coalesce(player_id IS NOT NULL, false) AND coalesce(fixture_id IS NOT NULL, false) "
    "AND coalesce(minutes >= 0 AND minutes <= 120, false)"))
def q_expect_or_drop(spark, d):
    """The three performance drop rules ANDed into one filter."""
    return apply_expectations(m.performance_checks(spark, d), m.PERFORMANCE_RULES)


@register("expect_stacked_report", _report_sql(STACKED))
def q_expect_stacked_report(spark, d):
    """Stacked warn + drop rules, each counted by name in one aggregation pass."""
    return expectation_report(m.performance_checks(spark, d), STACKED)


# ------------------------------------------------------------------ change data capture

EVENT_CHANGES = ("SELECT user_id, ts, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, "
                 "CASE WHEN event_type = 'signup' THEN NULL ELSE props END AS props, event_id FROM events")
EVENT_COLS = ["ts", "event_type", "value", "props", "event_id"]


def event_changes(spark, d):
    """events as a change feed keyed by user: ``value`` NULL on errors, ``props`` NULL on signups."""
    return m.load(spark, d, "events").select(
        "user_id", "ts", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "signup", F.col("props")).alias("props"),
        "event_id")


_IGNORE_NULLS_SQL = with_ctes(
    "SELECT user_id, " + ", ".join(f"arg_max({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in EVENT_COLS)
    + " FROM ch GROUP BY user_id", {"ch": EVENT_CHANGES})


@register("scd1_overwrite", with_ctes(
    "SELECT user_id, ts, event_type, value, props, event_id FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id ORDER BY ts DESC) AS rn FROM ch) WHERE rn = 1", {"ch": EVENT_CHANGES}))
def q_scd1_overwrite(spark, d):
    """Latest change per key wins whole; its NULLs overwrite."""
    return cdc.scd1(event_changes(spark, d), ["user_id"], "ts", ignore_null_updates=False)


@register("scd1_ignore_nulls", _IGNORE_NULLS_SQL)
def q_scd1_ignore_nulls(spark, d):
    """Per key and per column the latest non-NULL value wins."""
    return cdc.scd1(event_changes(spark, d), ["user_id"], "ts", ignore_null_updates=True)


LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@register("scd1_composite_key", with_ctes(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1"))
def q_scd1_composite_key(spark, d):
    """Two-column key (order, line number), sequence by (ship date, part, supplier, price)."""
    li = m.load(spark, d, "lineitem")
    return cdc.scd1(li, ["l_orderkey", "l_linenumber"], LINE_SEQ, ignore_null_updates=False).select(*li.columns)


@register("scd1_out_of_order", _IGNORE_NULLS_SQL)
def q_scd1_out_of_order(spark, d):
    """C4: changes arrive newest batch first; folding batches into the state still gives
    the order-free result (per-column sequences are kept in the state)."""
    ch = event_changes(spark, d)
    day = F.dayofmonth("ts")
    arrivals = [ch.where(day >= 20), ch.where((day >= 10) & (day < 20)), ch.where(day < 10)]
    state = cdc.scd1_state(arrivals[0], ["user_id"], "ts", ignore_null_updates=True)
    for batch in arrivals[1:]:
        state = cdc.scd1_merge(state, batch, ["user_id"], "ts", ignore_null_updates=True)
    return cdc.current(state)


# ------------------------------------------------------------------ silver projections

def element_documents(spark, d):
    """One element-summary-like document per order: ``history`` = its lines (NULL when none)."""
    lines = m.load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("element_id"),
        F.col("l_linenumber"),
        F.col("l_suppkey").alias("element"),
        F.col("l_orderkey").alias("fixture"),
        (F.col("l_partkey") % 25).alias("opponent_team"),
        F.col("l_linenumber").alias("total_points"),
        (F.col("l_returnflag") == "R").alias("was_home"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("kickoff_time"),
        F.month("l_shipdate").alias("round"),
        F.col("l_quantity").cast("int").alias("minutes"),
        F.col("l_discount").cast("string").alias("influence"),
        F.col("l_tax").cast("string").alias("expected_goals"),
        (F.col("l_quantity").cast("int") + 40).alias("value"),
    )
    orders = m.load(spark, d, "orders").select(F.col("o_orderkey").alias("element_id"))
    return nest(orders, lines, ["element_id"], "history", order_by=["l_linenumber"])


EXPLODE_COLS = ["player_id", "fixture_id", "opponent_team_id", "total_points", "was_home", "kickoff_time",
                "gameweek", "minutes", "influence", "expected_goals", "value", "tackles"]


@register("explode_history", with_ctes(
    "SELECT l_suppkey AS player_id, l_orderkey AS fixture_id, l_partkey % 25 AS opponent_team_id, "
    "l_linenumber AS total_points, l_returnflag = 'R' AS was_home, l_shipdate AS kickoff_time, "
    "CAST(month(l_shipdate) AS INT) AS gameweek, CAST(l_quantity AS INT) AS minutes, l_discount AS influence, "
    "l_tax AS expected_goals, CAST(l_quantity AS INT) + 40 AS value, CAST(NULL AS INTEGER) AS tackles "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey"))
def q_explode_history(spark, d):
    """Nested documents exploded (NULL arrays vanish), nested fields cast and renamed;
    fields absent from the payload come out as typed NULLs."""
    perf = silver.performances(element_documents(spark, d))
    return perf.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "kickoff_time" else F.col(c)
                         for c in EXPLODE_COLS])


def fixture_feed(spark, d):
    """Orders as a fixture feed with every field as text, including dirty values."""
    o = m.load(spark, d, "orders")
    k, c, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    txt = lambda e: e.cast("string")
    return o.select(
        txt(k).alias("id"),
        txt(F.month("o_orderdate")).alias("event"),
        F.when(k % 29 == 0, F.lit("TBD")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("kickoff_time"),
        txt(c % 25).alias("team_h"), txt(k % 25).alias("team_a"),
        F.when(st == "F", txt(k % 4)).otherwise(F.lit("None")).alias("team_h_score"),
        F.when(st == "F", txt(c % 3)).otherwise(F.lit("None")).alias("team_a_score"),
        txt(c % 5 + 1).alias("team_h_difficulty"), txt(k % 5 + 1).alias("team_a_difficulty"),
        F.when(st == "F", F.lit("true")).when(st == "O", F.lit("false")).alias("finished"),
    )


@register("typed_projection", with_ctes(
    "SELECT o_orderkey AS fixture_id, CAST(month(o_orderdate) AS INT) AS gameweek, "
    "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate END AS kickoff_time, "
    "o_custkey % 25 AS home_team_id, o_orderkey % 25 AS away_team_id, "
    "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 4 AS INT) END AS home_score, "
    "CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 3 AS INT) END AS away_score, "
    "CAST(o_custkey % 5 + 1 AS INT) AS home_difficulty, CAST(o_orderkey % 5 + 1 AS INT) AS away_difficulty, "
    "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS finished FROM orders"))
def q_typed_projection(spark, d):
    """Flat text feed -> typed silver fixtures; dirty text ('None', 'TBD') becomes NULL."""
    fx = silver.fixtures(fixture_feed(spark, d))
    return fx.withColumn("kickoff_time", F.col("kickoff_time").cast("timestamp_ntz"))
