"""Mapping of the star-schema test tables onto the football data model.

There is no football data in the test tables, so each reference concept is played
by a star-schema table (SURVEY section 7.2):

* team            <- ``nation``
* player          <- ``customer`` (namesakes: keys 10k and 10k+1 share a name;
                     NULL first names, unknown teams and an unmapped position code)
* fixture         <- ``orders``, the gameweek counts months since 1995, teams 1..24
                     (team 0 never plays), difficulty from key residues
* performance     <- ``lineitem`` summed per order (left join: orders without lines
                     keep NULL stats), the current season is played from 2001-01-01 to 2001-05-01
* historical rows <- orders before 2001 with the customer's name, one season per year

Each expression is SQL text that Spark SQL and DuckDB evaluate identically, so the
Spark side and the SQL oracle start from the same rows; the operators under test
(joins, windows, CDC, aggregation, features) are implemented separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators import cdc, quality, silver

# Fixed values of the mapping.
CURRENT_SEASON = "2001-02"
SEASON_START = "2001-01-01 00:00:00"
PLAYED_BEFORE = "2001-05-01 00:00:00"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def ts(literal: str, dialect: str) -> str:
    return f"TIMESTAMP_NTZ '{literal}'" if dialect == "spark" else f"TIMESTAMP '{literal}'"


_READERS: dict = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table reader, resolved once per session and path (file listing and footer
    reads are not repeated for every query built on the same table)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


# ------------------------------------------------------------------ expressions
# Conditional counts are written sum(CASE ...) rather than count_if: count_if expands into
# generated common-expression names that differ per use, which keeps the two fact branches'
# identical per-order aggregations from being recognised as one reusable shuffle.

STATS = [
    ("total_points", "CAST(sum(l_linenumber) AS INT)"),
    ("minutes_raw", "CAST(sum(l_quantity) AS INT)"),
    ("goals_scored", "CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT)"),
    ("assists", "CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INT)"),
    ("clean_sheets", "CAST(min(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS INT)"),
    ("goals_conceded", "CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS INT)"),
    ("own_goals", "CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS INT)"),
    ("penalties_saved", "CAST(sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS INT)"),
    ("penalties_missed", "CAST(sum(CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END) AS INT)"),
    ("yellow_cards", "CAST(sum(CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END) AS INT)"),
    ("red_cards", "CAST(sum(CASE WHEN l_quantity < 2 THEN 1 ELSE 0 END) AS INT)"),
    ("saves", "CAST(count(*) AS INT)"),
    ("bonus", "CAST(max(l_linenumber) % 4 AS INT)"),
    ("bps", "CAST(sum(l_linenumber * 3) AS INT)"),
    ("influence", "CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS INT)) AS DOUBLE) / 10"),
    ("creativity", "CAST(sum(CAST(floor(l_tax * 100 + 0.5) AS INT)) AS DOUBLE) / 10"),
    ("threat", "CAST(sum(CAST(l_quantity AS INT)) AS DOUBLE) / 4"),
    ("ict_index", "CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS INT) + CAST(floor(l_tax * 100 + 0.5) AS INT)"
                  " + CAST(l_quantity AS INT)) AS DOUBLE) / 100"),
    ("expected_goals", "CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS INT)) AS DOUBLE) / 100"),
    ("expected_assists", "CAST(sum(CAST(floor(l_tax * 100 + 0.5) AS INT)) AS DOUBLE) / 100"),
    ("expected_goal_involvements", "CAST(sum(CAST(floor(l_discount * 100 + 0.5) AS INT)"
                                   " + CAST(floor(l_tax * 100 + 0.5) AS INT)) AS DOUBLE) / 100"),
    ("expected_goals_conceded", "CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) / 4"),
    ("selected", "CAST(sum(l_suppkey) AS INT)"),
    ("transfers_in", "CAST(sum(l_partkey % 100) AS INT)"),
    ("transfers_out", "CAST(sum(l_suppkey % 50) AS INT)"),
    ("clearances_blocks_interceptions", "CAST(sum(l_linenumber % 3) AS INT)"),
    ("recoveries", "CAST(sum(l_partkey % 7) AS INT)"),
    ("tackles", "CAST(sum(l_suppkey % 5) AS INT)"),
    ("last_ship", "max(l_shipdate)"),
]

TEAM = [
    ("team_id", "CAST(n_nationkey AS BIGINT)"),
    ("name", "n_name"),
    ("short_name", "'N' || lpad(CAST(n_nationkey AS STRING), 2, '0')"),
    ("strength", "CAST(n_regionkey + 1 AS INT)"),
    ("strength_overall_home", "CAST(1000 + 10 * n_nationkey AS INT)"),
    ("strength_overall_away", "CAST(1005 + 10 * n_nationkey AS INT)"),
    ("strength_attack_home", "CAST(1100 + n_nationkey AS INT)"),
    ("strength_attack_away", "CAST(1150 + n_nationkey AS INT)"),
    ("strength_defence_home", "CAST(1200 + n_nationkey AS INT)"),
    ("strength_defence_away", "CAST(1250 + n_nationkey AS INT)"),
]

POSITION_ID = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 "
               "WHEN 'FURNITURE' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE 5 END")
FIRST_NAME = "CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE split_part(c_name, '#', 1) END"
SECOND_NAME = "CAST(CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS STRING)"

PLAYER = [
    ("player_id", "c_custkey"),
    ("first_name", FIRST_NAME),
    ("second_name", SECOND_NAME),
    ("team_id", "CASE WHEN c_custkey % 53 = 0 THEN CAST(c_nationkey + 100 AS BIGINT) "
                "ELSE CAST(c_nationkey AS BIGINT) END"),
    ("position_id", POSITION_ID),
    ("current_price", "CAST(40 + CAST(floor(abs(c_acctbal)) AS BIGINT) % 100 AS DOUBLE)"),
    ("web_name", "c_name"),
]

GAMEWEEK = "CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INT)"
FIXTURE = [
    ("fixture_id", "o_orderkey"),
    ("gameweek", GAMEWEEK),
    ("kickoff_time", "o_orderdate"),
    ("home_team_id", "1 + o_custkey % 24"),
    ("away_team_id", "CASE WHEN o_orderkey % 41 = 0 THEN CAST(99 AS BIGINT) ELSE 1 + o_orderkey % 24 END"),
    ("home_score", "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 4 AS INT) END"),
    ("away_score", "CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 3 AS INT) END"),
    ("home_difficulty", "CAST(1 + o_custkey % 5 AS INT)"),
    ("away_difficulty", "CAST(1 + o_orderkey % 5 AS INT)"),
    ("finished", "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END"),
]


WAS_HOME = "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END"
MINUTES = ("CASE WHEN o_orderkey % 7 = 0 THEN 0 WHEN s.l_orderkey IS NULL THEN 90 "
           "ELSE s.minutes_raw % 125 END")
VALUE = "CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(40 + o_orderkey % 90 AS INT) END"
_PASS_STATS = ["goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
               "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", "bps"]

PERFORMANCE = (
    [("player_id", "o_custkey"), ("fixture_id", "o_orderkey"), ("opponent_team_id", "o_orderkey % 25"),
     ("total_points", "s.total_points"), ("was_home", WAS_HOME), ("kickoff_time", "s.last_ship"),
     ("team_h_score", "CAST(o_orderkey % 4 AS INT)"), ("team_a_score", "CAST(o_custkey % 3 AS INT)"),
     ("gameweek", GAMEWEEK), ("minutes", MINUTES)]
    + [(c, f"s.{c}") for c in _PASS_STATS]
    + [(c, f"s.{c}") for c in ["influence", "creativity", "threat", "ict_index"]]
    + [("starts", f"CASE WHEN ({MINUTES}) > 0 THEN 1 ELSE 0 END")]
    + [(c, f"s.{c}") for c in ["expected_goals", "expected_assists", "expected_goal_involvements",
                               "expected_goals_conceded"]]
    + [("value", VALUE), ("transfers_balance", "s.transfers_in - s.transfers_out"),
       ("selected", "s.selected"), ("transfers_in", "s.transfers_in"), ("transfers_out", "s.transfers_out"),
       ("clearances_blocks_interceptions", "s.clearances_blocks_interceptions"),
       ("recoveries", "s.recoveries"), ("tackles", "s.tackles")]
)


def performance_filter(d: str) -> str:
    return f"o_orderdate >= {ts(SEASON_START, d)} AND o_orderdate < {ts(PLAYED_BEFORE, d)}"


# Raw performance rows over all orders, before the silver rules (for the expectation keys).
PERFORMANCE_CHECKS = [
    ("player_id", "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END"),
    ("fixture_id", "o_orderkey"),
    ("gameweek", GAMEWEEK),
    ("minutes", "CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE s.minutes_raw END"),
]

HIST_NAME = f"({FIRST_NAME}) || ' ' || ({SECOND_NAME})"
HISTORICAL_RAW = (
    [("name", HIST_NAME),
     ("position", f"CASE {POSITION_ID} WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' END"),
     ("team", "'NATION_' || CAST((c_nationkey + year(o_orderdate) - 1995) % 25 AS STRING)"),
     ("season", "CAST(year(o_orderdate) AS STRING) || '-' || "
                "lpad(CAST((year(o_orderdate) + 1) % 100 AS STRING), 2, '0')"),
     ("round", "CAST(month(o_orderdate) AS INT)"), ("opponent_team", "o_orderkey % 25"),
     ("was_home", WAS_HOME), ("kickoff_time", "o_orderdate"), ("total_points", "s.total_points"),
     ("minutes", MINUTES)]
    + [(c, f"s.{c}") for c in _PASS_STATS]
    + [(c, f"s.{c}") for c in ["influence", "creativity", "threat", "ict_index", "expected_goals",
                               "expected_assists", "expected_goal_involvements", "expected_goals_conceded"]]
    + [("value", VALUE), ("selected", "s.selected"), ("transfers_in", "s.transfers_in"),
       ("transfers_out", "s.transfers_out"), ("_tie", "o_orderkey")]
)


def historical_filter(d: str) -> str:
    return f"o_orderdate < {ts(SEASON_START, d)}"


HISTORICAL_KEYS = ["player_name", "season", "gameweek"]
HISTORICAL_SEQUENCE = ["kickoff_time", "_tie"]
# Rules of the historical and performance feeds.
HISTORICAL_RULES = [
    quality.Expectation("valid_player_name", "player_name IS NOT NULL", "drop"),
    quality.Expectation("valid_season", "season IS NOT NULL", "drop"),
    quality.Expectation("valid_gameweek", "gameweek BETWEEN 1 AND 38", "drop"),
]
PERFORMANCE_RULES = [
    quality.Expectation("valid_player", "player_id IS NOT NULL", "drop"),
    quality.Expectation("valid_fixture", "fixture_id IS NOT NULL", "drop"),
    quality.Expectation("valid_minutes", "minutes >= 0 AND minutes <= 120", "drop"),
]


def _sel(pairs) -> list[str]:
    return [f"{e} AS {n}" for n, e in pairs]


# ------------------------------------------------------------------ Spark side

def order_stats(spark: SparkSession, d: str, orders: DataFrame | None = None) -> DataFrame:
    """Per-order line statistics (partial aggregation, then one shuffle by order key), of the given
    orders only where some are given (lines of other orders are dropped before they are summed)."""
    lines = load(spark, d, "lineitem")
    if orders is not None:
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return lines.groupBy("l_orderkey").agg(*[F.expr(e) for e in _sel(STATS)])


def silver_team(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "nation").selectExpr(*_sel(TEAM))


def silver_player(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").selectExpr(*_sel(PLAYER))


def silver_fixture(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").selectExpr(*_sel(FIXTURE))


def _orders_with_stats(spark: SparkSession, d: str, where: str, stats: DataFrame | None = None) -> DataFrame:
    o = load(spark, d, "orders").where(F.expr(where)).alias("o")
    s = (stats if stats is not None else order_stats(spark, d, o.select("o_orderkey"))).alias("s")
    return o.join(s, F.col("s.l_orderkey") == F.col("o.o_orderkey"), "left")


def silver_performance(spark: SparkSession, d: str, stats: DataFrame | None = None) -> DataFrame:
    """Current-season performance rows, after the silver drop rules."""
    rows = _orders_with_stats(spark, d, performance_filter("spark"), stats).selectExpr(*_sel(PERFORMANCE))
    return quality.apply_expectations(rows, PERFORMANCE_RULES)


def performance_checks(spark: SparkSession, d: str) -> DataFrame:
    """Raw performance rows over every order, before any rule."""
    o = load(spark, d, "orders").alias("o")
    s = order_stats(spark, d).alias("s")
    return o.join(s, F.col("s.l_orderkey") == F.col("o.o_orderkey"), "left").selectExpr(*_sel(PERFORMANCE_CHECKS))


def historical_raw(spark: SparkSession, d: str, stats: DataFrame | None = None) -> DataFrame:
    """CSV-shaped historical rows: orders before the season with their customer's name."""
    o = load(spark, d, "orders").where(F.expr(historical_filter("spark"))).alias("o")
    c = load(spark, d, "customer").alias("c")
    s = (stats if stats is not None else order_stats(spark, d)).alias("s")
    return (o.join(c, F.col("c.c_custkey") == F.col("o.o_custkey"), "inner")
            .join(s, F.col("s.l_orderkey") == F.col("o.o_orderkey"), "left")
            .selectExpr(*_sel(HISTORICAL_RAW)))


def silver_historical(spark: SparkSession, d: str, raw: DataFrame | None = None,
                      stats: DataFrame | None = None) -> DataFrame:
    """Typed historical rows -> drop rules -> SCD-1 on (player_name, season, gameweek)."""
    typed = silver.historical(raw if raw is not None else historical_raw(spark, d, stats), passthrough=["_tie"])
    typed = typed.withColumn("_tie", F.col("_tie").cast("long"))  # a CSV round trip may infer int
    kept = quality.apply_expectations(typed, HISTORICAL_RULES)
    # The source tag is a constant: re-attach it after the reduction so it stays a literal
    # and a filter on data_source prunes this branch of the gold union at plan time.
    current = cdc.scd1(kept.drop("data_source"), HISTORICAL_KEYS, HISTORICAL_SEQUENCE, ignore_null_updates=False)
    return current.select(*[F.lit(silver.HISTORICAL_SOURCE_TAG).alias(c) if c == "data_source" else F.col(c) for c in typed.columns])


# ------------------------------------------------------------------ SQL side

def _cols(pairs) -> str:
    return ",\n    ".join(f"{e} AS {n}" for n, e in pairs)


HIST_TYPED = (
    "name AS player_name, position, team, season, round AS gameweek, opponent_team AS opponent_team_id, "
    "was_home, kickoff_time, total_points, minutes, goals_scored, assists, clean_sheets, goals_conceded, "
    "own_goals, penalties_saved, penalties_missed, yellow_cards, red_cards, saves, bonus, bps, influence, "
    "creativity, threat, ict_index, expected_goals, expected_assists, expected_goal_involvements, "
    "expected_goals_conceded, CAST(value AS DOUBLE) / 10.0 AS price_m, selected, transfers_in, transfers_out, "
    f"'{silver.HISTORICAL_SOURCE_TAG}' AS data_source, _tie"
)


def oracle_ctes() -> dict[str, str]:
    """DuckDB CTE bodies for the mapped silver datasets (dependency order)."""
    d = "duckdb"
    return {
        "stats": f"SELECT l_orderkey, {_cols(STATS)} FROM lineitem GROUP BY l_orderkey",
        "s_team": f"SELECT {_cols(TEAM)} FROM nation",
        "s_player": f"SELECT {_cols(PLAYER)} FROM customer",
        "s_fixture": f"SELECT {_cols(FIXTURE)} FROM orders",
        "s_perf": (f"SELECT * FROM (SELECT {_cols(PERFORMANCE)} FROM orders o LEFT JOIN stats s "
                   f"ON s.l_orderkey = o.o_orderkey WHERE {performance_filter(d)}) "
                   "WHERE player_id IS NOT NULL AND fixture_id IS NOT NULL "
                   "AND coalesce(minutes >= 0 AND minutes <= 120, false)"),
        "perf_checks": (f"SELECT {_cols(PERFORMANCE_CHECKS)} FROM orders o LEFT JOIN stats s "
                        "ON s.l_orderkey = o.o_orderkey"),
        "h_raw": (f"SELECT {_cols(HISTORICAL_RAW)} FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey "
                  f"LEFT JOIN stats s ON s.l_orderkey = o.o_orderkey WHERE {historical_filter(d)}"),
        "s_hist": (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY player_name, season, "
                   f"gameweek ORDER BY kickoff_time DESC, _tie DESC) AS rn FROM (SELECT {HIST_TYPED} FROM h_raw) "
                   "WHERE player_name IS NOT NULL AND season IS NOT NULL "
                   "AND coalesce(gameweek BETWEEN 1 AND 38, false)) WHERE rn = 1"),
    }
