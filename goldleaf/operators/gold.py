"""Gold layer: enriched dimensions, the unified performance fact, season totals
and the scout (recommendation) view.

Inputs are silver-shaped DataFrames (see ``goldleaf.operators.silver``). Nothing
here collects data to the driver; joins against dimensions carry no hint (Spark's size
estimates and AQE choose), and aggregations are pre-combined before any fan-out join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.scalars import (
    full_name,
    position_label,
    round_half_up,
    safe_divide,
    tenths_to_units,
)
from goldleaf.operators.silver import CURRENT_SOURCE_TAG
from goldleaf.operators.windows import Frame, over_rows
from goldleaf.plans.joins import bounded_broadcast, one_row
from goldleaf.session import scratch_path

# The column lists and renamings of the published tables.
TEAM_COLUMNS = [
    "team_id", "name", "short_name", "strength",
    "strength_overall_home", "strength_overall_away",
    "strength_attack_home", "strength_attack_away",
    "strength_defence_home", "strength_defence_away",
]

# The 34 columns both branches of the unified fact carry, in order.
FACT_BASE_COLUMNS = [
    "player_name", "position", "team_name", "was_home", "season", "gameweek", "kickoff_time",
    "total_points", "minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "own_goals", "penalties_missed", "penalties_saved", "yellow_cards", "red_cards", "saves",
    "bonus", "bps", "xG", "xA", "xGI", "xGC", "influence", "creativity", "threat", "ict_index",
    "price_m", "selected", "transfers_balance", "fixture_difficulty", "data_source",
]
FACT_DERIVED_COLUMNS = [
    "rolling_5gw_pts", "rolling_5gw_xG", "rolling_5gw_xA",
    "season_total_pts", "points_per_million", "points_per_90",
]
# Unique tie-breaker carried next to the fact columns: the fixture id for API rows,
# a caller-supplied id (or NULL) for historical rows.
MATCH_ID = "match_id"

_SHARED_STATS = [
    "total_points", "minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "own_goals", "penalties_missed", "penalties_saved", "yellow_cards", "red_cards", "saves",
    "bonus", "bps",
]
_RENAMED = [("expected_goals", "xG"), ("expected_assists", "xA"),
            ("expected_goal_involvements", "xGI"), ("expected_goals_conceded", "xGC")]


def gold_dim_team(team: DataFrame) -> DataFrame:
    """Team dimension: all strength metrics, lineage column dropped."""
    return team.select(*TEAM_COLUMNS)


def gold_dim_player(player: DataFrame, team: DataFrame) -> DataFrame:
    """Player dimension with full name, team names, position label and price in units.

    Inner join: players whose team is unknown are left out.
    """
    t = team.select("team_id", F.col("name").alias("team_name"), F.col("short_name").alias("team_short"))
    p = player.alias("p")
    return p.join(t.alias("t"), F.col("p.team_id") == F.col("t.team_id"), "inner").select(
        F.col("p.player_id"),
        F.col("p.first_name"),
        F.col("p.second_name"),
        full_name("p.first_name", "p.second_name").alias("full_name"),
        F.col("p.web_name"),
        F.col("t.team_name"),
        F.col("t.team_short"),
        position_label("p.position_id").alias("position"),
        tenths_to_units("p.current_price").alias("price_m"),
        F.col("p.team_id"),
        F.col("p.position_id"),
    )


def gold_dim_fixture(fixture: DataFrame, team: DataFrame) -> DataFrame:
    """Fixture dimension with both team names; a missing team gives a NULL name (role-playing left joins)."""
    names = team.select("team_id", "name")
    f = fixture.alias("f")
    ht = names.alias("ht")
    at = names.alias("at")
    return (
        f.join(ht, F.col("f.home_team_id") == F.col("ht.team_id"), "left")
        .join(at, F.col("f.away_team_id") == F.col("at.team_id"), "left")
        .select(
            "f.fixture_id", "f.gameweek", "f.kickoff_time", "f.home_team_id", "f.away_team_id",
            F.col("ht.name").alias("home_team_name"), F.col("at.name").alias("away_team_name"),
            "f.home_score", "f.away_score", "f.home_difficulty", "f.away_difficulty", "f.finished",
        )
    )


def current_season_rows(performance: DataFrame, fixture: DataFrame, gold_player: DataFrame,
                        season: str) -> DataFrame:
    """API branch of the fact: performance x fixture x player (inner joins).

    Name, position and team come from the player dimension (the current team, also on
    older rows); gameweek and kickoff come from the fixture, not the performance row.
    ``fixture_difficulty`` is the opponent's rating: the away difficulty when at home.
    """
    fp = performance.alias("fp")
    f = fixture.select("fixture_id", "gameweek", "kickoff_time", "home_difficulty", "away_difficulty").alias("f")
    p = gold_player.select("player_id", "full_name", "position", "team_name").alias("p")
    joined = fp.join(f, F.col("fp.fixture_id") == F.col("f.fixture_id"), "inner").join(
        p, F.col("fp.player_id") == F.col("p.player_id"), "inner")
    return joined.select(
        F.col("p.full_name").alias("player_name"),
        F.col("p.position"),
        F.col("p.team_name"),
        F.col("fp.was_home"),
        F.lit(season).alias("season"),
        F.col("f.gameweek"),
        F.col("f.kickoff_time"),
        *[F.col(f"fp.{c}") for c in _SHARED_STATS],
        *[F.col(f"fp.{src}").alias(dst) for src, dst in _RENAMED],
        F.col("fp.influence"), F.col("fp.creativity"), F.col("fp.threat"), F.col("fp.ict_index"),
        tenths_to_units("fp.value").alias("price_m"),
        F.col("fp.selected"),
        F.col("fp.transfers_balance"),
        F.when(F.col("fp.was_home"), F.col("f.away_difficulty"))
        .otherwise(F.col("f.home_difficulty")).alias("fixture_difficulty"),
        F.lit(CURRENT_SOURCE_TAG).alias("data_source"),
        F.col("fp.fixture_id").alias(MATCH_ID),
    )


def historical_rows(historical: DataFrame, tie: str | None = None) -> DataFrame:
    """Historical branch of the fact: stored names, ``transfers_in - transfers_out``, no difficulty."""
    return historical.select(
        "player_name", "position", F.col("team").alias("team_name"), "was_home", "season",
        "gameweek", "kickoff_time", *_SHARED_STATS,
        *[F.col(src).alias(dst) for src, dst in _RENAMED],
        "influence", "creativity", "threat", "ict_index", "price_m", "selected",
        (F.col("transfers_in") - F.col("transfers_out")).alias("transfers_balance"),
        F.lit(None).cast("int").alias("fixture_difficulty"),
        "data_source",
        (F.col(tie).cast("long") if tie else F.lit(None).cast("long")).alias(MATCH_ID),
    )


def union_sources(current: DataFrame, historical: DataFrame) -> DataFrame:
    """UNION ALL by name (types widen; both sides carry the same 34 columns + match id)."""
    return current.unionByName(historical)


def add_form_and_value(combined: DataFrame, window: int = 5, hot_rows: int | None = None,
                       bucket_rows: int | None = None) -> DataFrame:
    """Rolling form, whole-season totals and guarded value ratios on the unified fact.

    * rolling_5gw_*: average over the current and ``window - 1`` earlier rows of the
      player (by kickoff, then match id), crossing seasons and sources.
    * season_total_pts: the full (player, season) sum on every row; a window partitioned
      by (player, season) is satisfied by the rolling window's partitioning by player, so
      both share one exchange.

    Players with very many rows are split across tasks (see ``windows.over_rows``).
    * points_per_million / points_per_90: rounded half-up to 3, NULL on zero or NULL divisor.
    """
    out = over_rows(
        combined, ["player_name"], ["kickoff_time", MATCH_ID],
        frames={
            "rolling_5gw_pts": Frame(window - 1, 0, lambda w: F.avg("total_points").over(w)),
            "rolling_5gw_xG": Frame(window - 1, 0, lambda w: F.avg("xG").over(w)),
            "rolling_5gw_xA": Frame(window - 1, 0, lambda w: F.avg("xA").over(w)),
        },
        totals={"season_total_pts": (["season"], F.sum("total_points"))},
        hot_rows=hot_rows, bucket_rows=bucket_rows,
    )
    return out.select(
        *FACT_BASE_COLUMNS,
        "rolling_5gw_pts", "rolling_5gw_xG", "rolling_5gw_xA", "season_total_pts",
        *value_ratios(),
        MATCH_ID,
    )


def value_ratios() -> list[Column]:
    """points_per_million and points_per_90 of a row: half-up to 3 digits, NULL on a zero or NULL divisor."""
    return [round_half_up(safe_divide("total_points", "price_m"), 3).alias("points_per_million"),
            round_half_up(safe_divide("total_points", F.col("minutes").cast("double") / F.lit(90.0)), 3).alias("points_per_90")]


def fact_gameweek(performance: DataFrame, fixture: DataFrame, gold_player: DataFrame,
                  historical: DataFrame, season: str, window: int = 5,
                  historical_tie: str | None = None) -> DataFrame:
    """gold.fact_gameweek_performance: API rows + historical rows + form/value metrics."""
    combined = union_sources(current_season_rows(performance, fixture, gold_player, season),
                             historical_rows(historical, historical_tie))
    return add_form_and_value(combined, window)


SEASON_KEYS = ["player_name", "season", "position", "team_name", "data_source"]


def season_totals(fact: DataFrame) -> DataFrame:
    """gold.fact_season_totals: one row per (player, season, position, team, source).

    NULL keys form their own groups. ``end_price_m`` is the season's highest price (MAX).
    """
    r3 = lambda c: round_half_up(c, 3)
    return fact.groupBy(*SEASON_KEYS).agg(
        F.count(F.lit(1)).alias("games_played"),
        F.sum("minutes").alias("total_minutes"),
        F.sum("total_points").alias("total_points"),
        r3(F.avg("total_points")).alias("avg_points_per_game"),
        F.sum("goals_scored").alias("goals"),
        F.sum("assists").alias("assists"),
        F.sum("clean_sheets").alias("clean_sheets"),
        F.sum("saves").alias("saves"),
        F.sum("bonus").alias("bonus"),
        F.sum("bps").alias("bps"),
        r3(F.sum("xG")).alias("xG_total"),
        r3(F.sum("xA")).alias("xA_total"),
        r3(F.sum("xGI")).alias("xGI_total"),
        r3(F.sum("xGC")).alias("xGC_total"),
        r3(F.avg("influence")).alias("avg_influence"),
        r3(F.avg("creativity")).alias("avg_creativity"),
        r3(F.avg("threat")).alias("avg_threat"),
        r3(F.avg("ict_index")).alias("avg_ict_index"),
        r3(F.avg("price_m")).alias("avg_price_m"),
        F.max("price_m").alias("end_price_m"),
        F.sum("yellow_cards").alias("yellow_cards"),
        F.sum("red_cards").alias("red_cards"),
    ).select(*SEASON_KEYS[:4], "games_played", "total_minutes", "total_points", "avg_points_per_game",
             "goals", "assists", "clean_sheets", "saves", "bonus", "bps", "xG_total", "xA_total",
             "xGI_total", "xGC_total", "avg_influence", "avg_creativity", "avg_threat",
             "avg_ict_index", "avg_price_m", "end_price_m", "yellow_cards", "red_cards",
             "data_source")


# ---------------------------------------------------------------- scout view

def latest_period(fact: DataFrame, source: str = CURRENT_SOURCE_TAG) -> DataFrame:
    """One-row frame ``gw`` = MAX(gameweek) over rows of ``source`` (NULL when none)."""
    return fact.where(F.col("data_source") == source).agg(F.max("gameweek").alias("gw"))


def current_form(fact: DataFrame, gold_player: DataFrame, latest: DataFrame, source: str = CURRENT_SOURCE_TAG) -> DataFrame:
    """Fact rows of the latest period joined to the player dimension by full name.

    The join is on the (non-unique) name, so namesakes fan out; a player with two
    matches in the period gives two rows. Team, position and price come from the dimension.
    """
    f = fact.where(F.col("data_source") == source).alias("f")
    p = gold_player.select("full_name", "team_name", "position", "price_m").alias("p")
    l = one_row(latest).alias("l")
    return (
        f.join(l, F.col("f.gameweek") == F.col("l.gw"), "inner")
        .join(p, F.col("f.player_name") == F.col("p.full_name"), "inner")
        .select(
            F.col("f.player_name"), F.col("p.team_name"), F.col("p.position"), F.col("p.price_m"),
            F.col("f.rolling_5gw_pts").alias("form"),
            F.col("f.points_per_million").alias("value_for_money"),
            F.col("f.points_per_90"), F.col("f.season_total_pts"),
            F.col("f.rolling_5gw_xG"), F.col("f.rolling_5gw_xA"), F.col("f.xGI"), F.col("f.ict_index"),
        )
    )


def unpivot_home_away(gold_fixture: DataFrame) -> DataFrame:
    """Each fixture as two (team_id, fdr, gameweek, finished) rows: home with the home
    rating, away with the away rating. One scan, a two-element explode."""
    sides = F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home_difficulty").alias("fdr")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away_difficulty").alias("fdr")),
    )).alias("s")
    return gold_fixture.select(sides, "gameweek", "finished").select("s.team_id", "s.fdr", "gameweek", "finished")


def upcoming_window(team_fixtures: DataFrame, latest: DataFrame, horizon: int = 3) -> DataFrame:
    """Team fixtures with ``l < gameweek <= l + horizon`` that are not finished (FALSE or NULL).

    The latest-period frame has one row, so the range condition runs as a broadcast
    nested-loop join against a single row: linear in the fixtures.
    """
    l = one_row(latest).alias("l")
    t = team_fixtures.where((~F.col("finished")) | F.col("finished").isNull()).alias("t")
    cond = (F.col("t.gameweek") > F.col("l.gw")) & (F.col("t.gameweek") <= F.col("l.gw") + F.lit(horizon))
    return t.join(l, cond, "inner").select("t.team_id", "t.fdr", "t.gameweek", "t.finished")


def upcoming_difficulty(gold_player: DataFrame, gold_fixture: DataFrame, latest: DataFrame,
                        horizon: int = 3) -> DataFrame:
    """Per player name: ROUND(AVG(fdr), 2) and COUNT(*) over the next ``horizon`` periods.

    Fixtures are pre-aggregated per team (sum, count) before joining players, so the
    player x fixture fan-out never materialises; sums and counts then add up per name,
    which gives exactly the average and count over the fanned-out rows. The per-team rows are stored and, if few,
    broadcast: players are not shuffled on the team, a key of few values.
    """
    per_team = upcoming_window(unpivot_home_away(gold_fixture), latest, horizon).groupBy("team_id").agg(
        F.sum("fdr").alias("fdr_sum"), F.count(F.lit(1)).alias("n"), F.count("fdr").alias("fdr_n"))
    path = scratch_path(gold_fixture.sparkSession, "per-team")
    per_team.write.parquet(path)
    per_team = gold_fixture.sparkSession.read.parquet(path)
    p = gold_player.select("full_name", "team_id")
    joined = p.join(bounded_broadcast(per_team), "team_id", "inner")
    return joined.groupBy(F.col("full_name").alias("player_name")).agg(
        round_half_up(safe_divide(F.sum("fdr_sum"), F.sum("fdr_n")), 2).alias("avg_upcoming_fdr"),
        F.sum("n").alias("upcoming_fixtures_count"),
    )


def scout(fact: DataFrame, gold_player: DataFrame, gold_fixture: DataFrame, horizon: int = 3,
          weights: Sequence[float] = (0.4, 0.3, 0.3), default_fdr: float = 3, fdr_pivot: float = 5,
          source: str = CURRENT_SOURCE_TAG, latest: DataFrame | None = None) -> DataFrame:
    """The scout view: latest-period form, value and upcoming difficulty per player row.

    ``scout_score = round(w0*form + w1*value_for_money + w2*(pivot - fdr), 3)``; NULL when
    form or value is NULL. Missing upcoming fixtures default to fdr 3 and count 0.
    ``latest`` may be passed when the latest period is cheaper to get elsewhere (a one-row
    frame with column ``gw``, equal to ``latest_period(fact, source)``).
    """
    latest = latest_period(fact, source) if latest is None else latest
    cf = current_form(fact, gold_player, latest, source)
    uf = upcoming_difficulty(gold_player, gold_fixture, latest, horizon)
    fdr = F.coalesce(F.col("uf.avg_upcoming_fdr"), F.lit(float(default_fdr)))
    w0, w1, w2 = weights
    return cf.alias("cf").join(uf.alias("uf"), F.col("cf.player_name") == F.col("uf.player_name"), "left").select(
        "cf.*",
        fdr.alias("avg_upcoming_fdr"),
        F.coalesce(F.col("uf.upcoming_fixtures_count"), F.lit(0).cast("long")).alias("upcoming_fixtures_count"),
        round_half_up(F.col("cf.form") * F.lit(w0) + F.col("cf.value_for_money") * F.lit(w1)
                      + (F.lit(float(fdr_pivot)) - fdr) * F.lit(w2), 3).alias("scout_score"),
    )


def scout_ordered(view: DataFrame) -> DataFrame:
    """The view as read: by score descending (NULL scores last), ties by name."""
    return view.orderBy(F.col("scout_score").desc_nulls_last(), F.col("player_name").asc_nulls_first())


def scout_top(view: DataFrame, n: int) -> DataFrame:
    """Top ``n`` rows by score: a bounded top-k (TakeOrderedAndProject), not a full sort.

    Remaining columns break ties so the pick is deterministic.
    """
    tie = [F.col(c).asc_nulls_first() for c in view.columns if c not in ("scout_score", "player_name")]
    return view.orderBy(F.col("scout_score").desc_nulls_last(), F.col("player_name").asc_nulls_first(),
                        *tie).limit(n)
