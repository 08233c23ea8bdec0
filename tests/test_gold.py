"""Gold layer on a hand-built fixture set with the edge rows of the data model."""

import datetime as dt

import pytest

from goldleaf.operators.silver import HISTORICAL_SOURCE_TAG as HIST

from goldleaf.operators import gold


def ts(m, d):
    return dt.datetime(2025, m, d, 14, 0, 0)


TEAM = "team_id long, name string, short_name string, strength int, strength_overall_home int, " \
       "strength_overall_away int, strength_attack_home int, strength_attack_away int, " \
       "strength_defence_home int, strength_defence_away int"
PLAYER = "player_id long, first_name string, second_name string, team_id long, position_id int, " \
         "current_price double, web_name string"
FIXTURE = "fixture_id long, gameweek int, kickoff_time timestamp, home_team_id long, away_team_id long, " \
          "home_score int, away_score int, home_difficulty int, away_difficulty int, finished boolean"
STATS = ["minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals", "penalties_saved",
         "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", "bps"]


@pytest.fixture(scope="module")
def frames(spark):
    team = spark.createDataFrame([(i, n, n[:3].upper(), 3, 1, 1, 1, 1, 1, 1) for i, n in
                                  [(1, "Arsenal"), (2, "Burnley"), (4, "Chelsea")]], TEAM)
    player = spark.createDataFrame([
        (10, "Bukayo", "Saka", 1, 3, 95.0, "Saka"),
        (11, "Bukayo", "Saka", 2, 4, 60.0, "Saka B"),   # namesake on another team
        (12, None, "Nobody", 1, 5, 50.0, "Nobody"),     # NULL first name, unknown position code
        (13, "Lost", "Player", 99, 1, 45.0, "Lost"),    # team missing from the team dimension
        (14, "Zero", "Min", 2, 2, 40.0, "Min"),
        (16, "Cole", "Palmer", 4, 3, 105.0, "Palmer"),  # team without upcoming fixtures
    ], PLAYER)
    fixture = spark.createDataFrame([
        (100, 1, ts(8, 16), 1, 2, 2, 0, 2, 3, True),
        (101, 2, ts(8, 23), 2, 1, 1, 1, 3, 4, True),
        (102, 2, ts(8, 23), 1, 2, 0, 0, 2, 2, True),   # double gameweek, same kickoff
        (103, 3, ts(8, 30), 1, 2, None, None, 2, 4, False),
        (104, 4, ts(9, 6), 2, 1, None, None, 3, 5, None),
        (105, 5, ts(9, 13), 1, 3, None, None, 2, 1, False),  # away team 3 unknown
        (106, 6, ts(9, 20), 1, 2, None, None, 2, 2, False),  # beyond the 3-gameweek horizon
        (107, None, ts(9, 27), 1, 2, None, None, 2, 2, False),
    ], FIXTURE)
    perf_cols = ["player_id", "fixture_id", "total_points", "was_home", "value"] + STATS + [
        "influence", "creativity", "threat", "ict_index", "expected_goals", "expected_assists",
        "expected_goal_involvements", "expected_goals_conceded", "selected", "transfers_balance"]

    def perf(pid, fid, pts, home, value, minutes):
        return (pid, fid, pts, home, value, minutes) + (0,) * 12 + (1.0,) * 8 + (100, 5)

    performance = spark.createDataFrame([
        perf(10, 100, 6, True, 95, 90),
        perf(10, 101, 2, None, 0, 0),     # NULL flag -> ELSE branch; price 0 and minutes 0 -> NULL ratios
        perf(10, 102, 10, False, 95, 90),
        perf(14, 101, 1, True, 40, 90),
        perf(16, 102, 3, True, 105, 45),
        perf(13, 100, 8, True, 45, 90),   # player not in the dimension -> dropped (inner join)
    ], ", ".join(f"{c} {'long' if c in ('player_id', 'fixture_id') else 'boolean' if c == 'was_home' else 'double' if c.startswith(('influence', 'creativity', 'threat', 'ict', 'expected')) else 'int'}" for c in perf_cols))
    hist_cols = "player_name string, position string, team string, season string, gameweek int, was_home boolean, " \
                "kickoff_time timestamp, total_points int, " + ", ".join(f"{c} int" for c in STATS) + ", " + \
                ", ".join(f"{c} double" for c in ["influence", "creativity", "threat", "ict_index", "expected_goals",
                                                  "expected_assists", "expected_goal_involvements",
                                                  "expected_goals_conceded", "price_m"]) + \
                ", selected int, transfers_in int, transfers_out int, data_source string"
    historical = spark.createDataFrame([
        ("Bukayo Saka", "MID", "Arsenal", "2024-25", 37, True, dt.datetime(2025, 5, 10), 5) + (90,) + (0,) * 12
        + (1.0,) * 8 + (9.0, 10, 7, 2, HIST),
        ("Bukayo Saka", "MID", "Arsenal", "2024-25", 38, False, dt.datetime(2025, 5, 18), 7) + (90,) + (0,) * 12
        + (1.0,) * 8 + (9.1, 10, 1, 4, HIST),
    ], hist_cols)
    dim_player = gold.gold_dim_player(player, team)
    dim_fixture = gold.gold_dim_fixture(fixture, team)
    fact = gold.fact_gameweek(performance, fixture, dim_player, historical, "2025-26")
    return {"dim_player": dim_player, "dim_fixture": dim_fixture, "fact": fact,
            "scout": gold.scout(fact, dim_player, dim_fixture)}


def test_dim_player(frames):
    rows = {r.player_id: r for r in frames["dim_player"].collect()}
    assert 13 not in rows                      # inner join on team
    assert rows[12].full_name is None and rows[12].position is None
    assert rows[10].full_name == "Bukayo Saka" and rows[10].position == "MID" and rows[10].price_m == 9.5
    assert rows[10].team_name == "Arsenal" and rows[10].team_short == "ARS"


def test_dim_fixture_missing_team_gives_null_name(frames):
    rows = {r.fixture_id: r for r in frames["dim_fixture"].collect()}
    assert rows[105].home_team_name == "Arsenal" and rows[105].away_team_name is None
    assert len(rows) == 8


def test_fact_rows_and_formulas(frames):
    fact = frames["fact"]
    api = {r.match_id: r for r in fact.where("data_source = 'api'").collect() if r.player_name == "Bukayo Saka"}
    assert fact.where("data_source = 'api'").count() == 5   # player 13 dropped
    assert api[101].fixture_difficulty == 3                  # NULL flag -> home difficulty (ELSE)
    assert api[100].fixture_difficulty == 3                  # at home -> away difficulty
    assert api[101].points_per_million is None and api[101].points_per_90 is None
    assert api[102].points_per_million == round(10 / 9.5, 3) and api[102].points_per_90 == 10.0
    assert api[101].rolling_5gw_pts == pytest.approx((5 + 7 + 6 + 2) / 4)      # crosses seasons and sources
    assert api[102].rolling_5gw_pts == pytest.approx((5 + 7 + 6 + 2 + 10) / 5)  # tie on kickoff ordered by match id
    assert api[102].season_total_pts == 18 and api[102].season == "2025-26"
    hist = fact.where(f"data_source = '{HIST}'").collect()
    assert {r.season_total_pts for r in hist} == {12}
    assert {r.transfers_balance for r in hist} == {5, -3} and {r.fixture_difficulty for r in hist} == {None}


def test_season_totals(frames):
    rows = {(r.player_name, r.season, r.team_name): r for r in gold.season_totals(frames["fact"]).collect()}
    cur = rows[("Bukayo Saka", "2025-26", "Arsenal")]
    assert cur.games_played == 3 and cur.total_points == 18 and cur.total_minutes == 180
    assert cur.avg_points_per_game == 6.0 and cur.end_price_m == 9.5
    old = rows[("Bukayo Saka", "2024-25", "Arsenal")]
    assert old.end_price_m == 9.1 and old.avg_price_m == 9.05


def test_scout_view(frames):
    rows = frames["scout"].collect()
    saka = [r for r in rows if r.player_name == "Bukayo Saka"]
    assert len(saka) == 4                       # two matches in the latest gameweek x two namesakes
    assert {r.upcoming_fixtures_count for r in saka} == {5}
    assert {r.avg_upcoming_fdr for r in saka} == {3.2}
    scores = sorted((r.scout_score is None, r.scout_score) for r in saka)
    assert scores[0][1] == round(0.4 * 6.0 + 0.3 * round(10 / 9.5, 3) + 0.3 * (5 - 3.2), 3)
    assert scores[-1] == (True, None)           # value NULL (price 0) -> score NULL
    zero = [r for r in rows if r.player_name == "Zero Min"]
    assert len(zero) == 1 and zero[0].avg_upcoming_fdr == 3.5 and zero[0].upcoming_fixtures_count == 2
    palmer = [r for r in rows if r.player_name == "Cole Palmer"]
    assert palmer[0].avg_upcoming_fdr == 3.0 and palmer[0].upcoming_fixtures_count == 0
    top = gold.scout_top(frames["scout"], 2).collect()
    assert len(top) == 2 and top[0].scout_score >= top[1].scout_score


def test_empty_api_source_gives_empty_scout(spark, frames):
    fact = frames["fact"].where(f"data_source = '{HIST}'")
    assert gold.scout(fact, frames["dim_player"], frames["dim_fixture"]).count() == 0
