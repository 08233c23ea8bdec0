"""Silver layer: typed projections of the bronze snapshots.

Each function is ``DataFrame -> DataFrame`` and is legal on a streaming frame.
Casts are ``try_cast`` (ANSI mode would abort the whole stream on one dirty text
value such as ``'None'``); fields missing from a payload become typed NULLs, so
older and newer snapshot schemas both project cleanly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (source field, output name, type) per silver dataset. Fixed values.
PLAYER_FIELDS = [
    ("id", "player_id", "long"), ("first_name", "first_name", None), ("second_name", "second_name", None),
    ("team", "team_id", "long"), ("element_type", "position_id", "int"), ("now_cost", "current_price", "double"),
    ("web_name", "web_name", None),
]
TEAM_FIELDS = [
    ("id", "team_id", "long"), ("name", "name", None), ("short_name", "short_name", None),
    ("strength", "strength", "int"),
    ("strength_overall_home", "strength_overall_home", "int"),
    ("strength_overall_away", "strength_overall_away", "int"),
    ("strength_attack_home", "strength_attack_home", "int"),
    ("strength_attack_away", "strength_attack_away", "int"),
    ("strength_defence_home", "strength_defence_home", "int"),
    ("strength_defence_away", "strength_defence_away", "int"),
]
FIXTURE_FIELDS = [
    ("id", "fixture_id", "long"), ("event", "gameweek", "int"), ("kickoff_time", "kickoff_time", "timestamp"),
    ("team_h", "home_team_id", "long"), ("team_a", "away_team_id", "long"),
    ("team_h_score", "home_score", "int"), ("team_a_score", "away_score", "int"),
    ("team_h_difficulty", "home_difficulty", "int"), ("team_a_difficulty", "away_difficulty", "int"),
    ("finished", "finished", "boolean"),
]
_MATCH_INTS = ["minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
               "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", "bps"]
_ICT = ["influence", "creativity", "threat", "ict_index"]
_EXPECTED = ["expected_goals", "expected_assists", "expected_goal_involvements", "expected_goals_conceded"]
PERFORMANCE_FIELDS = (
    [("element", "player_id", "long"), ("fixture", "fixture_id", "long"),
     ("opponent_team", "opponent_team_id", "long"), ("total_points", "total_points", "int"),
     ("was_home", "was_home", "boolean"), ("kickoff_time", "kickoff_time", "timestamp"),
     ("team_h_score", "team_h_score", "int"), ("team_a_score", "team_a_score", "int"),
     ("round", "gameweek", "int")]
    + [(c, c, "int") for c in _MATCH_INTS]
    + [(c, c, "double") for c in _ICT]
    + [("starts", "starts", "int")]
    + [(c, c, "double") for c in _EXPECTED]
    + [("value", "value", "int"), ("transfers_balance", "transfers_balance", "int"),
       ("selected", "selected", "int"), ("transfers_in", "transfers_in", "int"),
       ("transfers_out", "transfers_out", "int"),
       ("clearances_blocks_interceptions", "clearances_blocks_interceptions", "int"),
       ("recoveries", "recoveries", "int"), ("tackles", "tackles", "int")]
)
HISTORICAL_FIELDS = (
    [("name", "player_name", None), ("position", "position", None), ("team", "team", None),
     ("season", "season", None), ("round", "gameweek", "int"), ("opponent_team", "opponent_team_id", "long"),
     ("was_home", "was_home", "boolean"), ("kickoff_time", "kickoff_time", "timestamp"),
     ("total_points", "total_points", "int")]
    + [(c, c, "int") for c in _MATCH_INTS]
    + [(c, c, "double") for c in _ICT + _EXPECTED]
)

# Source tags of the two branches of the unified fact (the current-season
# API feed and the historical per-season CSV archive).
CURRENT_SOURCE_TAG = "api"
HISTORICAL_SOURCE_TAG = "vaastav"

LINEAGE = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"


def _field_type(schema: T.StructType, path: list[str]) -> T.DataType | None:
    dt: T.DataType = schema
    for name in path:
        if not isinstance(dt, T.StructType) or name not in dt.fieldNames():
            return None
        dt = dt[name].dataType
    return dt


def typed(schema: T.StructType, path: str, to: str | None) -> Column:
    """Typed access to ``path`` (``a.b``); NULL of the target type when the field is absent."""
    src = _field_type(schema, path.split("."))
    if src is None:
        return F.lit(None).cast(to or "string")
    c = F.col(path)
    if to is None:
        return c
    if to == "timestamp":
        if isinstance(src, (T.TimestampType, T.TimestampNTZType)):
            return c  # already an instant: keep its type
        return F.try_to_timestamp(c.cast("string"))
    if to == "boolean" and isinstance(src, T.StringType):
        return F.lower(F.trim(c)).try_cast("boolean")
    return c.try_cast(to)


def _project(df: DataFrame, prefix: str, fields, schema: T.StructType, extra: list[Column]) -> DataFrame:
    cols = [typed(schema, f"{prefix}{src}", to).alias(dst) for src, dst, to in fields]
    return df.select(*cols, *extra)


def _lineage(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in (LINEAGE, SOURCE_FILE) if c in df.columns]


def _exploded(df: DataFrame, array_col: str, alias: str) -> tuple[DataFrame, T.StructType]:
    """Inner explode: NULL and empty arrays give no rows."""
    keep = [c for c in (LINEAGE, SOURCE_FILE) if c in df.columns]
    out = df.select(F.explode(array_col).alias(alias), *keep)
    return out, out.schema


def players(bootstrap: DataFrame) -> DataFrame:
    """bootstrap ``elements`` -> one typed row per player."""
    ex, schema = _exploded(bootstrap, "elements", "e")
    return _project(ex, "e.", PLAYER_FIELDS, schema, _lineage(ex))


def teams(bootstrap: DataFrame) -> DataFrame:
    """bootstrap ``teams`` -> one typed row per team."""
    ex, schema = _exploded(bootstrap, "teams", "t")
    return _project(ex, "t.", TEAM_FIELDS, schema, _lineage(ex))


def fixtures(raw: DataFrame) -> DataFrame:
    """Flat fixture rows -> typed silver fixture rows."""
    return _project(raw, "", FIXTURE_FIELDS, raw.schema, _lineage(raw))


def performances(element: DataFrame) -> DataFrame:
    """element-summary ``history`` -> one typed row per player and match."""
    ex, schema = _exploded(element, "history", "h")
    return _project(ex, "h.", PERFORMANCE_FIELDS, schema, _lineage(ex))


def historical(raw: DataFrame, source_tag: str = HISTORICAL_SOURCE_TAG, passthrough: list[str] | None = None) -> DataFrame:
    """Historical CSV rows -> typed rows; price scaled from tenths, constant source tag.

    ``passthrough`` names extra columns (e.g. a tie-breaker) carried unchanged.
    """
    schema = raw.schema
    value = typed(schema, "value", "double")
    extra = [
        (value / F.lit(10.0)).alias("price_m"),
        typed(schema, "selected", "int").alias("selected"),
        typed(schema, "transfers_in", "int").alias("transfers_in"),
        typed(schema, "transfers_out", "int").alias("transfers_out"),
        F.lit(source_tag).alias("data_source"),
        *_lineage(raw),
        *[F.col(c) for c in (passthrough or [])],
    ]
    return _project(raw, "", HISTORICAL_FIELDS, schema, extra)
