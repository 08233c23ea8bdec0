"""End to end in the payload shapes of the data model: two bootstrap snapshots over time ->
bronze with lineage -> silver players/teams -> SCD-1 ignoring NULLs -> gold player dimension."""

import json
import os

from goldleaf.operators import cdc, gold, silver
from goldleaf.sources import files


def _write(path, name, obj):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(json.dumps(obj))


def test_bootstrap_snapshots_to_gold_dimension(spark, workdir):
    land = workdir[len("file:"):] if workdir.startswith("file:") else workdir
    team = {"id": 1, "name": "Arsenal", "short_name": "ARS", "strength": 4, "strength_overall_home": 1300,
            "strength_overall_away": 1310, "strength_attack_home": 1250, "strength_attack_away": 1270,
            "strength_defence_home": 1320, "strength_defence_away": 1330}
    _write(f"{land}/bootstrap-static", "bootstrap-static_2025-08-01T080000Z.json", {
        "elements": [{"id": 7, "first_name": "Bukayo", "second_name": "Saka", "team": 1, "element_type": 3,
                      "now_cost": 100, "web_name": "Saka"},
                     {"id": 8, "first_name": "Ben", "second_name": "White", "team": 1, "element_type": 2,
                      "now_cost": 55, "web_name": "White"}],
        "teams": [team]})
    # later snapshot: NULL price for player 7, a field the first one did not have, player 8 missing
    _write(f"{land}/bootstrap-static", "bootstrap-static_2025-08-08T080000Z.json", {
        "elements": [{"id": 7, "first_name": "Bukayo", "second_name": "Saka", "team": 1, "element_type": 3,
                      "now_cost": None, "web_name": "Saka", "news": "knock"}],
        "teams": [dict(team, strength=5)]})
    schema = files.infer_schema(spark, f"{land}/bootstrap-static")
    bronze = files.with_lineage(files.read_snapshots(spark, f"{land}/bootstrap-static", "json", schema))
    seq = ["_ingestion_timestamp", "_source_file"]  # one ingestion instant: the stamped file name breaks the tie
    players = cdc.scd1(silver.players(bronze), ["player_id"], seq, ignore_null_updates=True)
    teams = cdc.scd1(silver.teams(bronze), ["team_id"], seq, ignore_null_updates=True)
    dim = {r.player_id: r for r in gold.gold_dim_player(players, teams).collect()}
    assert dim[7].price_m == 10.0            # the NULL price of the later snapshot did not overwrite
    assert dim[8].price_m == 5.5 and dim[7].position == "MID" and dim[8].position == "DEF"
    t = {r.team_id: r for r in gold.gold_dim_team(teams).collect()}
    assert t[1].strength == 5                # the later snapshot wins for a non-NULL value
