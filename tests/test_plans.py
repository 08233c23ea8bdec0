"""Plan checks: pushdown, pruning, one exchange for the fact windows, no Python UDFs."""

import contextlib
import io

import __spark_entry__ as entry
from goldleaf.operators.silver import HISTORICAL_SOURCE_TAG as HIST

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_no_python_udfs_anywhere(spark):
    from goldleaf.plans.registry import QUERIES

    for name, q in QUERIES.items():
        if name in ("forecast_metrics",):
            continue
        plan = _plan(q(spark, SF), "simple")
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(entry.queries()["gold_fact_current"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), " in plan and "GreaterThanOrEqual(o_orderdate" in plan
    plan = _plan(entry.queries()["gold_dim_fixture"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_fact_windows_share_one_exchange(spark):
    from goldleaf.plans.workload import MappedLayers

    plan = _plan(MappedLayers(spark, SF).fact(), "simple")
    assert "Union" not in plan  # the windows read the stored rows
    assert plan.count("Exchange hashpartitioning(player_name") == 1
    assert plan.count("Window [") >= 2


def test_source_tag_filter_prunes_historical_branch(spark):
    from pyspark.sql import functions as F

    from goldleaf.operators import gold
    from goldleaf.plans.workload import MappedLayers

    p = MappedLayers(spark, SF)
    plan = _plan(gold.latest_period(p.combined()), "simple")
    assert "historical" not in plan and "Union" not in plan
    assert HIST not in plan and F is not None


def test_difficulty_of_few_teams_is_broadcast_to_the_players(spark, monkeypatch):
    from goldleaf.plans import joins

    query = entry.queries()["upcoming_difficulty"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the checked broadcast is left
    try:
        few = query(spark, SF)
        assert _plan(few, "simple").count("BroadcastHashJoin [team_id") == 1
        monkeypatch.setattr(joins.bounded_broadcast, "__defaults__", (3,))
        many = query(spark, SF)
        assert "BroadcastHashJoin [team_id" not in _plan(many, "simple")
        assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
