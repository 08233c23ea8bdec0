"""Expectations: warn vs drop, NULL predicates, stacked counts."""

from pyspark.sql import Observation

from goldleaf.operators.quality import Expectation, apply_expectations, expectation_report

RULES = [
    Expectation("valid_gameweek", "gameweek BETWEEN 1 AND 38", "warn"),
    Expectation("has_fixture_id", "fixture_id IS NOT NULL", "drop"),
    Expectation("valid_minutes", "minutes >= 0 AND minutes <= 120", "drop"),
]
ROWS = [(1, 0, 0), (2, 1, 120), (3, 38, 121), (None, 39, 90), (5, None, None), (6, 20, -1)]


def _df(spark):
    return spark.createDataFrame(ROWS, "fixture_id long, gameweek int, minutes int")


def test_drop_rules_and_null_predicates(spark):
    kept = apply_expectations(_df(spark), RULES)
    assert sorted(r.fixture_id for r in kept.collect()) == [1, 2]


def test_report_counts(spark):
    rep = {r.rule: r for r in expectation_report(_df(spark), RULES).collect()}
    assert rep["valid_gameweek"].failed == 3  # 0, 39 and NULL
    assert rep["has_fixture_id"].failed == 1
    assert rep["valid_minutes"].failed == 3  # 121, NULL, -1
    assert {r.total for r in rep.values()} == {6}
    assert {r.kept for r in rep.values()} == {2}


def test_observation_counts_while_filtering(spark):
    obs = Observation("q")
    kept = apply_expectations(_df(spark), RULES, obs)
    n_kept = kept.count()
    m = obs.get
    assert m["__rows"] == 6 and n_kept == 2
    assert m["valid_gameweek"] == 3 and m["valid_minutes"] == 3


def test_unknown_action_rejected():
    import pytest

    with pytest.raises(ValueError):
        Expectation("x", "true", "fail")
