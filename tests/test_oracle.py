"""Every registered query against its SQL oracle on the smallest scale factor."""

import duckdb
import pytest

import __spark_entry__ as entry
from goldleaf.plans.tpch_mapping import TABLES
from tests.compare import duck_rows, spark_rows, type_diffs

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
try:
    from goldleaf.llm.queries import QUERIES as OPTIONAL
except ModuleNotFoundError:
    OPTIONAL = {}
OPTIONAL = {*OPTIONAL, "pipeline"}
ORACLE = {k: v for k, v in ORACLE.items() if k not in OPTIONAL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_a_reason():
    missing = set(entry.queries()) - set(ORACLE) - OPTIONAL
    assert missing == {"forecast_metrics", "forecast_early_stop"}
    assert len(entry.queries()) >= 45


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = spark_rows(df)
    o_cols, o_rows = duck_rows(con, ORACLE[name])
    assert s_cols == o_cols
    assert type_diffs(df, con, ORACLE[name]) == {}
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "scout_score" in df.columns


def test_forecast_metrics_shape(spark):
    rows = entry.queries()["forecast_metrics"](spark, SF).collect()
    assert [r["step"] for r in sorted(rows, key=lambda r: r["step"])] == [1, 2, 3]
    for r in rows:
        assert r["n"] > 0 and r["mae"] >= 0 and r["mse"] >= 0
