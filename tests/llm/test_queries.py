"""Every query of the dealt operators that has an oracle, against DuckDB on the two small scale factors."""

import duckdb
import pytest

from goldleaf.llm.queries import ORACLE, QUERIES
from tests.compare import duck_rows, spark_rows, type_diffs

TABLES = ("documents", "pages", "benchmark", "conversations", "labels")


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def sf(request):
    con = duckdb.connect()
    path = f"/root/testdata/{request.param}"
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return path, con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, name):
    path, con = sf
    df = QUERIES[name](spark, path)
    s_cols, s_rows = spark_rows(df)
    o_cols, o_rows = duck_rows(con, ORACLE[name])
    assert s_cols == o_cols
    assert type_diffs(df, con, ORACLE[name]) == {}
    assert s_rows == o_rows
