"""The training-data queries that SQL can express give what DuckDB gives on the smallest tables."""

import duckdb
import pytest

from plenum.llm import queries
from test_queries import SF, TABLES, plain


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    found = duck.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
