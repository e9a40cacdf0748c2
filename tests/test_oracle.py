"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest
from conftest import DATA

from foliant.plans.base import SCHEMAS
from foliant.plans.catalog import ORACLES, QUERIES

# Lists of a fixed length, and names that need more customers than there are.
MAY_BE_EMPTY = {"page_slice"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(plain(v) for v in value) if isinstance(value, list | tuple) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = sorted((repr([plain(r[c]) for c in columns]) for r in df.collect()))
    result = duck.sql(ORACLES[name])
    assert sorted(result.columns) == columns
    order = [result.columns.index(c) for c in columns]
    wanted = sorted(repr([plain(r[i]) for i in order]) for r in result.fetchall())
    assert found == wanted
    assert found or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0
