import duckdb
import pytest

from foliant.llm import queries

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in queries.SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    result = con.sql(queries.ORACLES[name])
    order = [result.columns.index(c) for c in columns]
    wanted = sorted(repr([r[i] for i in order]) for r in result.fetchall())
    assert wanted and sorted(repr([r[c] for c in columns]) for r in df.collect()) == wanted
