"""Queries whose rows SQL can express give DuckDB's rows on the smaller tables."""

import duckdb
import pytest

from ledgerlake.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(want.fetchall())
