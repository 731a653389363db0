"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from ledgerlake.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return [plain(x) for x in v]
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows, "no rows"
    if name not in catalog.ORACLE_SQL:
        return
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr)
    expected = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in want.fetchall()), key=repr)
    assert got == expected
