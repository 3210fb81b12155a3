"""Every query of the change-log operators against its SQL, on the smallest tables."""

import os

import pytest

from tidelog.plans import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def sql():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.queries()))
def test_equals_sql(spark, sql, name):
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = sql.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=str)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())
