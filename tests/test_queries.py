"""Every registered query against its SQL counterpart at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from tierwarden.plans.oracles import SQL
from tierwarden.plans.registry import QUERIES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = table([tuple(r) for r in df.collect()], df.columns)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == table(cur.fetchall(), columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["role", "node_type", "accessible_nodes", "classifications"] and out.count() > 0
