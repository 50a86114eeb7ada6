"""The query catalogue against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerspark.catalog.oracle import ORACLE_SQL
from ledgerspark.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "id_factura"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, srows) == _bag(dcols, drows)
