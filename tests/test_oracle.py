"""Every registered query against its SQL oracle on the smallest fixture."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from basketry.queries import REGISTRY
from basketry.sql_oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem", "customer"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) - set(ORACLE) == set()
    assert set(REGISTRY) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(res.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 150
    assert "customer_segment" in df.columns
