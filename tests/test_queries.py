"""Every registered query against its SQL check on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from millrace import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    return float(f"{v:.10g}") if isinstance(v, float) else v


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    out = driver.queries()[name](spark, FOLDER)
    cols = sorted(out.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in out.collect()), key=repr)
    res = duck.execute(driver.oracle_sql()[name])
    at = {c[0]: i for i, c in enumerate(res.description)}
    assert sorted(at) == cols
    assert got == sorted((tuple(plain(r[at[c]]) for c in cols) for r in res.fetchall()), key=repr)


def test_entry(spark):
    assert "o2p" in driver.entry(spark).columns
