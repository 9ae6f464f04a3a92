"""The driver contract: entry() runs, and every registered query matches its oracle (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["job_id", "total_views", "total_applicants", "first_active_day", "last_active_day"]


def test_every_query_has_a_callable_and_most_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100 and set(E.analogues.ORACLE) <= set(o)
    assert len(E.analogues.ORACLE) >= len(E.analogues.QUERIES) - 5  # corpus queries mostly have no SQL form


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[key]).fetchdf()
    gc, gr = rows(got)
    wc, wr = rows(want)
    assert gc == wc
    assert gr == wr
