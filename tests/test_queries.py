"""Every registered query against its DuckDB oracle (sf0.001; the driver
runs the same comparison at sf0.01): row count, column names, and an
order-insensitive comparison of all values."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as E  # noqa: E402
from compare_oracle import TABLES, digest  # noqa: E402
from ledgerwatch.plans import catalog  # noqa: E402

QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}   # the library's own
SQL = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"create view {t} as select * from '{p}'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(exp)
    assert digest(got, df.columns)[1] == digest(exp, rel.columns)[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
