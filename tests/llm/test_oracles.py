"""Queries of the operators that SQL can express, against their DuckDB oracles (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from compare_oracle import TABLES, digest  # noqa: E402

from ledgerwatch.llm import queries  # noqa: E402
from ledgerwatch.session import ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    ship_package(spark)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    got, rel = [tuple(r) for r in df.collect()], con.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(got, df.columns)[0] == digest(rel.fetchall(), rel.columns)[0]
