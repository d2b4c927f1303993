"""The queries that SQL can express, against it."""

import os

import duckdb
import pytest

from tallyloom.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda r: tuple(repr(round(v, 9)) if isinstance(v, float) else str(v) for v in r)
    assert sorted(plain(r) for r in got.select(*want.columns).collect()) == sorted(map(plain, want.fetchall()))
