"""Every query against an independent engine, on tables large enough that order and rounding show."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from tallyloom.plans import registry


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 9))
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, sf, name):
    df = registry.queries()[name](spark, sf)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    got = sorted((tuple(map(plain, r)) for r in df.collect()), key=str)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert not [c for c, kind in df.dtypes if kind.startswith("decimal")]


def test_all_have_oracles():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_referral_tags_of_ties_and_nulls(spark, tmp_path):
    """Of tied values the first event's tag counts, as in a scan by one thread; null tags and values are passed over."""
    c = duckdb.connect(config={"threads": 1})
    c.sql("""CREATE TABLE events AS SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, i % 200 AS user_id, CASE WHEN i % 7 > 0 THEN ['click', 'view', 'purchase', 'signup', 'error'][1 + (hash(i) % 5)::INT] END AS event_type,
    CASE WHEN i % 200 > 4 AND i % 11 > 0 THEN ((hash(i + 1) % 3)::INT / 4.0)::DOUBLE END AS value, '' AS props FROM range(4000) t(i) ORDER BY i""")
    c.sql(f"COPY events TO '{tmp_path}/events.parquet'")
    got = registry.queries()["q_referral_tags"](spark, str(tmp_path)).select("brand", "tag", "partner", "reason").collect()
    want = c.sql(f"SELECT brand, tag, partner, reason FROM ({registry.oracle_sql()['q_referral_tags']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want, key=lambda r: r[0]) and len(got) == 200
