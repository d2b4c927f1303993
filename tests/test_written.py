"""Relations that are written once."""

import pytest

from tallyloom.plans import money, written
from tallyloom.plans.dialect import SPARK

SQL = "WITH a AS (SELECT k, sum(v) AS v, 'x, (y' AS q FROM t GROUP BY k), b AS (SELECT k FROM a WHERE v > (SELECT avg(v) FROM a)), c AS (SELECT k FROM t) SELECT a.k, a.v FROM a JOIN b ON a.k = b.k JOIN c ON c.k = a.k"


@pytest.fixture(autouse=True)
def few_uses(monkeypatch):
    monkeypatch.setattr(written, "HEAVY", 3)


def test_relations_and_their_uses():
    parts, rest = written.split(SQL)
    assert [n for n, _ in parts] == ["a", "b", "c"] and rest.strip().startswith("SELECT a.k")
    assert written.uses(parts, rest) == {"a": (3, 3), "b": (1, 1), "c": (1, 1)}
    assert written.chosen(parts, rest) == {"a"}
    assert written._named(["k", "v", "q"], "a", [b for _, b in parts[1:]] + [rest]) == ["k", "v"]
    assert written.split("SELECT 1") == ([], "SELECT 1")


def test_the_result_stays(spark):
    spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "k int, v int").createOrReplaceTempView("t")
    want = [tuple(r) for r in spark.sql(SQL).orderBy("k").collect()]
    assert [tuple(r) for r in written.run(spark, SQL).orderBy("k").collect()] == want == [(1, 5), (1, 5)]


def test_the_lines_of_a_heavy_lens_are_joined_once(spark, sf):
    from tallyloom import session

    sql = money.LENSES["fee_at_risk"](SPARK)
    session.views(spark, sf, sql)
    plan = written.run(spark, sql)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "o_orderdate" not in plan
