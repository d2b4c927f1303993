"""The catalogue: each lens by name, as a query for Spark and as SQL for an independent engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import session
from . import crm, evidence, harvest, jobs, kernels, ledger, money, oracles, steps, trust, written
from .dialect import DUCK, SPARK

FAMILIES = (money, evidence, trust, crm)
#: Modules of DataFrame queries with separately written SQL.
STEPS = (steps, jobs, ledger, harvest, kernels)


def _query(make: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        sql = make(SPARK)
        session.views(spark, sf_dir, sql)
        return written.run(spark, sql)

    query.__name__, query.__doc__ = make.__name__, make.__doc__
    return query


def _pinned(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf_dir)

    query.__name__, query.__doc__ = f.__name__, f.__doc__
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    lenses = {f"q_{name}": _query(make) for family in FAMILIES for name, make in family.LENSES.items()}
    return lenses | {f"q_{name}": _pinned(f) for module in STEPS for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    lenses = {f"q_{name}": oracles.SQL.get(name) or make(DUCK) for family in FAMILIES for name, make in family.LENSES.items()}
    return lenses | {f"q_{name}": sql for module in STEPS for name, sql in module.SQL.items()}
