"""Slowly changing records: diff, merge into current and history, point-in-time reads, effective-dated intervals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_value(a: Column, b: Column, kind: str) -> Column:
    """Null-safe equality; numbers compare as decimals, so 1 and 1.00 are equal."""
    if kind in ("int", "bigint", "smallint", "tinyint", "float", "double") or kind.startswith("decimal"):
        return a.cast("decimal(38,10)").eqNullSafe(b.cast("decimal(38,10)"))
    return a.eqNullSafe(b)


@dataclass(frozen=True)
class Merge:
    current: DataFrame
    history: DataFrame  #: the rows that this merge archives
    changes: DataFrame  #: (keys, outcome: created, updated, unchanged or absent; changed: names)


def merge(current: DataFrame, incoming: DataFrame, keys: Sequence[str], at: Column, refreshed: str = "refreshed_at", silent: Sequence[str] = ()) -> Merge:
    """One batch into the current rows, by a full outer join.

    A column that the current table lacks is an error, for its values would go unseen; columns of ``silent`` are written
    but a difference in them alone is no change.

    A column that the incoming frame lacks is "no change", unlike a null in one that it has.  Changed rows go to history
    with valid_from = when they were last refreshed and valid_to = ``at``; unchanged ones are only refreshed; current
    rows that the batch does not name stay as they are.
    """
    if unknown := set(incoming.columns) - set(current.columns):
        raise ValueError(f"the current table has no {sorted(unknown)}")
    emitted = [c for c in incoming.columns if c not in keys and c != refreshed]
    compared = [c for c in emitted if c not in silent]
    kinds = dict(current.dtypes)
    on = None
    for k in keys:
        cond = F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}"))
        on = cond if on is None else on & cond
    both = current.withColumn("__c", F.lit(True)).alias("c").join(incoming.withColumn("__i", F.lit(True)).alias("i"), on, "full")
    names = F.array_compact(F.array(*[F.when(~same_value(F.col(f"c.{c}"), F.col(f"i.{c}"), kinds[c]), F.lit(c)) for c in compared])) if compared else F.array().cast("array<string>")
    outcome = F.when(F.col("__c").isNull(), "created").when(F.col("__i").isNull(), "absent").when(F.size(names) > 0, "updated").otherwise("unchanged")
    both = both.withColumn("__outcome", outcome).withColumn("__names", F.when(F.col("__outcome") == "updated", names))
    key = [F.coalesce(F.col(f"c.{k}"), F.col(f"i.{k}")).alias(k) for k in keys]
    touched = F.col("__i").isNotNull()
    values = []
    for c in current.columns:
        if c in keys:
            continue
        if c == refreshed:
            values.append(F.when(touched, at).otherwise(F.col(f"c.{c}")).alias(c))
        elif c in emitted:
            values.append(F.when(touched, F.col(f"i.{c}").cast(kinds[c])).otherwise(F.col(f"c.{c}")).alias(c))
        else:
            values.append(F.col(f"c.{c}"))
    new = both.select(*key, *values).select(*current.columns)
    old = both.where(F.col("__outcome") == "updated").select(*[F.col(f"c.{c}") for c in current.columns], F.col(f"c.{refreshed}").alias("valid_from"), at.alias("valid_to"))
    return Merge(new, old, both.select(*key, F.col("__outcome").alias("outcome"), F.col("__names").alias("changed")))


def intervals(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Revisions to intervals: each ends where the next begins, the last is open; of one instant's revisions all stay, but empty intervals go."""
    nxt = F.lead(at).over(Window.partitionBy(*keys).orderBy(at))
    return df.withColumn("valid_from", F.col(at)).withColumn("valid_to", nxt).where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def point_in_time(history: DataFrame, at: Column) -> DataFrame:
    """The rows that held at a time: valid_from <= at < valid_to, an open end holds on."""
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def set_rate(rates: DataFrame, keys: dict[str, str], rate: float, cutover: Column) -> DataFrame:
    """Effective-dated update: the open interval of the key ends at the cutover and a new one begins there."""
    if not 0 <= rate <= 1:
        raise ValueError("a rate is between 0 and 1")
    hit = F.col("valid_to").isNull()
    for k, v in keys.items():
        hit = hit & F.col(k).eqNullSafe(F.lit(v))  # never null, so that no row is lost by it
    closed = rates.withColumn("valid_to", F.when(hit & (F.col("valid_from") < cutover), cutover).otherwise(F.col("valid_to"))).where(~(hit & (F.col("valid_from") >= cutover)))
    spark = rates.sparkSession
    fresh = spark.range(1).select(*[(F.lit(keys[c]) if c in keys else F.lit(rate) if c == "rate" else cutover if c == "valid_from" else F.lit(None)).cast(t).alias(c) for c, t in rates.dtypes])
    return closed.unionByName(fresh)
