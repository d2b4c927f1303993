"""First-row, as-of, spine, allocation, linkage and difference operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in an order.  Written as row_number() = 1, so Spark limits groups before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).where(F.col("__rn") == 1).drop("__rn")


def latest_by(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the greatest version of each key, by one partial aggregation (no sort); nulls in keys are a key."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("__r"))
    return best.select(*keys, *[F.col("__r").getField(c).alias(c) for c in rest]).select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Of rows that share a key the last one by position (in-batch dedupe: last wins)."""
    return distinct_on(df, keys, F.col(position).desc())


def as_of_join(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, since: str, keep: Sequence[str], bucket: str = "month") -> DataFrame:
    """Each left row with the right row of its key that began last, at or before it; a null key or time matches nothing.

    Both sides are stacked and the latest right row is carried forward along time: no range join, so the cost does not
    grow with how many right rows a key has.  Time is cut into calendar buckets, and rows are dealt by key and bucket, so
    a key with a long history is many tasks' work; what holds at a bucket's start comes from the last right row of each
    earlier bucket, one row a key and bucket.
    """
    usable = F.col("__t").isNotNull()
    for k in on:
        usable = usable & F.col(k).isNotNull()
    r_side = right.select(*on, F.col(since).alias("__t"), F.struct(*[F.col(c) for c in keep]).alias("__r")).where(usable)
    # Other orders than time (versions, epochs) have one bucket.
    cut = F.date_trunc(bucket, "__t") if left.schema[at].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else F.lit(0)
    r_side = r_side.withColumn("__b", cut)
    l_side = left.withColumn("__t", F.col(at)).withColumn("__b", cut)
    null = F.lit(None).cast(r_side.schema["__r"].dataType)
    both = l_side.withColumn("__side", F.lit(1)).withColumn("__r", null).unionByName(r_side.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(*on, "__b").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = both.withColumn("__r", F.last("__r", ignorenulls=True).over(inside)).where("__side = 1")
    # What holds when a bucket begins, for the buckets of either side.
    last = r_side.groupBy(*on, "__b").agg(F.max_by("__r", "__t").alias("__last"))
    ends = last.unionByName(l_side.select(*on, "__b").distinct(), allowMissingColumns=True).groupBy(*on, "__b").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = Window.partitionBy(*on).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(on)], F.col("__b").alias("__kb"), F.last("__last", ignorenulls=True).over(before).alias("__before"))
    same = F.col("__b") == F.col("__kb")
    for i, k in enumerate(on):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    got = got.join(ends.where("__before IS NOT NULL"), same, "left")
    row = F.when(usable, F.coalesce("__r", "__before"))
    return got.select(*left.columns, *[row.getField(c).alias(c) for c in keep])


def month_spine(df: DataFrame, keys: Sequence[str], first: Column, last: Column, name: str = "month") -> DataFrame:
    """A row for each key and month from its first to the last."""
    return df.select(*keys, F.explode(F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))).alias(name))


def allocate(parts: DataFrame, totals: DataFrame, on: str, weight: str, total: str, name: str = "allocated") -> DataFrame:
    """A total over its parts by weight, rounded half up to cents, never more than a part's weight.

    Reckoned in whole cents (DECIMAL), so that neither the order of a sum nor a binary fraction decides a cent.
    """
    cents = lambda c: F.round(F.col(c).cast("decimal(18,4)") * 100, 0).cast("decimal(18,0)")
    parts = parts.withColumn("__u", cents(weight))
    sums = parts.groupBy(on).agg(F.sum("__u").cast("decimal(18,0)").alias("__s"))
    joined = parts.join(totals.select(on, cents(total).alias("__t")), on).join(sums, on).where(F.col("__s") > 0)
    joined = joined.withColumn(name, F.expr("CAST(least((2 * __t * __u + __s) div (2 * __s), __u) AS DECIMAL(18,0))") / 100)
    return joined.withColumn(name, F.col(name).cast("decimal(18,2)")).drop("__u", "__s", "__t")


def link(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str, role: Column, excluded: Column) -> DataFrame:
    """Deterministic record linkage on an equal key: (left id, right id, confidence).

    1.0 for one match, 0.9 for a role key, 0.5 where the left id fans out.
    """
    met = left.where(~excluded).join(right.select(right_id, key), key)
    fan = F.count("*").over(Window.partitionBy(left_id))
    sure = F.when(fan > 1, 0.5).when(role, 0.9).otherwise(1.0)
    return met.select(left_id, right_id, sure.alias("confidence"))


def difference(new: DataFrame, old: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """(key, status): NEW, REMOVED, CHANGED or SAME, by one full outer join on null-safe equality."""
    changed = F.lit(False)
    for c in compare:
        changed = changed | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    joined = new.alias("n").withColumn("__n", F.lit(1)).join(old.alias("o").withColumn("__o", F.lit(1)), F.col(f"n.{key}") == F.col(f"o.{key}"), "full")
    status = F.when(F.col("__o").isNull(), "NEW").when(F.col("__n").isNull(), "REMOVED").when(changed, "CHANGED").otherwise("SAME")
    return joined.select(F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key), status.alias("status"))


def semi_by_association(df: DataFrame, key: str, associations: DataFrame, other: str) -> DataFrame:
    """The rows whose key is among the associations' keys (decorrelated IN)."""
    return df.join(associations.select(F.col(other).alias(key)).where(F.col(key).isNotNull()), key, "left_semi")


def missing_from(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """The rows that the other relation does not have (insert-ignore, gap detection)."""
    return df.join(other.select(F.col(other_key).alias(key)), key, "left_anti")


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every cell that is not empty as an observation (ids, field, value)."""
    return df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(list(ids), list(columns), "field", "value").where(F.length(F.trim("value")) > 0)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Change events to snapshots: the last known value of each column so far."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in columns:
        df = df.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return df
