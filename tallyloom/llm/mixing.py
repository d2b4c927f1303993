"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

All sources together are to fill ``share`` of all words.  A source gets a level times its weight, but no more than
``epochs`` times its own size; what the cap cuts off is reshared by weight until no target is above its cap.  That end
is the water level: with sources ordered by cap / weight, the first k for which (total - caps before k) / (weights from
k on) is at most k's cap / weight fixes the level.  So it is found in closed form, by running sums over one row a source.

Whole repetitions take every document; the fractional rest takes documents in the order of a seeded hash until the
rest is full, the last one in part.  That cut is found in two steps that never order a whole source: sums by bucket of the hash first, then
the one bucket that holds the cut.

Defined results: a null or blank text has size 0 and takes 0; a null source is a source (last in order); an empty table
gives an empty table; rows that share a doc_id share a hash, the order among them is by size; a very long text counts
whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
EPOCHS = 2
SEED = "mix-1"
#: Hex digits of the hash that number the buckets: 4096 sums for a source at most.
BUCKET_DIGITS = 3

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string"))).alias("h")
    )


def _running(scratch: Scratch, df: DataFrame, name: str, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with running sums in an order: ``sums`` maps a new column to the one that it adds up, the row's own included.

    Rows are dealt by ranges of the order and written with the number of their range; sums run within ranges, and what
    ranges before hold is added: one row a range.  So no task sees all rows, however many there are.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.cut(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), name)
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = dealt.groupBy("__part").agg(*[F.sum(c).alias(f"__{k}") for k, c in sums.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = totals.select("__part", *[F.coalesce(F.sum(f"__{k}").over(earlier), F.lit(0)).alias(f"__{k}") for k in sums])
    joined = dealt.join(totals, "__part")
    return joined.withColumns({k: F.sum(c).over(inside) + F.col(f"__{k}") for k, c in sums.items()}).drop("__part", *[f"__{k}" for k in sums])


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size): one row a source throughout, and no task with all of them."""
    scratch = Scratch(sized.sparkSession)
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    by = _running(scratch, by, "ranked", [F.col("source").asc_nulls_last()], {"rank": "one"})
    nth = F.pmod(F.col("rank") - 1, F.lit(len(weights)))
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).cast("long"))
    by = by.withColumn("cap", (F.col("source_size") * epochs).cast("long")).withColumn("ratio", F.col("cap") / F.col("w"))
    by = _running(scratch, by, "levels", [F.col("ratio").asc(), F.col("source").asc_nulls_last()], {"caps": "cap", "ws": "w"})
    by = scratch.cut(by, "sums")
    total = by.agg(F.sum("source_size")).scalar() * F.lit(share_percent) / F.lit(100.0)
    level = (total - (F.col("caps") - F.col("cap"))) / (by.agg(F.sum("w")).scalar() - F.col("ws") + F.col("w"))
    by = scratch.cut(by.withColumn("level", level), "water")
    by = by.withColumn("water", by.agg(F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level")))).scalar())
    target = F.when(F.col("water").isNull() | (F.col("water") * F.col("w") > F.col("cap")), F.col("cap").cast("double")).otherwise(F.col("water") * F.col("w"))
    return by.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) for each document.

    ``taken`` is ``whole`` repetitions and the fractional one: all of a document before the cut, the first words of the
    document that holds it, none after it.  Source totals are pre-aggregated, so a hot source costs no more than
    others; the only documents that meet by source are those of the one bucket that holds the cut (about 1/4096 of a
    source).  Sizes are written once, so texts are read once, and the written one-row-a-source table has a known size
    by which Spark decides whether to broadcast it.
    """
    scratch = Scratch(docs.sparkSession)
    sized = scratch.cut(sizes(docs), "sizes").withColumn("sk", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    goal = targets(sized, weights, share_percent, epochs).withColumn("sk", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = scratch.cut(goal.withColumn("whole", whole).withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")).drop("source"), "goal")
    sums = sized.groupBy("sk", "bucket").agg(F.sum("size").alias("bucket_size"))
    run = F.sum("bucket_size").over(Window.partitionBy("sk").orderBy("bucket"))
    sums = sums.withColumn("upto", run).join(goal.select("sk", "rest"), "sk")
    # The bucket that holds the cut: the first whose running sum passes the rest.
    cut = (
        sums.where(F.col("upto") > F.col("rest")).groupBy("sk")
        .agg(F.min("bucket").alias("cut_bucket"), F.min_by(F.col("upto") - F.col("bucket_size"), "bucket").alias("before"))
    )
    facts = scratch.cut(goal.join(cut, "sk", "left"), "facts")
    rows = sized.join(facts, "sk")
    edge = rows.where(F.col("bucket") == F.col("cut_bucket"))
    order = Window.partitionBy("sk").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("rest") - F.col("before") - (F.sum("size").over(order) - F.col("size"))
    edge = edge.withColumn("more", F.greatest(F.lit(0), F.least("size", left)))
    inner = rows.where(F.col("cut_bucket").isNull() | (F.col("bucket") != F.col("cut_bucket")))
    inner = inner.withColumn("more", F.when(F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket")), F.least("size", "rest")).otherwise(F.lit(0)))
    columns = ["doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("more")).cast("long").alias("taken"), F.when(F.col("sk") != "n", F.substring("sk", 2, 2147483647)).alias("source")]
    return edge.select(*columns).unionByName(inner.select(*columns))


def repeat(docs: DataFrame, **weights) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; a repetition in part is the text's first words.

    Rows that share doc_id, source and size share what the mix takes of them evenly.  Documents without words go.
    """
    scratch = Scratch(docs.sparkSession)
    taken = mix(docs, **weights).where("size > 0").groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__of"))
    taken = scratch.cut(taken.agg(F.ceil(F.sum("taken") / F.count("*")).alias("__taken")).where("__taken > 0"), "taken")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (F.col("__size") == F.col("__of"))
    rows = docs.withColumn("__size", size).join(taken, same)
    # How many words each repetition takes: the whole size, and in the last one what is left.
    times = F.transform(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size"))), lambda k: F.least(F.col("__size"), F.col("__taken") - (k - 1) * F.col("__size")))
    rows = rows.withColumn("__words", F.explode(times))
    found = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__words").cast("int"))
    between = F.slice(F.split("text", WORD, -1), F.lit(1), F.col("__words").cast("int"))
    head = F.array_join(F.zip_with(between, found, lambda b, w: F.concat(b, w)), "")
    part = F.col("__words") < F.col("__size")
    rows = rows.withColumn("text", F.when(part, head).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(part, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
c AS (SELECT *, 2 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM c),
t AS (
  SELECT *, least(cap::DOUBLE, (SELECT max(level) FROM l WHERE level <= cap::DOUBLE / w) * w) AS target FROM l),
g AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
x AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, CAST(floor(g.target - g.whole * g.source_size) AS BIGINT) AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken
FROM x
"""
