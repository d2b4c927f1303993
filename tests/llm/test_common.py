import random

import pyarrow as pa
from pyspark.sql import functions as F

from tallyloom.llm import common


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5200)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in common.components(common.Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert common.components(common.Scratch(spark), spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_filter_loses_nothing(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k").withColumn("text", F.lit("x"))
    keys = spark.range(0, 20_000, 97).withColumnRenamed("id", "other")
    got = [r.k for r in common.maybe_in(df, "k", keys).collect()]
    assert set(range(0, 20_000, 97)) <= set(got) and len(got) < 300
    assert {r.k for r in common.maybe_in(df, "k", keys, 1 << 15).collect()} >= set(range(0, 20_000, 97))
    assert common.maybe_in(df, "k", keys.where("false")).count() == 0


def test_each_two_rows_of_a_key_meet_once(spark):
    df = spark.range(90).select((F.col("id") % 2).alias("k"), F.col("id").alias("x"), F.lit(45).cast("long").alias("m"))
    pairs = common.block_pairs(df, "k", "x", "m", 10).groupBy("k", "block_i", "block_j").agg(F.collect_list(F.struct("x", "block")).alias("rows")).collect()
    seen = []
    for p in pairs:
        left, right = [r.x for r in p.rows if r.block == p.block_i], [r.x for r in p.rows if r.block == p.block_j]
        seen += [(a, b) for a in left for b in right if p.block_i != p.block_j or a < b]
    assert len(seen) == len({frozenset(s) for s in seen}) == 2 * 45 * 44 // 2


def test_groups_that_span_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(500).select((F.col("id") % 13).alias("k"), F.col("id").alias("x"))
        out = common.map_groups(df, ["k"], lambda key, t: {"k": [key[0]], "n": [len(t)], "s": [sum(t.column("x").to_pylist())]}, "k long, n long, s long")
        assert {(r.k, r.n, r.s) for r in out.collect()} == {(k, len(range(k, 500, 13)), sum(range(k, 500, 13))) for k in range(13)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_views_of_sliced_columns():
    a = pa.array(["skip", "é", None, "", "abc"]).slice(1)
    raw, starts, ends = common.utf8_view(a)
    assert [bytes(raw[s:e]).decode() for s, e in zip(starts, ends)] == ["é", "", "", "abc"]
