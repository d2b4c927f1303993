"""Micro-batch ingest into current and history tables, windows over event time, and a period state machine."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.relational import distinct_on, latest_by
from ..operators.scd import merge
from ..session import Files

#: Seconds by which a cursor is set back, so that late records are seen again.
REWIND = 300
LOOKBACK_HOURS = 24


def rewound(cursor: Column, seconds: int = REWIND) -> Column:
    return cursor - F.make_interval(secs=F.lit(seconds))


def full_refresh(cursor_age_days: float | None, most: float = 25) -> bool:
    """Whether to read everything: no cursor, or one that is too old."""
    return cursor_age_days is None or cursor_age_days > most


def deduplicated(stream: DataFrame, key: str, at: str, late: str = f"{LOOKBACK_HOURS} hours") -> DataFrame:
    """Each event once, within a watermark that bounds the state."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def tumbling(df: DataFrame, at: str, width: str, keys: list[str], *aggregates: Column, slide: str | None = None) -> DataFrame:
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return df.groupBy(w, *keys).agg(*aggregates)


def sessions(df: DataFrame, at: str, gap: str, keys: list[str], *aggregates: Column) -> DataFrame:
    return df.groupBy(F.session_window(at, gap), *keys).agg(*aggregates)


class ScdSink:
    """A ``foreachBatch`` target: merges each batch into versioned current and history tables.

    Rows are dealt by a hash of the key into ``buckets``; a batch reads and writes only the buckets that it has rows of,
    to ``current/v=<batch>``, and its changes to ``history/batch=<batch>``.  ``manifest/<batch>`` then names the version
    of each bucket; the newest manifest is the state, so a new process goes on from where the last one ended, and a
    batch that is repeated after a failure begins from the manifest before it and writes the same again.  Versions that
    neither of the last two manifests names are removed.

    Of a batch's rows of a key the last by ``order`` counts, and only if it comes after the one that the table has: late
    rows change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], start: DataFrame, buckets: int = 16):
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path, keys, order, buckets
        self.files = Files(spark, path)
        self.schema = start.schema
        if self._state() is None:
            self._write(start.withColumn("__b", self._bucket()), -1)
            self._commit(-1, dict.fromkeys(range(buckets), -1))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").partitionBy("__b").parquet(f"{self.path}/current/v={version}")

    def _commit(self, batch_id: int, versions: dict[int, int]) -> None:
        self.files.write(f"manifest/{batch_id}", json.dumps(versions))

    def _state(self, before: int | None = None) -> tuple[int, dict[int, int]] | None:
        """(batch, version of each bucket) of the newest manifest, or of the newest before a batch."""
        known = [n for n in map(int, self.files.names("manifest")) if before is None or n < before]
        if not known:
            return None
        return max(known), {int(k): v for k, v in json.loads(self.files.read(f"manifest/{max(known)}")).items()}

    def _read(self, versions: dict[int, int]) -> DataFrame:
        have = [(v, k) for k, v in versions.items() if self.files.exists(f"current/v={v}/__b={k}")]
        out = self.spark.createDataFrame([], self.schema)
        for v in sorted({v for v, _ in have}):
            paths = [f"{self.path}/current/v={v}/__b={k}" for w, k in have if w == v]
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(*paths))
        return out

    def current(self) -> DataFrame:
        return self._read(self._state()[1])

    def history(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/history")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        _, versions = self._state(batch_id)
        rows = distinct_on(batch, self.keys, *[F.col(c).desc() for c in self.order]).withColumn("__b", self._bucket()).persist()
        try:
            touched = [r["__b"] for r in rows.select("__b").distinct().collect()]  # as many as there are buckets, at most
            before = self._read({k: versions[k] for k in touched})
            was = before.select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.struct(*self.order).alias("__was"))
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
            late = rows.join(was, same & (F.col("__was") >= F.struct(*self.order)), "left_anti")
            done = merge(before, late.drop("__b"), self.keys, F.lit(batch_id).cast("long"), "refreshed_at", silent=self.order)
            if touched:
                self._write(done.current.withColumn("__b", self._bucket()), batch_id)
            done.history.write.mode("overwrite").parquet(f"{self.path}/history/batch={batch_id}")
        finally:
            rows.unpersist()
        new = versions | dict.fromkeys(touched, batch_id)
        self._commit(batch_id, new)
        used = set(new.values()) | set(versions.values())
        for name in self.files.names("current"):
            if int(name.split("=")[1]) not in used:
                self.files.remove(f"current/{name}")


def ingest(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run all that is there, then stop."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def finish(stream: DataFrame, path: str, mode: str = "complete", keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all that is there and read what it put out.

    That is the last version in complete mode, the last row of each of ``keys`` in update mode, all rows in append mode.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("__batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/out/{batch_id}")

    query = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    spark, names = stream.sparkSession, sorted(map(int, Files(stream.sparkSession, path).names("out")))
    chosen = names[-1:] if mode == "complete" else names
    out = spark.read.parquet(*[f"{path}/out/{n}" for n in chosen])
    return (latest_by(out, keys, "__batch") if mode == "update" else out).drop("__batch")


def _states(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    closed, versions = state.get if state.exists else (False, 0)
    rows = pd.concat(batches)  # a key's rows come in several chunks, which are not in order among each other
    for kind in rows.sort_values(["ts", "event_id"])["event_type"]:
        if kind == "purchase":
            closed, versions = True, versions + 1
        elif kind == "error":
            closed = False
    state.update((bool(closed), int(versions)))
    name = "restated" if closed and versions > 1 else "closed" if closed else "blocked" if versions else "open"
    yield pd.DataFrame({"user_id": [key[0]], "state": [name], "versions": [versions]})


def period_states(stream: DataFrame) -> DataFrame:
    """open, closed, blocked and restated by key, kept as state across batches."""
    return stream.groupBy("user_id").applyInPandasWithState(_states, "user_id long, state string, versions long", "closed boolean, versions long", "update", GroupStateTimeout.NoTimeout)


def observed(df: DataFrame, name: str, **metrics: Any) -> DataFrame:
    """Run counters without another pass."""
    return df.observe(name, *[m.alias(k) for k, m in metrics.items()])
