"""The sync loop around a stream: mutual exclusion, failure budget, quarantine, text hooks, run table and heartbeat."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import Files
from ..sources.contract import Unavailable, retried


class Busy(RuntimeError):
    """Another run of the same tenant and connector goes on."""


@contextmanager
def exclusive(spark: SparkSession, root: str, tenant: str, connector: str, stale_after: float = 6 * 3600, clock: Callable[[], float] = time.time) -> Iterator[None]:
    """One run at a time of a tenant and connector, by a file in the shared store; a dead run's file is taken over when it is stale."""
    files, name, mine = Files(spark, root), f"locks/{tenant}--{connector}", uuid.uuid4().hex
    if files.exists(name) and clock() - json.loads(files.read(name))["at"] > stale_after:
        files.remove(name)
    if not files.write(name, json.dumps({"run": mine, "at": clock()}), replace=False):
        raise Busy(f"{tenant}: {connector} is running")
    try:
        yield
    finally:
        if files.exists(name) and json.loads(files.read(name))["run"] == mine:
            files.remove(name)


@dataclass
class Run:
    """A row of the run table."""

    tenant: str
    connector: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    status: str = "running"
    started: float = field(default_factory=time.time)
    ended: float | None = None
    seen: int = 0
    created: int = 0
    updated: int = 0
    unchanged: int = 0
    rejected: int = 0
    failed_batches: int = 0
    error: str | None = None


RUN_SCHEMA = (
    "tenant string, connector string, run_id string, status string, started double, ended double, seen long, created long, updated long, "
    "unchanged long, rejected long, failed_batches long, error string"
)


class RunTable:
    """Runs as files of one row each: written when a run begins and again when it ends."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root, Files(spark, root)

    def write(self, run: Run) -> None:
        self.files.write(f"runs/{run.run_id}.json", json.dumps(asdict(run)))

    def read(self) -> DataFrame:
        if not self.files.names("runs"):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).json(f"{self.root}/runs")

    def last_success(self, tenant: str, connector: str) -> DataFrame:
        """The start of the last run that ended well: where the next one's cursor is set back from."""
        ok = self.read().where((F.col("tenant") == tenant) & (F.col("connector") == connector) & (F.col("status") == "success"))
        return ok.agg(F.max("started").alias("since"))


class Heartbeat(StreamingQueryListener):
    """Keeps what a stream says of its progress, newest last."""

    def __init__(self, most: int = 1000):
        self.beats: list[dict] = []
        self.most = most

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._add(kind="started", id=str(event.id), at=event.timestamp)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._add(kind="progress", id=str(p.id), at=p.timestamp, batch=p.batchId, rows=p.numInputRows)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._add(kind="ended", id=str(event.id), error=event.exception)

    def _add(self, **beat) -> None:
        self.beats = [*self.beats, beat][-self.most :]


def quarantined(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``faults``): a check that is false or null is a fault."""
    faults = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    marked = df.withColumn("faults", faults)
    return marked.where(F.size("faults") == 0).drop("faults"), marked.where(F.size("faults") > 0)


#: What a text for the knowledge index must say of itself.
REQUIRED = ("tenant_id", "source_id", "kind", "title", "updated_at")


def knowledge_texts(records: DataFrame, texts: Column, metadata: Column) -> DataFrame:
    """The texts that records give (an array of structs: part, text), each with its metadata; a missing required member fails the job.

    A record whose text is wrong is its own matter; metadata that are wrong would put texts where the wrong tenant
    finds them, so they are fatal.
    """
    out = records.select(metadata.alias("metadata"), F.explode(texts).alias("t")).select("metadata", "t.part", "t.text").where(F.length(F.trim("text")) > 0)
    wrong = F.lit(False)
    for name in REQUIRED:
        member = F.col("metadata").getField(name)
        wrong = wrong | member.isNull() | (F.trim(member.cast("string")) == "")
    zone = ~F.col("metadata").getField("updated_at").cast("string").rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return out.withColumn("text", F.when(wrong | zone, F.raise_error(F.lit("metadata of a text are incomplete"))).otherwise(F.col("text")))


#: Failed batches in a row after which a run ends as partial.
FAILED_IN_A_ROW = 3


def run(
    table: RunTable, tenant: str, connector: str, batches: Iterator[DataFrame] | Sequence[DataFrame], put: Callable[[DataFrame, int], dict[str, int]],
    checks: dict[str, Column] | None = None, reject: Callable[[DataFrame, int], None] | None = None, sleep: Callable[[float], None] = time.sleep,
) -> Run:
    """One sync: each batch through the checks into ``put`` (which returns counters), its bad rows into ``reject``.

    A batch that the store refuses for now is tried again three times; one that fails is counted and left, and after
    ``FAILED_IN_A_ROW`` in a row the run stops.  It ends as success, partial (some batches failed) or failed (all did).
    """
    r, in_a_row, done = Run(tenant, connector), 0, 0
    with exclusive(table.spark, table.root, tenant, connector):
        table.write(r)
        for k, batch in enumerate(batches):
            try:
                good, bad = quarantined(batch, checks or {})
                counts = retried(lambda: put(good, k), 3, sleep=sleep)  # noqa: B023
                if checks:
                    r.rejected += bad.count()
                    if reject:
                        reject(bad, k)
            except Exception as e:  # a batch's fault is not the run's
                r.failed_batches, in_a_row, r.error = r.failed_batches + 1, in_a_row + 1, f"{type(e).__name__}: {e}"[:500]
                if isinstance(e, (KeyboardInterrupt, Unavailable)) and getattr(e, "status", 0) in (401, 403):
                    break
                if in_a_row >= FAILED_IN_A_ROW:
                    break
                continue
            in_a_row, done = 0, done + 1
            for name, n in counts.items():
                setattr(r, name, getattr(r, name) + n)
        r.status = "failed" if r.failed_batches and not done else "partial" if r.failed_batches else "success"
        r.ended = time.time()
        table.write(r)
    return r


def backfill(source: DataFrame, current: DataFrame, history: DataFrame, keys: Sequence[str], at: str, batch: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """(revisions to append to a history, revisions of records that are not there).

    Known revisions are left out, so a backfill can be repeated; ids are joined once, not looked up one by one.
    """
    fresh = source.dropDuplicates([*keys, at]).join(history.select(*keys, at), [*keys, at], "left_anti")
    known = fresh.join(current.select(*keys).distinct(), list(keys), "left_semi")
    return known, fresh.join(current.select(*keys).distinct(), list(keys), "left_anti")
