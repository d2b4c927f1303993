"""What a source must offer, how it is paced and retried, and a source that makes its own records."""

from __future__ import annotations

import inspect
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any, Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Connector(Protocol):
    cursor_safety_window_seconds: int

    def authenticate(self) -> None: ...
    def stream_records(self, cursor: dict | None, batch_size: int) -> Iterator[dict]: ...
    def describe_schema(self) -> list[dict]: ...
    def incremental_key(self, record: dict) -> datetime: ...


def validate(source: Any) -> list[str]:
    """What keeps an object from being a source; checked once, when it is registered."""
    faults = []
    for name, arity in (("authenticate", 0), ("stream_records", 2), ("describe_schema", 0), ("incremental_key", 1)):
        f = getattr(source, name, None)
        if not callable(f):
            faults.append(f"{name} is missing")
        elif len(inspect.signature(f).parameters) != arity:
            faults.append(f"{name} takes {arity} arguments")
    if callable(f := getattr(source, "stream_records", None)) and not inspect.isgeneratorfunction(f):
        faults.append("stream_records is no generator")
    if not isinstance(getattr(source, "cursor_safety_window_seconds", None), int):
        faults.append("cursor_safety_window_seconds is missing")
    return faults


def aware(t: datetime) -> datetime:
    """Times without a zone are refused."""
    if t.tzinfo is None or t.utcoffset() is None:
        raise ValueError("a time without a zone")
    return t


class TokenBucket:
    """``acquire`` waits until a token is there; the bucket fills at ``rate`` a second up to ``burst``."""

    def __init__(self, rate: float, burst: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if rate <= 0 or burst < 1:
            raise ValueError("rate above 0 and burst of 1 or more")
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = burst, clock()

    def acquire(self) -> None:
        while True:
            now = self.clock()
            self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
            if self.tokens >= 1:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


class Unavailable(Exception):
    """A request that may be tried again, perhaps after a number of seconds."""

    def __init__(self, status: int, retry_after: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.retry_after = status, retry_after


def retried(call: Callable[[], Any], tries: int = 3, base: float = 1.0, cap: float = 300.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """429 and 5xx are tried again, after what the server asks or an exponential wait, neither beyond the cap."""
    for k in range(tries + 1):
        try:
            return call()
        except Unavailable as e:
            if k == tries or not (e.status == 429 or e.status >= 500):
                raise
            sleep(min(cap, e.retry_after if e.retry_after is not None else base * 2**k))
    raise AssertionError


@dataclass(frozen=True)
class Corpus:
    """Sizes of the synthetic corpus by kind."""

    companies: int
    contacts: int
    deals: int
    tickets: int
    documents: int


STANDARD, COMPACT, SMOKE = Corpus(50, 200, 300, 500, 100), Corpus(5, 20, 30, 50, 10), Corpus(0, 10, 0, 0, 0)
SIZES = {"standard": STANDARD, "compact": COMPACT, "smoke": SMOKE}
_START = datetime(2026, 1, 1, tzinfo=timezone.utc)
CORPUS_SCHEMA = "kind string, source_id string, updated_at timestamp, name string, region string, amount double"


def corpus_rows(kind: str, n: int, offset: int) -> Iterator[tuple]:
    """The same rows in every run: the seed is the kind and the number."""
    for i in range(n):
        r = random.Random(f"{kind}:{i}")
        yield (kind, f"{kind[:2]}{i:05d}", _START + timedelta(hours=offset + i), f"{kind} {i}", r.choice(["eu-west", "us-east", "apac"]), round(r.uniform(10, 5000), 2))


class _Part(InputPartition):
    def __init__(self, kind: str, n: int, offset: int):
        self.kind, self.n, self.offset = kind, n, offset


class _Reader(DataSourceReader):
    def __init__(self, size: str, since: str | None):
        self.size, self.since = size, since

    def partitions(self) -> list[_Part]:
        sizes = vars(SIZES[self.size])
        return [_Part(kind, n, 1000 * k) for k, (kind, n) in enumerate(sizes.items()) if n]

    def read(self, part: _Part) -> Iterator[tuple]:
        since = datetime.fromisoformat(self.since) if self.since else None
        for row in corpus_rows(part.kind, part.n, part.offset):
            if since is None or row[2] > since:
                yield row


class CorpusSource(DataSource):
    """``spark.read.format("tallyloom_corpus").option("size", "compact").option("since", iso_time)``: one partition a kind."""

    @classmethod
    def name(cls) -> str:
        return "tallyloom_corpus"

    def schema(self) -> str:
        return CORPUS_SCHEMA

    def reader(self, schema: Any) -> _Reader:
        return _Reader(self.options.get("size", "standard"), self.options.get("since"))
