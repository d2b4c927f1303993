"""Readers of a vendor's objects as dumped or paged JSON: objects, associations, cursors, sub-resources, nested lines.

A transport yields pages; it is the one piece that needs a network, and any callable will do.  Pages are read where the
partitions are, one partition an object type, so the driver holds none of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .contract import TokenBucket, retried

#: (object, cursor or None) -> {"results": [...], "after": next cursor or absent}
Transport = Callable[[str, str | None], Mapping[str, Any]]
OBJECT_SCHEMA = "object string, id string, updated_at string, record string"


def pages(transport: Transport, kind: str, after: str | None = None, bucket: TokenBucket | None = None, tries: int = 3) -> Iterator[tuple[str | None, list[dict]]]:
    """(next cursor, records) page by page, paced and retried; a cursor that does not move ends the walk."""
    while True:
        if bucket:
            bucket.acquire()
        page = retried(lambda: transport(kind, after), tries)
        following = page.get("after")
        yield following, list(page.get("results", []))
        if following is None or following == after:
            return
        after = following


def time_pages(transport: Callable[[str, int], Mapping[str, Any]], kind: str, since: int, size: int) -> Iterator[list[dict]]:
    """Pages from a start time; a page that is not full is the last, and one that would repeat its start moves on by a second."""
    while True:
        page = retried(lambda: transport(kind, since))
        rows = list(page.get("results", []))
        yield rows
        if len(rows) < size:
            return
        since = max(int(page["end_time"]), since + 1)


def _rows(kind: str, records: Sequence[dict]) -> Iterator[tuple]:
    for r in records:
        yield kind, str(r.get("id")), r.get("updated_at"), json.dumps(r, sort_keys=True)


class _Objects(InputPartition):
    def __init__(self, kind: str, after: Any = None, upto: Any = None):
        self.kind, self.after, self.upto = kind, after, upto


class ObjectReader(DataSourceReader):
    def __init__(self, transport: Transport, kinds: Sequence[str], since: Mapping[str, str]):
        self.transport, self.kinds, self.since = transport, kinds, since

    def partitions(self) -> list[_Objects]:
        return [_Objects(k, self.since.get(k)) for k in self.kinds]

    def read(self, part: _Objects) -> Iterator[tuple]:
        for _, records in pages(self.transport, part.kind, part.after):
            yield from _rows(part.kind, records)


class ObjectStream(DataSourceStreamReader):
    """Offsets say, of each object, where its last page begins and how many records of that page were there.

    So a batch is what lies between two offsets, can be read again, and the next one goes on inside a page that has grown.
    """

    def __init__(self, transport: Transport, kinds: Sequence[str]):
        self.transport, self.kinds = transport, kinds

    def initialOffset(self) -> dict:  # noqa: N802
        return {k: ["", 0] for k in self.kinds}

    def latestOffset(self) -> dict:  # noqa: N802
        out = {}
        for kind in self.kinds:
            at, n = "", 0
            for following, records in pages(self.transport, kind):
                n = len(records)
                if following:
                    at, n = following, 0
            out[kind] = [at, n]
        return out

    def partitions(self, start: dict, end: dict) -> list[_Objects]:
        return [_Objects(k, start[k], end[k]) for k in self.kinds if start.get(k) != end.get(k)]

    def read(self, part: _Objects) -> Iterator[tuple]:
        (at, skip), (last, n) = part.after, part.upto
        for following, records in pages(self.transport, part.kind, at or None):
            yield from _rows(part.kind, records[skip : n if at == last else None])
            if at == last:
                return
            at, skip = following, 0


def object_source(name: str, transport: Transport, kinds: Sequence[str]) -> type[DataSource]:
    """A Python data source over a transport; ``option("object", kind)`` narrows it, ``option("since.<kind>", cursor)`` goes on."""

    class Objects(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return OBJECT_SCHEMA

        def _kinds(self) -> list[str]:
            one = self.options.get("object")
            if one is not None and one not in kinds:
                raise ValueError(f"no object {one}")
            return [one] if one else list(kinds)

        def reader(self, schema: Any) -> ObjectReader:
            return ObjectReader(transport, self._kinds(), {k: v for k in kinds if (v := self.options.get(f"since.{k}"))})

        def streamReader(self, schema: Any) -> ObjectStream:  # noqa: N802
            return ObjectStream(transport, self._kinds())

    return Objects


def discovered(objects: DataFrame, fallback: Sequence[str] = ()) -> DataFrame:
    """(object, property, n): the properties that an object's records have; the fallback where there are no records."""
    found = objects.select("object", F.explode(F.json_object_keys("record")).alias("property")).groupBy("object", "property").agg(F.count("*").alias("n"))
    if not fallback:
        return found
    static = objects.sparkSession.createDataFrame([(p,) for p in fallback], "property string")
    return found.unionByName(static.select(F.lit("*").alias("object"), "property", F.lit(0).cast("long").alias("n")))


def with_associations(records: DataFrame, key: str, links: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Records with the ids that are linked to each as an array (empty if there are none)."""
    ids = links.groupBy(F.col(left).alias(key)).agg(F.array_sort(F.collect_set(right)).alias(name))
    return records.join(ids, key, "left").withColumn(name, F.coalesce(name, F.array().cast(ids.schema[name].dataType)))


def sub_resources(parents: DataFrame, parent: str, nested: str) -> DataFrame:
    """A nested array's elements as rows, each with its parent's id and its place."""
    return parents.select(F.col(parent).alias("parent_id"), F.posexplode(nested).alias("position", "item")).select("parent_id", "position", "item.*")


def complete_lines(headers: DataFrame, key: str, embedded: str, more: DataFrame, line_key: str) -> DataFrame:
    """All lines of an invoice whose header embeds the first few: those, and of the separately paged ones what is new."""
    first = headers.select(key, F.explode(embedded).alias("line")).select(key, "line.*")
    rest = more.select(*first.columns).join(first.select(key, line_key), [key, line_key], "left_anti").dropDuplicates([key, line_key])
    return first.unionByName(rest)


#: What the shapes of a payment system's further objects keep: column to (path in the record, kind).
SHAPES: dict[str, dict[str, tuple[str, str]]] = {
    "charge": {"amount": ("$.amount", "cents"), "customer": ("$.customer", "text"), "paid": ("$.paid", "flag"), "created": ("$.created", "time")},
    "dispute": {"amount": ("$.amount", "cents"), "charge": ("$.charge", "text"), "reason": ("$.reason", "text"), "created": ("$.created", "time")},
    "payout": {"amount": ("$.amount", "cents"), "arrives": ("$.arrival_date", "time"), "status": ("$.status", "text")},
    "price": {"amount": ("$.unit_amount", "cents"), "product": ("$.product", "text"), "active": ("$.active", "flag")},
    "subscription": {"customer": ("$.customer", "text"), "status": ("$.status", "text"), "ends": ("$.current_period_end", "time")},
}


def shaped(objects: DataFrame, kind: str) -> DataFrame:
    """One kind of raw objects (object, id, record) as columns."""
    from ..functions.money import cents
    from ..functions.records import epoch_time

    def column(path: str, how: str):
        raw = F.get_json_object("record", path)
        return {"cents": cents(raw.try_cast("decimal(18,0)")), "text": raw, "flag": raw.try_cast("boolean"), "time": epoch_time(raw)}[how]

    return objects.where(F.col("object") == kind).select("id", *[column(p, how).alias(c) for c, (p, how) in SHAPES[kind].items()])


def mirrored(view: DataFrame, lens: str, source_tenant: str, tenant: str) -> DataFrame:
    """What one tenant sees through a lens, as rows of another tenant that say where they come from."""
    from ..functions.records import stable_uuid

    keys = F.concat_ws("\x1f", F.lit(source_tenant), F.lit(lens), F.to_json(F.struct(*view.columns)))
    return view.drop("tenant_id").withColumns({"mirror_id": stable_uuid(keys), "source_tenant": F.lit(source_tenant), "source_lens": F.lit(lens), "tenant_id": F.lit(tenant)})


def read_database(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int = 16, **options: str) -> DataFrame:
    """A database table by ranges of a numeric key, so that no one task reads it all."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.options(**options).load()


def catalogue(spark: SparkSession, prefix: str = "") -> DataFrame:
    """(name, kind, columns) of the views and tables whose names begin so."""
    rows = [(t.name, t.tableType, [c.name for c in spark.catalog.listColumns(t.name)]) for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return spark.createDataFrame(rows, "name string, kind string, columns array<string>")


def change_feed(events: DataFrame, key: str, at: str, event: str, processed: DataFrame, now, hours: int = 24) -> DataFrame:
    """Of a feed's events those of the last hours that were not processed, the newest one of each object.

    The feed is read again from before the cursor, for it delivers late and more than once; what was done is known by
    the events' ids.
    """
    fresh = events.where(F.col(at) >= now - F.make_dt_interval(hours=F.lit(hours))).join(processed.select(event), event, "left_anti")
    newest = fresh.groupBy(key).agg(F.max(F.struct(at, event)).alias("__n"), F.collect_set(event).alias("events"))
    return newest.select(key, F.col(f"__n.{at}").alias(at), F.array_sort("events").alias("events"))


def hydrated(changed: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Changed objects with their records as they are now; an object that is no more there is marked as deleted."""
    return changed.join(records.withColumn("__r", F.lit(True)), key, "left").withColumn("deleted", F.col("__r").isNull()).drop("__r")


def after_mark(records: DataFrame, created: str, key: str, mark: tuple) -> DataFrame:
    """Records past a high-water mark of (created, id): of one instant's records those with greater ids too."""
    at, last = mark
    return records.where((F.col(created) > at) | ((F.col(created) == at) & (F.col(key) > last)))


def revisions(objects: DataFrame, key: str, history: str) -> DataFrame:
    """(key, property, value, at) from records that group each property's versions: map<string, array<struct<value, at>>>."""
    each = objects.select(key, F.explode(history).alias("property", "versions"))
    return each.select(key, "property", F.explode("versions").alias("v")).select(key, "property", "v.value", "v.at")
