"""Pieces that several operators share: scratch tables, streaming groups, byte views, components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark needs to be able to open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- scratch tables

_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Unset is allowed in local mode only (tests), where a temporary folder is put in the session's setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tallyloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{base}/tallyloom-{app}"
        atexit.register(_remove, spark, _ROOTS[app])
    return _ROOTS[app]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder.  At exit the JVM may be gone already; then there is nothing left to ask."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


#: All scratch tables of this process, in the order in which they were written.
_MADE: list[str] = []


def made() -> int:
    """How many scratch tables were written so far; for ``sweep``."""
    return len(_MADE)


def sweep(spark: SparkSession, since: int, keep: list[str]) -> None:
    """Delete the scratch tables that were written after ``made`` gave ``since``, once what was read from them is written itself."""
    for path in _MADE[since:]:
        if path not in keep:
            _remove(spark, path)


class Scratch:
    """Written tables that cut lineage; they outlive a lost executor, unlike a local checkpoint."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, scratch_root(spark), {}

    def cut(self, df: DataFrame, name: str, hashes: bool = False) -> DataFrame:
        """Write ``df`` and read it again.  A second table of the same name replaces the first one's place.

        With ``hashes`` no dictionaries are tried, which takes a third off the time to write values that hardly recur.
        """
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        df.write.option("parquet.enable.dictionary", str(not hashes).lower()).parquet(path)
        self.paths.setdefault(name, []).append(path)
        _MADE.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, keep_last: bool = False) -> None:
        """Delete the tables of these names (all but the newest one with ``keep_last``)."""
        for name in names:
            paths = self.paths.get(name, [])
            for path in paths[: len(paths) - keep_last]:
                _remove(self.spark, path)
            self.paths[name] = paths[len(paths) - keep_last :]


# ---------------------------------------------------------------- Arrow helpers


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column without copies: (all bytes, start of each row, end of each row); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = ends[:-1].copy(), ends[1:].copy()
    if column.null_count:
        null = np.asarray(column.is_null())
        ends[null] = starts[null]
    return raw, starts, ends


def give_back() -> None:
    """Return freed memory to the system, where the C library can; Python workers live on between tasks."""
    import ctypes

    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[tuple, pa.Table], dict | None], schema: str) -> DataFrame:
    """``fn(key, rows)`` over each group, as a stream over sorted partitions.

    Unlike ``applyInPandas`` it costs microseconds a group, which counts with many small groups.  The caller
    bounds the rows of a group; only one is in memory at a time.
    """
    from pyspark.sql.types import _parse_datatype_string  # noqa: PLC2701
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def emit(parts: list[dict]) -> pa.RecordBatch:
        columns = [pa.concat_arrays([pa.array(p[f.name], f.type) for p in parts]) for f in out]
        return pa.RecordBatch.from_arrays(columns, schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        ready: list[dict] = []
        rows = 0

        def cuts(t: pa.Table) -> np.ndarray:
            changed = np.zeros(max(0, len(t) - 1), bool)
            for k in keys:
                v = t.column(k).to_numpy()
                changed |= v[1:] != v[:-1]
            return np.flatnonzero(changed) + 1

        def take(t: pa.Table) -> None:
            nonlocal rows
            got = fn(tuple(t.column(k)[0].as_py() for k in keys), t)
            if got is not None:
                ready.append(got)
                rows += len(got[out[0].name])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            edges = cuts(held)
            if not len(edges):
                continue
            held = held.combine_chunks()
            begin = 0
            for end in edges.tolist():
                take(held.slice(begin, end - begin))
                begin = end
                if rows >= 20_000:
                    yield emit(ready)
                    ready, rows = [], 0
            held = held.slice(begin)
        if held is not None and len(held):
            take(held)
        if ready:
            yield emit(ready)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def block_pairs(df: DataFrame, key: str, member: str, count: str, size: int) -> DataFrame:
    """Give each row the block pairs (``block_i`` <= ``block_j``) in which it meets the other rows of its key.

    A key of ``count`` rows is split into ceil(count / size) blocks by a hash of ``member``; a row goes to each pair
    that holds its block (column ``block``), so each two rows of a key meet in just one pair, and no task gets more
    than two blocks.  Small keys have one block and so one pair.
    """
    blocks = F.ceil(F.col(count) / F.lit(size)).cast("int")
    df = df.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(member, F.lit(17)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    df = df.withColumn("other", other)
    return (
        df.withColumn("block_i", F.least("block", "other"))
        .withColumn("block_j", F.greatest("block", "other"))
        .drop("other", "blocks")
    )


#: Bits of the filter of ``maybe_in``: 1 MB, whatever the number of keys.
FILTER_BITS = 1 << 23


def maybe_in(df: DataFrame, key: str, keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys`` (one column): none that is is lost, few others stay.

    For wide rows that a join would shuffle in vain.  The filter is a bitmap of a fixed size, in rows of 4 KB, so it
    may be broadcast; with very many keys it lets more through, and the join that follows is what decides.
    """
    spot = lambda c: F.pmod(F.xxhash64(F.lit(29), c), F.lit(bits).cast("long"))
    spots = keys.select(spot(F.col(keys.columns[0])).alias("__s")).distinct()
    bitmap = spots.groupBy(F.bitmap_bucket_number("__s").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__s")).alias("__bits"))
    marked = df.withColumn("__s", spot(F.col(key))).withColumn("__bucket", F.bitmap_bucket_number("__s")).withColumn("__at", F.bitmap_bit_position("__s"))
    joined = marked.join(F.broadcast(bitmap), "__bucket")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.floor(byte / F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.col("__at") % 8 + 1).cast("int"))) % 2 == 1
    return joined.where(hit).select(*df.columns)


class Union:
    """Union-find over positions 0 to n-1; the root of a set is its smallest position."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        for a, b in zip(left.tolist(), right.tolist()):
            a, b = self.root(a), self.root(b)
            if a != b:
                self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], dtype=np.int64)


# ---------------------------------------------------------------- components


def components(scratch: Scratch, edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that links reach, for each node of ``edges`` (columns a, b).

    Alternates the large-star and small-star steps on whole tables (a logarithmic number of rounds), so neither the
    links nor the components ever come to the driver; each round is written, and ends when a round changes nothing.
    """
    a, b = F.col("a"), F.col("b")
    now = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = scratch.cut(now, name)
    seen = _checksum(now)
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where(b > a).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = scratch.cut(small.select("e.a", "e.b").where(a != b).distinct(), name)
        scratch.drop(name, keep_last=True)
        was, seen = seen, _checksum(now)
        if was == seen:
            break
    # By now each node but the smallest of its component points to that one.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.sum(F.shiftright(mixed, 20)), F.sum(mixed.bitwiseAND(0xFFFFF))).first()
    return tuple(row)
