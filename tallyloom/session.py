"""Sessions and base tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Settings the engine's results rest on; the rest is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "tallyloom", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; times without a zone are taken as UTC, once, here."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that executors share, ``spark.checkpoint.dir``; in local mode a temporary one if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tallyloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder at exit, if there is still a JVM to ask."""
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        Files(spark, path).remove("")


class Files:
    """Small files beside tables, in whatever store Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm, self._conf = root, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self._conf)

    def exists(self, name: str) -> bool:
        path, fs = self._at(name)
        return fs.exists(path)

    def names(self, folder: str) -> list[str]:
        path, fs = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def read(self, name: str) -> str:
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = True) -> bool:
        """Whole or not at all: under another name first.  Without ``replace`` a file that is there stays, and the answer is False."""
        path, fs = self._at(name)
        part, _ = self._at(f"{name}.{uuid.uuid4().hex}.part")
        if not replace and fs.exists(path):
            return False
        stream = fs.create(part, True)
        stream.write(text.encode())
        stream.close()
        if replace:
            fs.delete(path, False)
        if fs.rename(part, path):
            return True
        fs.delete(part, False)
        return False

    def remove(self, name: str) -> bool:
        path, fs = self._at(name)
        return fs.delete(path, True)


def views(spark: SparkSession, sf_dir: str, sql: str) -> None:
    """Register the base tables that a statement names.  A view is resolved when the statement is; later ones may replace it."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            read(spark, sf_dir, name).createOrReplaceTempView(name)
