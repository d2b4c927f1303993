"""Sinks with the guarantees of tables: append-only, registry upsert, retention, vectors by namespace, small reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Files


class AppendOnly:
    """A table that can be added to and read, and no more: there is no way to change or remove a row.

    Each append has a name of its own; a name that is there already is refused, so that a repeated append neither
    doubles rows nor replaces them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema, self.files = spark, path, schema, Files(spark, path)

    def append(self, rows: DataFrame, name: str) -> bool:
        if self.files.exists(f"part={name}/_SUCCESS"):
            return False
        fitted = self.spark.createDataFrame([], self.schema).unionByName(rows)
        fitted.write.mode("overwrite").parquet(f"{self.path}/part={name}")  # what an append that failed has left
        return True

    def read(self) -> DataFrame:
        parts = [n for n in self.files.names("") if self.files.exists(f"{n}/_SUCCESS")]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in parts])

    def overwrite(self, *_: object) -> None:
        raise PermissionError("an append-only table")

    delete = update = overwrite


def upsert_registry(current: DataFrame, seen: DataFrame, keys: Sequence[str], latched: str = "is_custom") -> DataFrame:
    """A registry of properties: what is seen replaces what is known, but a flag once set stays; what is not seen stays."""
    both = current.alias("c").join(seen.withColumn("__s", F.lit(True)).alias("s"), list(keys), "full")
    flag = F.coalesce(F.col(f"c.{latched}"), F.lit(False)) | F.coalesce(F.col(f"s.{latched}"), F.lit(False))
    values = [flag.alias(c) if c == latched else F.when(F.col("__s"), F.col(f"s.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in current.columns if c not in keys]
    return both.select(*keys, *values).select(*current.columns)


def retained(df: DataFrame, at: str, now: Column, days: int = 45) -> DataFrame:
    """Without the rows that are older; rows without a time stay, for their age is not known."""
    return df.where(F.col(at).isNull() | (F.col(at) >= now - F.make_dt_interval(days=F.lit(days))))


def namespace(tenant: Column, client: Column) -> Column:
    """Where a tenant's vectors of a client lie; without a client, the tenant's own."""
    clean = lambda c: F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-")
    own = F.coalesce(F.nullif(F.trim(client), F.lit("")), F.lit("")) == ""
    return F.concat(F.lit("vec__"), clean(tenant), F.lit("__"), F.when(own, F.lit("_tenant")).otherwise(clean(client)))


def write_vectors(vectors: DataFrame, put: Callable[[str, list[tuple]], None], tenant: str, client: str, batch: int = 500) -> DataFrame:
    """Send vectors to an outer store by namespace, in batches, from where they are; (namespace, sent, failed) per task.

    A batch that the store refuses is counted and left: the tables hold the vectors too, and search falls back on them.
    """
    rows = vectors.withColumn("namespace", namespace(F.col(tenant), F.col(client))).select("namespace", "vec_id", "embedding")

    def send(batches: Iterator) -> Iterator:
        import pandas as pd

        for t in batches:
            for name, part in t.groupby("namespace"):
                sent = failed = 0
                for k in range(0, len(part), batch):
                    some = list(part.iloc[k : k + batch][["vec_id", "embedding"]].itertuples(index=False, name=None))
                    try:
                        put(name, some)
                        sent += len(some)
                    except Exception:  # noqa: BLE001 - the store is a copy
                        failed += len(some)
                yield pd.DataFrame({"namespace": [name], "sent": [sent], "failed": [failed]})

    return rows.mapInPandas(send, "namespace string, sent long, failed long").groupBy("namespace").agg(F.sum("sent").alias("sent"), F.sum("failed").alias("failed"))


#: Rows that a report may have; it is read by people.
MOST_ROWS = 10_000


def report(df: DataFrame, title: str, kind: str = "markdown") -> str:
    """A small result as Markdown or CSV text; one that is no report (more than MOST_ROWS rows) is refused, not cut."""
    rows = df.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows")
    shown = lambda v: "" if v is None else str(v)
    if kind == "csv":
        quoted = lambda v: '"' + shown(v).replace('"', '""') + '"' if any(c in shown(v) for c in ',"\n\r') else shown(v)
        return "".join(",".join(map(quoted, r)) + "\n" for r in [df.columns, *rows])
    cell = lambda v: shown(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", f"{len(rows)} rows", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join([*lines, *["| " + " | ".join(map(cell, r)) + " |" for r in rows]]) + "\n"
