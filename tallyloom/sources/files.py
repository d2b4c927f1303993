"""File sources with loose headers, and sinks with the semantics of keyed tables."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import distinct_on


def normal_header(name: str) -> str:
    return re.sub(r"[^a-z0-9]", "", name.lower())


def rename_headers(columns: list[str], aliases: dict[str, set[str]]) -> tuple[dict[str, str], list[str]]:
    """({column: field}, unknown columns); of columns for one field the first has it, further ones get a suffix."""
    by = {normal_header(a): f for f, names in aliases.items() for a in names | {f}}
    found, unknown, seen = {}, [], {}
    for c in columns:
        f = by.get(normal_header(c.split("\x00")[-1]))
        if f is None:
            unknown.append(c)
            continue
        seen[f] = seen.get(f, 0) + 1
        found[c] = f if seen[f] == 1 else f"{f}_{seen[f]}"
    return found, unknown


def read_report(spark: SparkSession, path: str, aliases: dict[str, set[str]], required: set[str]) -> tuple[DataFrame, list[str]]:
    """A CSV report with its headers mapped to fields; a missing required field is an error."""
    df = spark.read.csv(path, header=True, multiLine=True)
    # Spark renames headers that differ in case alone; their own names come from the first line.
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    names = next(csv.reader([spark.read.text(path).first()[0]]))
    found, unknown = rename_headers([f"{i}\x00{c}" for i, c in enumerate(names)], aliases)
    if missing := required - set(found.values()):
        raise ValueError(f"missing fields: {sorted(missing)}")
    return df.select(*[F.col(f"c{c.split(chr(0))[0]}").alias(f) for c, f in found.items()]), [c.split("\x00")[1] for c in unknown]


def read_json_folder(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Arrays, objects or line-delimited JSON; lines that do not parse come back with nulls and the raw text."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=not lines)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], order: str, columns: list[str] | None = None) -> DataFrame:
    """Latest wins by key; with ``columns`` only those are overwritten on a conflict."""
    last = distinct_on(incoming, keys, F.col(order).desc())
    if columns is None:
        return current.join(last.select(*keys), keys, "left_anti").unionByName(last.select(*current.columns))
    both = current.alias("c").join(last.withColumn("__i", F.lit(True)).alias("i"), keys, "full")
    out = [F.col(k) if k in keys else F.when(F.col("__i") & (F.lit(k in columns) | F.col(f"c.{order}").isNull()), F.col(f"i.{k}")).otherwise(F.col(f"c.{k}")).alias(k) for k in current.columns]
    return both.select(*out)


def insert_ignore(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows whose key the table does not have yet, each key once."""
    return incoming.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti")


def fill_missing(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Nulls of a column from another relation; what is there stays."""
    other = right.select(key, F.col(column).alias("__v")).dropDuplicates([key])
    return left.join(other, key, "left").withColumn(column, F.coalesce(column, "__v")).drop("__v").select(*left.columns)


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that the frame has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
