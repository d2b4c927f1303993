"""Common table expressions that a statement uses again and again, written once.

Spark puts a WITH relation's plan wherever it is named, so one that several others build on is computed as often as the
tree below the statement's end names it: with eight uses, a join of the two largest tables runs eight times.  Such
relations are written to the shared folder, in order, and read from there; each then is computed once, has a known size
by which its joins are planned, and survives a lost executor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder

#: A statement is heavy if it would compute some relation this often; others cost less as they are, for Spark prunes what
#: it scans again and reuses equal exchanges.
HEAVY = 6
#: Uses of a relation, counted through all that build on it, from which on a heavy statement's is written: aggregates are
#: small, so theirs is the lower number.
USES, AGGREGATE_USES = 4, 3


def split(sql: str) -> tuple[list[tuple[str, str]], str]:
    """(name, body) of the WITH relations of a statement, and what follows them."""
    found = re.match(r"\s*WITH\s+", sql)
    if not found:
        return [], sql
    at, out = found.end(), []
    while True:
        head = re.compile(r"\s*(\w+)\s+AS\s+\(").match(sql, at)
        if not head:
            raise ValueError(f"no WITH relation at {sql[at : at + 40]!r}")
        depth, quoted, end = 1, False, head.end()
        while depth:
            c = sql[end]
            quoted ^= c == "'"
            depth += 0 if quoted else (c == "(") - (c == ")")
            end += 1
        out.append((head[1], sql[head.end() : end - 1]))
        more = re.compile(r"\s*,").match(sql, end)
        if not more:
            return out, sql[end:]
        at = more.end()


def uses(parts: list[tuple[str, str]], rest: str) -> dict[str, tuple[int, int]]:
    """(places that name it, times that it would be computed) of each relation."""
    times, places = {}, {}
    for k in range(len(parts) - 1, -1, -1):
        name = parts[k][0]
        named = re.compile(rf"\b(?:FROM|JOIN)\s+{name}\b")
        by = [(len(named.findall(body)), times[user]) for user, body in parts[k + 1 :]] + [(len(named.findall(rest)), 1)]
        places[name], times[name] = sum(n for n, _ in by), sum(n * t for n, t in by)
    return {n: (places[n], times[n]) for n, _ in parts}


def chosen(parts: list[tuple[str, str]], rest: str) -> set[str]:
    """The relations that are worth writing."""
    out, count = set(), uses(parts, rest)
    if max((times for _, times in count.values()), default=0) < HEAVY:
        return out
    for name, (places, times) in count.items():
        body = dict(parts)[name]
        least = AGGREGATE_USES if re.search(r"\bGROUP BY\b", body) else USES if re.search(r"\b(JOIN|OVER)\b", body) else None
        if least and places >= 2 and times >= least:
            out.add(name)
    return out


def _named(columns: list[str], name: str, later: list[str]) -> list[str]:
    """The columns that what follows may read: all of them if something takes a star of it."""
    users = [t for t in later if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", t)]
    if any(re.search(r"SELECT\s+(?:DISTINCT\s+)?\*|\.\*", t) for t in users):
        return columns
    return [c for c in columns if any(re.search(rf"\b{c}\b", t) for t in users)]


def run(spark: SparkSession, sql: str) -> DataFrame:
    """The statement's result, its often used relations written first."""
    parts, rest = split(sql)
    write, kept = chosen(parts, rest), []
    text = lambda items, end: (f"WITH {', '.join(f'{n} AS ({b})' for n, b in items)} " if items else "") + end
    for k, (name, body) in enumerate(parts):
        if name in write:
            df = spark.sql(text(kept, body))
            df = df.select(*_named(df.columns, name, [b for _, b in parts[k + 1 :]] + [rest]))
            path = shared_folder(spark, name)
            df.write.parquet(path)
            spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
        else:
            kept.append((name, body))
    return spark.sql(text(kept, rest))
