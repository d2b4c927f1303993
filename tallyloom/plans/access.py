"""Who may see and change what: roles with grants on lenses, changes to named columns, a lint of joins."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Role:
    """A role sees the lenses that it was granted, never the tables under them, and changes the columns that it was granted."""

    name: str
    lenses: set[str] = field(default_factory=set)
    columns: dict[str, set[str]] = field(default_factory=dict)

    def grant(self, *lenses: str) -> Role:
        self.lenses |= set(lenses)
        return self

    def grant_update(self, table: str, *columns: str) -> Role:
        self.columns.setdefault(table, set()).update(columns)
        return self


class Gate:
    """The tables and lenses of an engine, as a role may use them."""

    def __init__(self, tables: dict[str, DataFrame], lenses: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]):
        self._tables, self._lenses = tables, lenses

    def select(self, role: Role, name: str) -> DataFrame:
        if name in self._tables and name not in self._lenses:
            raise PermissionError(f"{role.name} may not read table {name}")
        if name not in role.lenses or name not in self._lenses:
            raise PermissionError(f"{role.name} may not read lens {name}")
        return self._lenses[name](self._tables)

    def update(self, role: Role, table: str, where: Column, values: dict[str, Column]) -> DataFrame:
        """The table after the change; any column that was not granted refuses all of it."""
        if missing := set(values) - role.columns.get(table, set()):
            raise PermissionError(f"{role.name} may not change {sorted(missing)} of {table}")
        df, hit = self._tables[table], F.coalesce(where, F.lit(False))
        kinds = dict(df.dtypes)
        self._tables[table] = df.withColumns({c: F.when(hit, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in values.items()})
        return self._tables[table]


#: Joins that must not be written: what they look like and what to use.
BANNED_JOINS = {
    r"\bexists\s*\(\s*select[^)]*\bwhere[^)]*=\s*any\s*\(": "an uncorrelated semi join on the association's key",
    r"\bjoin\s+\w+_legacy\b": "the identity links, not the retired foreign keys",
    r"\bon\s+1\s*=\s*1\b": "a cross join that says so, with a one-row side",
    r"\bjoin\b[^;]*?\bon\s+[^;]*?\blower\s*\([^)]*email[^)]*\)\s*=": "the identity links: a mailbox is no key",
}


def lint_joins(sql: str, banned: dict[str, str] = BANNED_JOINS) -> list[str]:
    """What to use in place of the banned joins of a statement; comments and string literals do not count."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)
    bare = re.sub(r"'(?:[^']|'')*'", "''", bare)
    return [use for pattern, use in banned.items() if re.search(pattern, bare, re.I | re.S)]
