"""Lens registry rows with filters, and tenants."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTIFIER = re.compile(r"[a-z_][a-z0-9_]*")
MOST_KEYS = 32
#: Columns that say where a row comes from, when, and which version it is; a lens may not filter by them.
RESERVED = frozenset({
    "id", "tenant_id", "client_id", "source_connector", "source_id", "ingested_at", "refreshed_at", "previous_version_id",
    "ingestion_batch_id", "authority", "created_at", "updated_at", "valid_from", "valid_to", "_valid_from", "_valid_to",
    "is_current", "history_id", "record_id", "changed_by", "change_reason",
})


class FilterError(ValueError):
    """A filter that may not be compiled."""


def compile_filter(config: dict[str, Any], columns: set[str]) -> Column:
    """An AND of equalities; null means IS NULL; an empty filter is true.  Everything else is refused before planning."""
    if not isinstance(config, dict):
        raise FilterError("a filter is an object")
    if len(config) > MOST_KEYS:
        raise FilterError(f"more than {MOST_KEYS} keys")
    out = F.lit(True)
    for key, value in config.items():
        if not isinstance(key, str) or key.startswith("$") or not IDENTIFIER.fullmatch(key):
            raise FilterError(f"not a column name: {key!r}")
        if key in RESERVED:
            raise FilterError(f"reserved column: {key}")
        if key not in columns:
            raise FilterError(f"unknown column: {key}")
        if value is not None and not isinstance(value, (str, int, float, bool)):
            raise FilterError(f"not a plain value: {key}")
        out = out & (F.col(key).isNull() if value is None else F.col(key) == F.lit(value))
    return out


@dataclass(frozen=True)
class Lens:
    name: str
    table: str
    tenant: str
    config: dict[str, Any] = field(default_factory=dict)


class Tenant:
    """The only way to rows of tenant tables.  An unset tenant sees no rows, never all of them."""

    def __init__(self, tenant: str | None):
        self.tenant = tenant or None

    def read(self, df: DataFrame) -> DataFrame:
        return df.where(F.lit(False) if self.tenant is None else F.col("tenant_id") == self.tenant)

    def check(self, df: DataFrame) -> DataFrame:
        """For writes: a row of another tenant fails the job."""
        if self.tenant is None:
            raise PermissionError("no tenant is set")
        fits = F.coalesce(F.col("tenant_id") == self.tenant, F.lit(False))
        return df.withColumn("tenant_id", F.when(fits, F.col("tenant_id")).otherwise(F.raise_error(F.lit("a row of another tenant"))))

    def apply(self, lens: Lens, tables: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
        if lens.tenant != self.tenant:
            raise PermissionError("a lens of another tenant")
        if lens.table not in tables:
            raise FilterError(f"not a lens table: {lens.table}")
        df = self.read(tables[lens.table])
        return df.where(compile_filter(lens.config, set(df.columns))).select(*(columns or df.columns))


#: (connector, from, to): the key under which a record's JSON names the other record.
ASSOCIATIONS = {("crm", "deal", "company"): "company_id", ("crm", "deal", "contact"): "contact_id", ("desk", "ticket", "contact"): "requester_id"}


def association(connector: str, source: str, target: str) -> str:
    try:
        return ASSOCIATIONS[connector, source, target]
    except KeyError:
        raise FilterError(f"no association {connector}: {source} to {target}") from None
