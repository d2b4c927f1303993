"""Money, dates and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(x: Column) -> Column:
    return F.round(x / F.lit(100), 2).cast("decimal(14,2)")


def whole_months(late: Column, early: Column) -> Column:
    """Calendar months between the months of two days; never a day count."""
    return (F.year(late) * 12 + F.month(late)) - (F.year(early) * 12 + F.month(early))


def tiered_rate(month: Column, anchor: Column, steps: Sequence[tuple[int, float]], last: float, unknown: float | None) -> Column:
    """The rate of the first step whose boundary (months past the anchor) lies after the month."""
    out = F.when(anchor.isNull(), F.lit(unknown))
    for months, rate in steps:
        out = out.when(month < F.add_months(anchor, months), F.lit(rate))
    return out.otherwise(F.lit(last))


def band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the first edge that x does not exceed; the last label is beyond all."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(x <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def decay(age_days: Column, half_life: float) -> Column:
    return 100 * F.pow(F.lit(0.5), age_days / F.lit(half_life))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision, JVM-side, over the shorter one's length; null if that is empty or zero."""
    a, b = F.slice(a, F.lit(1), F.least(F.size(a), F.size(b))), F.slice(b, F.lit(1), F.least(F.size(a), F.size(b)))
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))
