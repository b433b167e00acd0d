"""Small column expressions shared by the operators. All stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_above(x: Column, limits: Sequence[tuple[float, str]], default: str) -> Column:
    """``label`` of the first limit that ``x`` strictly exceeds, else ``default``."""
    (first, label), *rest = limits
    case = F.when(x > F.lit(first), F.lit(label))
    for limit, name in rest:
        case = case.when(x > F.lit(limit), F.lit(name))
    return case.otherwise(F.lit(default))


def right_closed(x: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin that holds ``x``; null stays null."""
    if len(labels) != len(bounds) + 1 or list(bounds) != sorted(bounds):
        raise ValueError("bounds must ascend and labels must be one more than bounds")
    case = F.when(x.isNull(), F.lit(None).cast("string"))
    for bound, name in zip(bounds, labels):
        case = case.when(x <= F.lit(bound), F.lit(name))
    return case.otherwise(F.lit(labels[-1]))


def position_of(x: Column, order: Sequence[str]) -> Column:
    """0-based place of a label in an ordinal scale (null when unknown)."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), x)
    return F.when(place > 0, place - 1)


def money(x: Column) -> Column:
    """Exact two-digit amount: sums of it do not depend on the order of addition."""
    return x.cast("decimal(18,2)")


def percent(flag: Column) -> Column:
    """Share of true among the non-null flags, as a whole percentage."""
    return F.round(F.avg(flag.cast("int")) * 100).cast("int")
