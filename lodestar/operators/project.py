"""Projections, derived columns, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import case_above, right_closed


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    return df.withColumns(exprs)


def categorize(df: DataFrame, col: str, limits: Sequence[tuple[float, str]], default: str, out: str) -> DataFrame:
    """First matching ``col > limit`` names the category; limits are tried in the given order."""
    return df.withColumn(out, case_above(F.col(col), limits, default))


def cut(df: DataFrame, col: str, bounds: Sequence[float], labels: Sequence[str], out: str) -> DataFrame:
    """Bins ``(-inf, b1], (b1, b2], …, (bn, inf)`` with one label more than bounds."""
    return df.withColumn(out, right_closed(F.col(col), bounds, labels))


def threshold_filter(df: DataFrame, col: str, limit: float) -> DataFrame:
    """Rows strictly above the limit (nulls never pass)."""
    return df.filter(F.col(col) > F.lit(limit))


def filter_all(df: DataFrame, *preds: Column) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, preds))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def filter_between(df: DataFrame, col: str, low, high) -> DataFrame:
    """Closed range."""
    return df.filter(F.col(col).between(low, high))


def lookup(df: DataFrame, id_col: str, value) -> DataFrame:
    """Point lookup; cheap on a table written sorted or bucketed by ``id_col``."""
    return df.filter(F.col(id_col) == F.lit(value))


def nested_find(df: DataFrame, array_col: str, field: str, value, keep: Sequence[str]) -> DataFrame:
    """Documents whose nested list holds an element with ``field = value``."""
    return df.filter(F.exists(array_col, lambda e: e[field] == F.lit(value))).select(*keep)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: how many values are missing (one pass over the data)."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return unpivot_row(counts, df.columns, "column", "nulls")


def unpivot_row(df: DataFrame, cols: Sequence[str], key: str, value: str) -> DataFrame:
    return df.unpivot([], list(cols), key, value)


def fill_category(df: DataFrame, col: str, label: str) -> DataFrame:
    """A missing value becomes a category of its own."""
    return df.fillna({col: label})
