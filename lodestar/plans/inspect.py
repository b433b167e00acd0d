"""Reading executed plans: does a query prune partitions, push filters, combine on the map side?"""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plan_text(df: DataFrame) -> str:
    """The physical plan, one node per line, as ``explain()`` prints it."""
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain()
    return printed.getvalue()


def partition_filters(df: DataFrame) -> list[str]:
    """What each file scan prunes by, in plan order (empty text: the scan lists everything)."""
    return [m.strip() for m in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_text(df))]


def pushed_filters(df: DataFrame) -> list[str]:
    return [m.strip() for m in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_text(df))]


def scan_warning(df: DataFrame) -> str | None:
    """A warning when some file scan of the query uses no partition column."""
    unpruned = sum(1 for filters in partition_filters(df) if not filters)
    if not unpruned:
        return None
    return f"{unpruned} scan(s) read every partition: filter on a partition column"


def partitions_read(stored: DataFrame, partition_cols: Sequence[str], questions: Mapping[str, Sequence[str | Column]]) -> DataFrame:
    """The full-scan guard: ``question``, ``n_read`` of ``n_all`` partitions, ``full_scan`` if that is all of them.

    A question is a list of conditions that must all hold. Only a condition that names nothing but partition columns can
    rule a partition out, so a mixed one (``a = 1 OR b > 2``) rules out none; one that is null for a partition rules it out, as a filter does. An
    unknown column is an error. The table's partition values are read, no other column; an empty table has no full scan.
    """
    parts = stored.select(*partition_cols).distinct()
    rows = []
    for name, conditions in questions.items():
        kept = F.lit(True)
        for condition in conditions:
            column = F.expr(condition) if isinstance(condition, str) else condition
            stored.filter(column)
            if _resolves(parts, column):
                kept = kept & column
        rows.append((name, F.count_if(F.coalesce(kept, F.lit(False)))))
    if not rows:
        raise ValueError("ask at least one question")
    wide = parts.agg(F.count(F.lit(1)).alias("n_all"), *[n.alias(f"_{i}") for i, (_, n) in enumerate(rows)])
    each = F.array(*[F.struct(F.lit(name).alias("question"), F.col(f"_{i}").alias("n_read")) for i, (name, _) in enumerate(rows)])
    counted = wide.select("n_all", F.inline(each))
    return counted.select("question", "n_read", "n_all", ((F.col("n_read") == F.col("n_all")) & (F.col("n_all") > 0)).alias("full_scan"))


def _resolves(df: DataFrame, condition: Column) -> bool:
    """Whether ``df`` has all columns of the condition (a filter would look below a projection, a selection does not)."""
    try:
        df.select(condition)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True
