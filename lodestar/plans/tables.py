"""Query-first tables: one table per question, laid out so that the question reads little."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.window import latest_per_key


def write_query_table(
    df: DataFrame,
    target: str,
    partition_cols: Sequence[str],
    cluster_cols: Sequence[str | Column],
    buckets: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write rows grouped by partition columns and sorted by cluster columns inside each file.

    Low-cardinality keys become directories (``target`` is a path). The rebalance hint brings a
    directory's rows together, and lets Spark cut a large directory into several tasks of the
    advisory size and pack small ones into one. High-cardinality keys need ``buckets``: then
    ``target`` is a table name and rows are hashed into that many files.
    """
    order = [c if isinstance(c, Column) else F.col(c) for c in cluster_cols]
    keys = [F.col(c) for c in partition_cols]
    if buckets:
        if not all(isinstance(c, str) for c in cluster_cols):
            raise ValueError("bucketed tables sort by ascending column names")
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *partition_cols)
        writer.sortBy(*cluster_cols).mode(mode).saveAsTable(target)
        return
    laid_out = df.hint("rebalance", *partition_cols).sortWithinPartitions(*keys, *order)
    laid_out.write.mode(mode).partitionBy(*partition_cols).parquet(target)


def monthly_partition(df: DataFrame, ts: str, key: str, target: str) -> None:
    """Composite key (month, entity), which bounds how large one entity's partition can grow.

    The month is a directory. The entity may have millions of values, too many for directories:
    each file is sorted by it, so a filter on both prunes directories first and then row groups
    and pages by their stored ranges.
    """
    monthly = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    write_query_table(monthly, target, ["month"], [key, ts])


def pk_overwrite(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Load under a primary key: the last row per key wins."""
    return latest_per_key(df, list(keys), order)


def partition_count(df: DataFrame, key: str, value) -> DataFrame:
    """Count inside one partition."""
    return df.filter(F.col(key) == F.lit(value)).agg(F.count(F.lit(1)).alias("n"))
