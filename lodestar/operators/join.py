"""Equi-joins, referential checks and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join a dimension on a shared column name (kept once).

    No broadcast hint: Spark broadcasts a side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts or hashes, with adaptive
    splitting of skewed partitions. Works with a streaming left side as well.
    """
    return df.join(dim, on=key, how=how)


def resolve_edges(edges: DataFrame, vertices: DataFrame, src: str, dst: str, id_col: str) -> DataFrame:
    """Keep only edges whose two ends both exist."""
    ids = vertices.select(id_col)
    from_known = edges.join(ids.withColumnRenamed(id_col, src), src, "left_semi")
    return from_known.join(ids.withColumnRenamed(id_col, dst), dst, "left_semi").select(*edges.columns)


def dangling_edges(edges: DataFrame, vertices: DataFrame, src: str, dst: str, id_col: str) -> DataFrame:
    """Edges with at least one unknown end, with a flag per end."""
    known = vertices.select(id_col).distinct()
    left = known.withColumnRenamed(id_col, "_s").withColumn("_has_src", F.lit(True))
    right = known.withColumnRenamed(id_col, "_d").withColumn("_has_dst", F.lit(True))
    return (
        edges.join(left, F.col(src) == F.col("_s"), "left")
        .join(right, F.col(dst) == F.col("_d"), "left")
        .withColumn("missing_src", F.col("_has_src").isNull())
        .withColumn("missing_dst", F.col("_has_dst").isNull())
        .filter("missing_src or missing_dst")
        .drop("_s", "_d", "_has_src", "_has_dst")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
