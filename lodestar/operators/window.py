"""Per-key ranking, latest row, previous value, and the cumulative tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.operators.ordered import value_ranks

#: Parts that a key is ranked in before a large top-k.
_SALTS = 64


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows of an order; planned as a bounded heap per task, not as a full sort."""
    return df.orderBy(*order).limit(n)


def topk_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column], k: int, out: str = "place") -> DataFrame:
    """First k rows per key with their place.

    Spark limits each task to k rows per key before the shuffle (``WindowGroupLimit``), so a
    hot key costs k rows per task there. It does so for k up to a setting (1000 by default); for a larger k the rows of a
    key are ranked in ``_SALTS`` parts first, of which k rows each go on.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        part = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
        df = salted.withColumn("_place", part).filter(F.col("_place") <= k).drop("_salt", "_place")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= k)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key: one aggregate with map-side combining."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def previous_value(df: DataFrame, key: str, order: Sequence[str], value: str, bucket: Column, out: str = "previous") -> DataFrame:
    """Value of the preceding row of the same key.

    Rows are sorted per key and ``bucket``, an expression that rises with the order (null where the first order column
    is null), such as the minute of a time stamp, so a hot key spreads over as many tasks as it
    has buckets. The first row of a bucket takes the last value of the key's preceding bucket, from a table with
    one row per (key, bucket). Null buckets come first, as nulls do in the order.
    """
    marked = df.withColumn("_b", bucket)
    inside = Window.partitionBy(key, "_b").orderBy(*order)
    rows = marked.withColumn("_in", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    ends = marked.groupBy(key, "_b").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_end"))
    carried = ends.select(
        F.col(key).alias("_k"), F.col("_b").alias("_kb"), F.lag("_end").over(Window.partitionBy(key).orderBy("_b")).alias("_carry")
    ).filter("_carry is not null")
    return (
        rows.join(carried, F.col(key).eqNullSafe(F.col("_k")) & F.col("_b").eqNullSafe(F.col("_kb")), "left")
        .withColumn(out, F.coalesce("_in", "_carry")["v"])
        .select(*df.columns, out)
    )


def alert_columns(df: DataFrame, value: str, pct: float, strict: bool = False) -> DataFrame:
    """Relative change against ``previous`` in percent; keep changes of at least ``pct``.

    From a previous value of zero there is no relative change, hence no alert.
    """
    change = F.try_divide(F.col(value) - F.col("previous"), F.col("previous")) * 100
    size = F.abs(F.col("change_pct"))
    return (
        df.withColumn("change_pct", change)
        .filter(size > pct if strict else size >= pct)
        .withColumn("direction", F.when(F.col("change_pct") > 0, "up").otherwise("down"))
    )


def change_alert(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    bucket: Column,
    pct: float = 0.05,
    strict: bool = False,
) -> DataFrame:
    """Rows whose value moved by at least ``pct`` percent since the key's previous row."""
    return alert_columns(previous_value(df, key, order, value, bucket), value, pct, strict)


def cumulative(df: DataFrame, col: str) -> DataFrame:
    """Count, cumulative count, frequency and cumulative frequency per distinct value."""
    return value_ranks(df, col).select(
        col,
        "n",
        (F.col("below") + F.col("n")).alias("cum_n"),
        (F.col("n") / F.col("total")).alias("freq"),
        ((F.col("below") + F.col("n")) / F.col("total")).alias("cum_freq"),
    )


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """Steps of the empirical distribution with the outer points (min-1, 0) and (max+1, 1)."""
    steps = cumulative(df, col).select(F.col(col).cast("double").alias("x"), F.col("cum_freq").alias("f"))
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    outer = ends.select(
        F.inline(
            F.array(
                F.struct((F.col("lo") - 1).alias("x"), F.lit(0.0).alias("f")),
                F.struct((F.col("hi") + 1).alias("x"), F.lit(1.0).alias("f")),
            )
        )
    )
    return steps.unionByName(outer)


def avg_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Rank of every distinct value, ties sharing their average rank."""
    return value_ranks(df, col).select(col, "n", (F.col("below") + (F.col("n") + 1) / 2).alias(out))
