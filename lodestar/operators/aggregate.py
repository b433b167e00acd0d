"""Grouped aggregates, contingency tables and agreement measures.

Every aggregate here combines on the map side, so a key that holds a third of all rows sends
one partial row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.columns import money, percent, position_of
from lodestar.operators.ordered import number_records


def excess_count(df: DataFrame, key: str, value: str, limit: float) -> DataFrame:
    """Rows per key whose value is strictly above the limit, most first; ties by key."""
    return (
        df.filter(F.col(value) > F.lit(limit))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("excess"))
        .orderBy(F.desc("excess"), key)
    )


def excess_count_sql(spark: SparkSession, df: DataFrame, key: str, value: str, limit: float) -> DataFrame:
    """The SQL twin of :func:`excess_count`; both give the same optimised plan."""
    return spark.sql(
        f"SELECT `{key}`, count(1) AS excess FROM {{readings}} WHERE `{value}` > {float(limit)}D "
        f"GROUP BY `{key}` ORDER BY excess DESC, `{key}`",
        readings=df,
    )


def row_counts(**dfs: DataFrame) -> DataFrame:
    """One row per named table with its number of rows."""
    parts = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, d in dfs.items()]
    return reduce(DataFrame.unionByName, parts)


def distinct_count(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(col).alias(out))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def mean_by_key(df: DataFrame, key: str, cols: dict[str, Column], digits: int) -> DataFrame:
    """Rounded means of several measures per key. Measures should be decimals (see README)."""
    return df.groupBy(key).agg(*[F.round(F.avg(c), digits).cast("double").alias(n) for n, c in cols.items()])


def rollup_sum(df: DataFrame, group: str, col: str, out: str | None = None) -> DataFrame:
    """Sum finished counts at a coarser level."""
    return df.groupBy(group).agg(F.sum(col).alias(out or col))


def totals(df: DataFrame, keys: str | Sequence[str], amount: str) -> DataFrame:
    """Sales and exact revenue per key, both still addable (revenue stays decimal).

    Reduce facts with this by their join key before dimensions come in: the join then meets one
    row per key, however many sales a single store has.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("sales"), F.sum(money(F.col(amount))).alias("revenue"))


def revenue_by(sums: DataFrame, group: str | Sequence[str]) -> DataFrame:
    """Number of sales and revenue per group from :func:`totals`, largest revenue first."""
    group = [group] if isinstance(group, str) else list(group)
    return (
        sums.groupBy(*group)
        .agg(F.sum("sales").alias("sales"), F.sum("revenue").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), *group)
    )


def nested_revenue(sums: DataFrame, outer: str, inner: str) -> DataFrame:
    """One document per ``outer`` with a sorted list of its ``inner`` totals, from :func:`totals`.

    Two levels: (outer, inner) first, so the list has one entry per inner value (a store, a
    nation), not per row.
    """
    small = sums.groupBy(outer, inner).agg(F.sum("sales").alias("sales"), F.sum("revenue").alias("_revenue"))
    entry = F.struct(F.col(inner), F.col("sales"), F.col("_revenue").cast("double").alias("revenue"))
    return small.groupBy(outer).agg(
        F.sum("sales").alias("sales"),
        F.sum("_revenue").cast("double").alias("revenue"),
        F.array_sort(F.collect_list(entry)).alias("parts"),
    )


def max_having(df: DataFrame, key: str, col: str, limit: float) -> DataFrame:
    """Largest value per key, only for keys whose largest value exceeds the limit."""
    return df.groupBy(key).agg(F.max(col).alias("largest")).filter(F.col("largest") > F.lit(limit))


def functional_ranges(df: DataFrame, label: str, value: str) -> DataFrame:
    """Value range per label, and whether it stays below the next label's range.

    The ranges are numbered in their order, without a window over all labels, and meet their successor by number.
    """
    ranges = df.groupBy(label).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n")
    )
    numbered = number_records(ranges, ["low", "high", label], "_rank")
    after = numbered.select((F.col("_rank") - 1).alias("_rank"), F.col("low").alias("_next"))
    overlaps = F.coalesce(F.col("_next") <= F.col("high"), F.lit(False))
    return numbered.join(after, "_rank", "left").select(label, "low", "high", "n", overlaps.alias("overlaps_next"))


def counter(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def pct_flag(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """Rows per key and the whole percentage of true flags (null flags count as rows only)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("messages"), percent(flag).alias("pct"))


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    return counter(df, key).orderBy(F.desc("n"), key).limit(n)


def _both_known(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())


def crosstab(df: DataFrame, a: str, b: str, values: Sequence[str], margins: bool = False) -> DataFrame:
    """Contingency table, one column per level of ``b``.

    ``values`` are given, so no extra job looks for them. With ``margins`` a ``Sum`` row and a
    ``Sum`` column are added through one cube. Rows that miss a level do not count.
    """
    df = _both_known(df, a, b)
    if not margins:
        return df.groupBy(a).pivot(b, list(values)).agg(F.count(F.lit(1))).fillna(0)
    # The cube expands every row to four, so it runs over the cells.
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("_c"))
    cubed = cells.cube(a, b).agg(F.sum("_c").alias("_n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    named = cubed.select(
        F.when(F.col("_ga") == 1, "Sum").otherwise(F.col(a)).alias(a),
        F.when(F.col("_gb") == 1, "Sum").otherwise(F.col(b)).alias("_b"),
        "_n",
    )
    return named.groupBy(a).pivot("_b", [*values, "Sum"]).agg(F.sum("_n")).fillna(0)


def frequencies(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table with joint, marginal and both conditional frequencies.

    The margins are aggregates of the reduced table (levels of a × levels of b), joined back.
    """
    cells = _both_known(df, a, b).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n")).scalar()
    n_a, n_b = F.col("_na"), F.col("_nb")
    margins = cells.join(cells.groupBy(a).agg(F.sum("n").alias("_na")), a).join(cells.groupBy(b).agg(F.sum("n").alias("_nb")), b)
    return margins.select(
        a,
        b,
        "n",
        n_a.alias("n_a"),
        n_b.alias("n_b"),
        (F.col("n") / total).alias("joint"),
        (F.col("n") / n_a).alias("b_given_a"),
        (F.col("n") / n_b).alias("a_given_b"),
    )


def accuracy(df: DataFrame, truth: str, pred: str, order: Sequence[str]) -> DataFrame:
    """Share of exact hits, and of hits within one step of the ordinal scale."""
    distance = F.abs(position_of(F.col(truth), order) - position_of(F.col(pred), order))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"),
        F.avg((distance <= 1).cast("double")).alias("within_one"),
    )
