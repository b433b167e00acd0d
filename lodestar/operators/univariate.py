"""One-variable statistics. Every result is a small DataFrame; every pass is an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.ordered import _attach, prefix_sum, quantile_columns, quantile_table
from lodestar.operators.project import unpivot_row

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def freq_table(df: DataFrame, col: str) -> DataFrame:
    """Count and relative frequency per value; missing values do not count."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("freq", F.col("n") / total)


def modes(df: DataFrame, col: str) -> DataFrame:
    """All values that share the largest count; missing values do not count."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") == counts.agg(F.max("n")).scalar())


def describe_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std (n-1), min, exact quartiles, max.

    One pass gives the moments of every column; the quartiles of all columns share two more.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = numbers.agg(*[F.struct(*[f(c).alias(m) for m, f in measures.items()]).alias(c) for c in cols])
    base = row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.*")) for c in cols])))
    marks = quantile_table(df, cols, QUARTILES)
    # A column of nulls has no quartiles but a row.
    return base.join(marks, "column", "left").select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per text column: count, distinct values, first and last value in order, shortest and longest length."""
    measures = {"count": F.count, "distinct": F.count_distinct, "min": F.min, "max": F.max,
                "min_length": lambda c: F.min(F.length(c)), "max_length": lambda c: F.max(F.length(c))}
    row = df.agg(*[F.struct(*[f(F.col(c)).alias(m) for m, f in measures.items()]).alias(f"_{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}.*")) for i, c in enumerate(cols)])))


def spread(df: DataFrame, col: str) -> DataFrame:
    """Range and inter-quartile range."""
    ends = df.agg((F.max(col) - F.min(col)).cast("double")).scalar()
    marks = quantile_columns(df, col, {"q1": 0.25, "q3": 0.75})
    return marks.select(ends.alias("range"), (F.col("q3") - F.col("q1")).alias("iqr"))


def variances(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.var_pop(col).alias("var_pop"), F.var_samp(col).alias("var_samp"), F.stddev_samp(col).alias("std")
    )


def coef_variation(df: DataFrame, col: str) -> DataFrame:
    """Population standard deviation as a percentage of the mean."""
    return df.agg((F.try_divide(F.stddev_pop(col), F.avg(col)) * 100).alias("cv"))


def moments(df: DataFrame, col: str, k: int) -> DataFrame:
    """Raw and central moment of order k (the mean is a scalar subquery, computed once)."""
    mean = df.agg(F.avg(col)).scalar()
    return (
        df.select(F.col(col).cast("double").alias("x"), (F.col(col) - mean).alias("d"))
        .agg(F.avg(F.pow("x", F.lit(k))).alias("raw"), F.avg(F.pow("d", F.lit(k))).alias("central"))
    )


def shape(df: DataFrame, col: str) -> DataFrame:
    """Biased skewness g1 (positive = long right tail) and Pearson kurtosis (normal = 3)."""
    return df.agg(F.skewness(col).alias("skewness"), (F.kurtosis(col) + 3).alias("kurtosis"))


def sturges_classes(n: Column) -> Column:
    return F.ceil(F.log2(n) + 1)


def sturges(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select("n", sturges_classes(F.col("n")).alias("classes"))


def histogram(df: DataFrame, col: str, bins: int | str = "sturges") -> DataFrame:
    """Equal-width classes, left-closed, the last one closed; empty classes are kept.

    First pass min, max and count; second pass counts per class. The class list is generated
    from the first pass, never from the rows.
    """
    present = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    k = sturges_classes(F.count(F.lit(1))) if bins == "sturges" else F.lit(int(bins))
    frame = present.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), k.cast("int").alias("k")).select(
        "lo", ((F.col("hi") - F.col("lo")) / F.col("k")).alias("w"), "k"
    )
    edges = frame.select(F.struct("lo", "w", "k")).scalar()
    place = F.when(edges["w"] > 0, F.least(F.floor((F.col("x") - edges["lo"]) / edges["w"]), edges["k"] - 1))
    counts = (
        present.select(F.coalesce(place, F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    classes = frame.select("lo", "w", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("bin"))
    return classes.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("w") * F.col("bin")).alias("left"),
        (F.col("lo") + F.col("w") * (F.col("bin") + 1)).alias("right"),
        (F.col("lo") + F.col("w") * (F.col("bin") + 0.5)).alias("mid"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def weighted_stats(hist: DataFrame, value: str = "mid", weight: str = "n") -> DataFrame:
    """Weighted mean and population variance."""
    mean = hist.agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight))).scalar()
    return hist.select(F.col(value).alias("x"), F.col(weight).alias("w"), mean.alias("m")).agg(
        F.max("m").alias("mean"),
        F.try_divide(F.sum(F.col("w") * F.pow(F.col("x") - F.col("m"), F.lit(2))), F.sum("w")).alias("variance"),
    )


def weighted_quantile(hist: DataFrame, probs: Sequence[float], value: str = "mid", weight: str = "n") -> DataFrame:
    """Quantiles interpolated at the middle of each weight; clamped outside the first and last.

    ``c`` is (weight before + weight/2) / total. Points with equal ``c`` (zero weights) resolve
    to the last of them on the left side and the first beyond on the right side.
    """
    placed = prefix_sum(hist.select(F.col(value).alias("x"), F.col(weight).alias("w")), ["x"], "w")
    c = F.try_divide(F.col("below") + F.col("w") * 0.5, F.col("total"))
    at = placed.select("x", c.alias("c"))
    aggs = []
    for i, p in enumerate(probs):
        prob = F.lit(float(p))
        left = F.max(F.when(F.col("c") <= prob, F.struct("c", "x")))
        right = F.min(F.when(F.col("c") > prob, F.struct("c", "x")))
        aggs += [left.alias(f"l{i}"), right.alias(f"r{i}")]
    wide = at.agg(*aggs)
    pairs = []
    for i, p in enumerate(probs):
        low, high = F.col(f"l{i}"), F.col(f"r{i}")
        between = low["x"] + (high["x"] - low["x"]) * (F.lit(float(p)) - low["c"]) / (high["c"] - low["c"])
        q = F.when(low.isNull(), high["x"]).when(high.isNull(), low["x"]).otherwise(between)
        pairs.append(F.struct(F.lit(float(p)).alias("p"), q.alias("q")))
    return wide.select(F.inline(F.array(*pairs)))


def expand_classes(hist: DataFrame, value: str = "mid", weight: str = "n") -> DataFrame:
    """One row per counted element, carrying its class centre.

    Large classes are cut into runs of at most 10 000 and the runs spread over the tasks, so
    no array and no task holds a whole class.
    """
    run = 10_000
    runs = hist.filter(F.col(weight) > 0).select(
        F.col(value).alias("x"),
        F.col(weight).alias("w"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(weight).cast("long") - 1, F.lit(run).cast("long"))).alias("start"),
    )
    return (
        runs.repartition("x", "start")
        .select(F.explode(F.array_repeat("x", F.least(F.lit(run), F.col("w") - F.col("start")).cast("int"))).alias("x"))
    )


def _fenced(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Rows with the quartiles of their group and the fences 1.5·IQR outside of them."""
    marks = quantile_columns(df, col, QUARTILES, by)
    iqr = F.col("q3") - F.col("q1")
    fences = marks.withColumns({"_lo": F.col("q1") - 1.5 * iqr, "_hi": F.col("q3") + 1.5 * iqr})
    return _attach(df.filter(F.col(col).isNotNull()), fences.select(*by, "q1", "median", "q3", "_lo", "_hi"), list(by))


def boxplot_stats(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers inside the fences and outlier count, with the group in every row."""
    x = F.col(col).cast("double")
    inside = x.between(F.col("_lo"), F.col("_hi"))
    return (
        _fenced(df.select(*by, col), col, by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.sum((~inside).cast("long")).alias("outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def boxplot_outliers(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """Rows outside the whisker fences of their group."""
    outside = ~F.col(col).cast("double").between(F.col("_lo"), F.col("_hi"))
    return _fenced(df, col, by).filter(outside).select(*df.columns)


def column_scales(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standard deviation of every column, widest first."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in cols])
    return unpivot_row(row, cols, "column", "std").orderBy(F.desc("std"), "column")


def cap_share(df: DataFrame, col: str, cap: float) -> DataFrame:
    """How many rows sit at (or above) a cap."""
    at = (F.col(col) >= F.lit(cap)).cast("long")
    return df.agg(F.count(col).alias("n"), F.sum(at).alias("capped"), F.avg(at).alias("share"))


