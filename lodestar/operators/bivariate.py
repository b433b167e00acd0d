"""Two-variable statistics: covariance, correlation, independence, rank correlation, regression."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.pvalues import chi2_tail, t_two_sided
from lodestar.operators.univariate import freq_table
from lodestar.operators.window import avg_rank


def covariance(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.covar_samp(x, y).alias("covariance"))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("correlation"))


def corr_matrix(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Long correlation matrix (x, y, r) from one pass; with ``target`` only its column, sorted."""
    pairs = [(target, c) for c in cols] if target else list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        both = [(a, b)] if target or a == b else [(a, b), (b, a)]
        entries += [F.struct(F.lit(p).alias("x"), F.lit(q).alias("y"), F.col(f"r{i}").alias("r")) for p, q in both]
    long = row.select(F.inline(F.array(*entries)))
    return long.orderBy(F.desc("r"), "y") if target else long


def _cells(df: DataFrame, a: str, b: str) -> DataFrame:
    """Non-empty cells of the contingency table with both margins ``n_a`` and ``n_b``."""
    known = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = known.groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    of_a = cells.groupBy(a).agg(F.sum("observed").alias("n_a"))
    of_b = cells.groupBy(b).agg(F.sum("observed").alias("n_b"))
    return cells.join(of_a, a).join(of_b, b)


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """All level pairs (also the empty ones) with observed and expected counts.

    The result is levels x levels large: every row level is paired with the list of column levels. The tests
    below do not need it.
    """
    cells = _cells(df, a, b)
    total = cells.agg(F.sum("observed")).scalar()
    columns = cells.select(b, "n_b").distinct().agg(F.sort_array(F.collect_list(F.struct(b, "n_b")))).scalar()
    grid = cells.select(a, "n_a").distinct().select(a, "n_a", F.explode(columns).alias("_c")).select(a, F.col("_c")[b].alias(b), "n_a", F.col("_c.n_b").alias("n_b"))
    observed = cells.select(a, b, "observed")
    full = grid.join(observed, [a, b], "left")
    expected = F.col("n_a").cast("double") * F.col("n_b") / total
    return full.select(a, b, F.coalesce("observed", F.lit(0)).alias("observed"), expected.alias("expected"))


def chi_square(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Statistic and degrees of freedom of the independence test.

    The statistic is the sum of observed^2 / expected over the non-empty cells, less the number of
    rows. With one degree of freedom the difference of each cell shrinks by at most one half
    (continuity correction), as the usual library default does; there it is the same in all four cells, and
    the sum of 1 / expected follows from the margins.
    """
    cells = _cells(df, a, b)
    n = F.col("observed").cast("double")
    product = F.col("n_a").cast("double") * F.col("n_b")
    total = F.sum(n)
    margin = lambda c: cells.groupBy(c).agg(F.sum("observed").cast("double").alias("m")).agg(F.sum(1 / F.col("m")), F.count(F.lit(1)))
    of_a, of_b = margin(a).toDF("inverse", "levels"), margin(b).toDF("inverse", "levels")
    sums = cells.agg(
        total.alias("total"),
        F.sum(n * n / product).alias("ratio"),
        # |observed - expected| of a cell is |n * total - product| / total; in a table of four all are equal.
        F.max(F.struct(n.alias("n"), product.alias("p"))).alias("cell"),
    )
    dof = ((of_a.select("levels").scalar() - 1) * (of_b.select("levels").scalar() - 1)).alias("dof")
    inverse = of_a.select("inverse").scalar() * of_b.select("inverse").scalar()
    row = sums.select("total", "ratio", "cell", dof, inverse.alias("inverse"))
    plain = F.col("total") * F.col("ratio") - F.col("total")
    diff = F.abs(F.col("cell.n") - F.col("cell.p") / F.col("total"))
    shrunk = F.greatest(diff - 0.5, F.lit(0.0))
    statistic = F.when(F.lit(correction) & (F.col("dof") == 1), shrunk * shrunk * F.col("total") * F.col("inverse")).otherwise(plain)
    return row.select(statistic.alias("chi2"), "dof")


def chi_square_test(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """:func:`chi_square` with its p-value."""
    return chi_square(df, a, b, correction).withColumn("p_value", chi2_tail("chi2", "dof"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation: n and rho.

    Rows are reduced to distinct (x, y) pairs with a count before ranks are joined on, so a
    value held by a third of the rows meets the join once per partner value only. Both rank
    columns have mean (n+1)/2.
    """
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = both.groupBy(x, y).agg(F.count(F.lit(1)).alias("w"))
    ranked = pairs.join(avg_rank(both, x, "rx").drop("n"), x).join(avg_rank(both, y, "ry").drop("n"), y)
    n = pairs.agg(F.sum("w")).scalar()
    middle = (n + 1) / 2
    centred = ranked.select("w", (F.col("rx") - middle).alias("u"), (F.col("ry") - middle).alias("v"))
    w, u, v = F.col("w"), F.col("u"), F.col("v")
    return centred.agg(
        F.sum("w").alias("n"),
        F.try_divide(F.sum(w * u * v), F.sqrt(F.sum(w * u * u)) * F.sqrt(F.sum(w * v * v))).alias("rho"),
    )


def spearman_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """:func:`spearman` with the two-sided p-value of its t statistic."""
    rho, dof = F.col("rho"), F.col("n") - 2
    t = F.when(F.abs(rho) < 1, rho * F.sqrt(dof / ((1 - rho) * (1 + rho)))).otherwise(F.lit(float("inf")))
    return spearman(df, x, y).withColumn("p_value", t_two_sided(t, dof))


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope·x + intercept, r², and the line's two end points."""
    slope, intercept = F.col("slope"), F.col("intercept")
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.min(x).cast("double").alias("x_min"),
        F.max(x).cast("double").alias("x_max"),
    ).select(
        "slope",
        "intercept",
        "r2",
        "x_min",
        (slope * F.col("x_min") + intercept).alias("y_at_min"),
        "x_max",
        (slope * F.col("x_max") + intercept).alias("y_at_max"),
    )


def cond_weighted_mean(df: DataFrame, col: str, condition: Column) -> DataFrame:
    """Mean of a column weighted by its frequency distribution within one class."""
    table = freq_table(df.filter(condition), col)
    return table.agg(F.sum(F.col(col) * F.col("freq")).alias("mean"))


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, size: int) -> int:
    """Good items among ``size`` drawn from ``good + bad``: ratio of uniforms (Stadlober 1990), for any population."""
    total = good + bad
    few, many, drawn = min(good, bad), max(good, bad), min(size, total - size)
    if few and drawn:
        share = few / total
        centre = drawn * share + 0.5
        spread = math.sqrt((total - drawn) * drawn * share * (1 - share) / (total - 1) + 0.5)
        width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
        mode = (drawn + 1) * (few + 1) // (total + 2)
        height = lambda k: math.lgamma(k + 1) + math.lgamma(few - k + 1) + math.lgamma(drawn - k + 1) + math.lgamma(many - drawn + k + 1)
        top = height(mode)
        end = min(drawn, few) + 1
        while True:
            u, v = rng.random(), rng.random()
            place = centre + width * (v - 0.5) / u if u else -1.0
            if 0 <= place < end and 2 * math.log(u) <= top - height(int(place)):
                found = int(place)
                break
    else:
        found = 0
    if good > bad:
        found = drawn - found
    return found if drawn == size else good - found


def _draw_row(rng: np.random.Generator, left: np.ndarray, size: int) -> np.ndarray:
    """Counts per column level when ``size`` items are drawn from ``left`` without replacement, level by level."""
    drawn, rest, need = np.zeros_like(left), int(left.sum()), size
    for j, have in enumerate(left):
        rest -= int(have)
        drawn[j] = _hypergeometric(rng, int(have), rest, need)
        need -= int(drawn[j])
    return drawn


def permutation_test(df: DataFrame, a: str, b: str, m: int, seed: int = 42) -> DataFrame:
    """Monte-Carlo p-value of the chi-square statistic for tables with small expected counts.

    Shuffling one label column keeps both margins, and the shuffled table depends on the rows
    only through those margins. So the data is read once (for the contingency table) and the m
    random tables are drawn from the margins, spread over the cluster with one seed per draw.
    """
    cells = _cells(df, a, b)
    margins_a = cells.groupBy(a).agg(F.sum("observed").alias("s")).agg(F.sort_array(F.collect_list("s"))).scalar()
    margins_b = cells.groupBy(b).agg(F.sum("observed").alias("s")).agg(F.sort_array(F.collect_list("s"))).scalar()
    observed = chi_square(df, a, b, correction=False).select("chi2").scalar()

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = []
            for i, rows, cols, limit in zip(batch["id"], batch["rows"], batch["cols"], batch["limit"]):
                rng = np.random.default_rng([seed, int(i)])
                left = np.array(cols, dtype=np.int64)
                expected_per_row = left / left.sum()
                statistic = 0.0
                for size in rows:
                    drawn = _draw_row(rng, left, int(size))
                    left = left - drawn
                    expected = size * expected_per_row
                    statistic += float(((drawn - expected) ** 2 / expected).sum())
                hits.append(statistic >= limit - 1e-9)
            yield pd.DataFrame({"hit": hits})

    draws = df.sparkSession.range(m).select(
        "id", margins_a.alias("rows"), margins_b.alias("cols"), observed.alias("limit")
    )
    counted = draws.mapInPandas(draw, "hit boolean").agg(
        F.count(F.lit(1)).alias("draws"), F.sum(F.col("hit").cast("long")).alias("as_extreme")
    )
    return counted.withColumn("p_value", (F.col("as_extreme") + 1) / (F.col("draws") + 1))
