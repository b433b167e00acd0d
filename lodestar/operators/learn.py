"""Feature preparation, regression studies and their evaluation, on ``pyspark.ml``.

Splits and folds come from a hash of a key, so they do not move when the data is
repartitioned or a lost task runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators import forest

#: Rows of a partition below which more partitions would cost learners more than they give.
SPREAD_ROWS = 5000

#: Fits a model on a frame that has the feature columns, a ``features`` vector and the label.
Fit = Callable[[DataFrame], Model]


def levels(df: DataFrame, cols: Sequence[str], most: int = 1000) -> dict[str, list]:
    """The levels of categorical columns in order, nulls left out. They become columns, so more than ``most`` is an error."""
    found = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols]).first()
    wide = [c for c in cols if len(found[c]) > most]
    if wide:
        raise ValueError(f"more than {most} levels in {wide}: code them by one_hot")
    return {c: found[c] for c in cols}


def dummies(df: DataFrame, levels: dict[str, Sequence]) -> DataFrame:
    """0/1 columns for the given levels of each categorical column without the first one in order; the categories go."""
    named = {
        f"{c}_{level}": F.coalesce(F.col(c) == F.lit(level), F.lit(False)).cast("int")
        for c, found in levels.items()
        for level in sorted(found)[1:]
    }
    return df.withColumns(named).drop(*levels)


def one_hot(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """All categories as one sparse 0/1 vector without the alphabetically first level of each column, for any number of levels.

    A null has no level: all its entries are 0 (as for the first level).
    """
    indexed, coded = [f"_i_{c}" for c in cols], [f"_v_{c}" for c in cols]
    stages = [
        StringIndexer(inputCols=list(cols), outputCols=indexed, stringOrderType="alphabetDesc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=coded, dropLast=False),
    ]
    wide = Pipeline(stages=stages).fit(df).transform(df)
    # The descending order puts the first level last, and what is kept for nulls behind it.
    cut_off = [VectorSlicer(inputCol=v, outputCol=f"_s_{c}", indices=list(range(size - 2))) for c, v, size in (
        (c, v, wide.schema[v].metadata["ml_attr"]["num_attrs"]) for c, v in zip(cols, coded)) if size > 2]
    for slicer in cut_off:
        wide = slicer.transform(wide)
    kept = [s.getOutputCol() for s in cut_off]
    return VectorAssembler(inputCols=kept, outputCol=out).transform(wide).select(*df.columns, out)


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population std, in place; a constant column becomes zero."""
    fields = [f(c).alias(f"{p}_{c}") for c in cols for p, f in (("m", F.avg), ("s", F.stddev_pop))]
    stats = df.agg(F.struct(*fields)).scalar()
    scaled = {
        c: F.when(stats[f"s_{c}"] > 0, (F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"]).otherwise(F.col(c) * 0.0)
        for c in cols
    }
    return df.withColumns(scaled)


def fold_of(key: str, k: int) -> Column:
    """Fold 0..k-1 of a row, from its key alone."""
    return F.pmod(F.xxhash64(key), F.lit(k)).cast("int")


def folds(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    return df.withColumn("fold", fold_of(key, k))


def split(df: DataFrame, held_out: Column) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a condition on stable columns, e.g. ``fold_of(key, 5) == 0`` for 80/20."""
    return df.filter(~held_out), df.filter(held_out)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over as many partitions as the cluster has cores, where the input has fewer and more than ``SPREAD_ROWS`` a partition.

    Learners pass over their rows many times, with one task per partition: a small file read as one would keep one core busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    want = min(cores, -(-df.count() // SPREAD_ROWS))
    return df.repartition(want) if want > df.rdd.getNumPartitions() else df


# --- estimators -----------------------------------------------------------------------------


def linear(label: str) -> Fit:
    return LinearRegression(labelCol=label, solver="normal").fit


def random_forest(label: str, trees: int = 300, depth: int = 30, seed: int = 42) -> Fit:
    """Bagged trees as deep as the library allows (30); every split may use every feature, as is usual for regression forests."""
    return lambda train: forest.fit(train, label, trees, depth, seed)


def stump(label: str) -> Fit:
    """A tree without a split: it predicts the mean of its training rows."""
    return DecisionTreeRegressor(labelCol=label, maxDepth=0).fit


def boosting(label: str, rounds: int = 100, seed: int = 42) -> Fit:
    return GBTRegressor(labelCol=label, maxIter=rounds, maxDepth=3, stepSize=0.1, seed=seed).fit


def poly2(label: str) -> Fit:
    """Standardised inputs, all terms up to degree two, linear regression."""
    stages: list[Estimator] = [
        StandardScaler(inputCol="features", outputCol="_z", withMean=True, withStd=True),
        PolynomialExpansion(degree=2, inputCol="_z", outputCol="_p"),
        LinearRegression(featuresCol="_p", labelCol=label),
    ]
    return Pipeline(stages=stages).fit


def lasso(label: str, alpha: float = 0.1) -> Fit:
    return LinearRegression(labelCol=label, elasticNetParam=1.0, regParam=alpha).fit


def ridge(label: str, features: Sequence[str], alphas: Sequence[float]) -> Fit:
    """Ridge with the penalty that has the smallest leave-one-out error on the training rows.

    The library's loss is divided by n, hence the division of the penalty.
    """

    def fit(train: DataFrame) -> Model:
        best, n = ridge_grid(train, features, label, alphas).orderBy("loo_mse", "alpha").select("alpha", "n").first()
        return LinearRegression(labelCol=label, solver="normal", elasticNetParam=0.0, regParam=best / n).fit(train)

    return fit


def forest_classifier(label_index: str, trees: int = 300, depth: int = 30, seed: int = 42) -> Fit:
    """Bagged trees for class numbers; every split may use as many features as the root of their number."""
    return lambda train: forest.fit(train, label_index, trees, depth, seed, classes=True)


def log_spaced(low: float, high: float, n: int) -> list[float]:
    """n penalties from 10**low to 10**high."""
    return [float(v) for v in np.logspace(low, high, n)]


def ridge_grid(df: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float]) -> DataFrame:
    """Exact leave-one-out error of every ridge penalty on standardised features: (alpha, loo_mse, n).

    Two passes for any number of penalties. The first sums the products of all columns (a
    matrix of features × features, the only thing that reaches the driver). The second turns
    each row's residual e into its left-out residual e / (1 - h), where the leverage h comes
    from that matrix, and adds squares up per batch.
    """
    cols = [*features, label]
    d = len(features)
    x = [F.col(c).cast("double") for c in cols]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    rough = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n = rough["n"]
    mean = np.array([rough[f"s{i}"] for i in range(d + 1)]) / n
    centred = [v - float(m) for v, m in zip(x, mean)]
    products = [F.sum(centred[i] * centred[j]).alias(f"p{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
    row = df.agg(*products).first()
    gram = np.zeros((d + 1, d + 1))
    for i in range(d + 1):
        for j in range(i, d + 1):
            gram[i, j] = gram[j, i] = row[f"p{i}_{j}"]
    scale = np.sqrt(np.diag(gram)[:d] / n)
    scale[scale == 0] = 1.0
    xtx = gram[:d, :d] / np.outer(scale, scale)
    xty = gram[:d, d] / scale
    inverses = [np.linalg.inv(xtx + a * np.eye(d)) for a in alphas]
    weights = [inv @ xty for inv in inverses]

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = (batch[list(features)].to_numpy(float) - mean[:d]) / scale
            y = batch[label].to_numpy(float) - mean[d]
            errors = []
            for inv, w in zip(inverses, weights):
                leverage = 1 / n + np.einsum("ij,jk,ik->i", z, inv, z)
                errors.append(float((((y - z @ w) / (1 - leverage)) ** 2).sum()))
            yield pd.DataFrame({"alpha": list(alphas), "sse": errors})

    squares = df.select(*cols).mapInPandas(left_out, "alpha double, sse double").groupBy("alpha")
    return squares.agg((F.sum("sse") / n).alias("loo_mse")).withColumn("n", F.lit(n).cast("long"))


# --- evaluation -----------------------------------------------------------------------------


def metrics(label: str, prediction: str = "prediction") -> list[Column]:
    """R², mean absolute error and root mean squared error as aggregates."""
    error = F.col(label) - F.col(prediction)
    return [
        (1 - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    ]


def test_metrics(pred: DataFrame, label: str) -> DataFrame:
    return pred.agg(*metrics(label))


test_metrics.__test__ = False  # not a test case, whatever its name


def cv_scores(
    df: DataFrame, fit: Fit, features: Sequence[str], label: str, key: str, k: int = 5, fold: Column | None = None
) -> DataFrame:
    """k-fold cross-validation of any learner: mean and std (over folds) of R², mean of the absolute error.

    Folds come from a hash of ``key`` unless an own ``fold`` expression (0..k-1) is given. The assembled frame is kept for the k fits,
    which run side by side, because learners read it many times in short jobs; all held-out predictions are then scored in
    one aggregate. Linear models need no fits: see :mod:`lodestar.operators.foldwise`.
    """
    numbered = df.withColumn("fold", fold_of(key, k) if fold is None else fold.cast("int"))
    data = spread(assemble(numbered.select("fold", *features, label), features)).persist()

    def held_out(number: int) -> DataFrame:
        train, test = split(data, F.col("fold") == number)
        return fit(train).transform(test).select("fold", label, "prediction")

    try:
        data.count()  # once, before the fits ask for it together
        with ThreadPoolExecutor(k) as pool:
            parts = list(pool.map(inheritable_thread_target(df.sparkSession)(held_out), range(k)))
        scored = reduce(DataFrame.unionByName, parts)
        per_fold = scored.groupBy("fold").agg(*metrics(label))
        row = per_fold.agg(F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"), F.avg("mae").alias("mae")).first()
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame([tuple(row)], "r2 double, r2_std double, mae double")


def baseline(df: DataFrame, label: str) -> DataFrame:
    """Mean absolute error of always predicting the mean."""
    mean = df.agg(F.avg(label)).scalar()
    return df.select(F.col(label).alias("y"), mean.alias("m")).agg(
        F.max("m").alias("mean"), F.avg(F.abs(F.col("y") - F.col("m"))).alias("mae")
    )


def model_table(results: dict[str, DataFrame]) -> DataFrame:
    """Score rows of several models, best R² first."""
    table = None
    for name, scores in results.items():
        row = scores.select(F.lit(name).alias("model"), "r2", "r2_std", "mae")
        table = row if table is None else table.unionByName(row)
    return table.orderBy(F.desc("r2"), "model")


def line_prediction(df: DataFrame, line: DataFrame, x: str) -> DataFrame:
    """Predictions of a fitted line (``slope``, ``intercept``) as a column."""
    fitted = line.select(F.struct("slope", "intercept")).scalar()
    return df.withColumn("prediction", fitted["slope"] * F.col(x) + fitted["intercept"])


def residuals(pred: DataFrame, label: str) -> DataFrame:
    return pred.withColumn("residual", F.col(label) - F.col("prediction"))


def residual_stats(pred: DataFrame, label: str) -> DataFrame:
    r = residuals(pred, label)
    return r.agg(F.count("residual").alias("n"), F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"))


def coef_table(df: DataFrame, model: Model, features: Sequence[str]) -> DataFrame:
    """Coefficients by size, one row per feature."""
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return table.orderBy(F.desc(F.abs("coefficient")), "feature")
