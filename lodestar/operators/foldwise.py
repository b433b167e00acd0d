"""Cross-validation of linear models from sums of products per fold.

One pass adds up, for every fold, the products of all columns. The sums a model is trained on are the total
less those of the fold it is tested on, so every fold of every linear, ridge, lasso or quadratic model over any subset of the
columns is solved from a few small matrices. A second pass scores all models on all held-out rows; ridge models that choose their
penalty take one pass more between them, for the leave-one-out errors of all penalties in all folds.
What reaches the driver is a matrix of columns by columns per fold.

Rows with a null in a column of the study are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import right_closed


@dataclass(frozen=True)
class Linear:
    """Least squares on ``features``; ``degree`` 2 adds all squares and products."""

    features: Sequence[str]
    degree: int = 1


@dataclass(frozen=True)
class Ridge:
    """Least squares on standardised ``features`` with the penalty of least leave-one-out error on the training rows."""

    features: Sequence[str]
    alphas: Sequence[float]
    degree: int = field(default=1, init=False)


@dataclass(frozen=True)
class Lasso:
    """``1/(2n) |y - Xw|² + alpha |w|`` on standardised ``features``."""

    features: Sequence[str]
    alpha: float
    degree: int = field(default=1, init=False)


Model = Linear | Ridge | Lasso


def _terms(model: Model) -> list[tuple[str, ...]]:
    """The columns of a model as products of features."""
    own = [(f,) for f in model.features]
    return own + list(combinations_with_replacement(model.features, 2)) if model.degree == 2 else own


@dataclass(frozen=True)
class Moments:
    """Sums of products per fold. Columns are a constant, the terms of scaled features, and the scaled label, in this order."""

    terms: list[tuple[str, ...]]
    features: list[str]
    centre: np.ndarray
    scale: np.ndarray  # of the features and, last, the label
    per_fold: np.ndarray

    def design(self, batch: pd.DataFrame, label: str) -> np.ndarray:
        z = (batch[[*self.features, label]].to_numpy(float) - self.centre) / self.scale
        at = {f: i for i, f in enumerate(self.features)}
        out = np.ones((len(z), len(self.terms) + 2))
        for column, term in enumerate(self.terms, 1):
            for f in term:
                out[:, column] *= z[:, at[f]]
        out[:, -1] = z[:, -1]
        return out

    def training(self, fold: int | None) -> np.ndarray:
        total = self.per_fold.sum(0)
        return total if fold is None else total - self.per_fold[fold]

    def standard(self, fold: int | None, model: Model) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, means and deviations of the model's columns, their correlations, and the products with the label (per row)."""
        sums = self.training(fold)
        at = [1 + self.terms.index(t) for t in _terms(model)]
        n = sums[0, 0]
        mean = sums[0] / n
        cov = sums / n - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(cov)[at], 0))
        scale[scale < 1e-12] = 1.0
        return n, np.append(mean[at], mean[-1]), scale, cov[np.ix_(at, at)] / np.outer(scale, scale), cov[at, -1] / scale


def moments(df: DataFrame, models: Sequence[Model], label: str, fold: Column, k: int) -> Moments:
    """Two jobs: rough means and deviations (for the scaling alone), then the products of all folds."""
    features = sorted({f for m in models for f in m.features})
    terms = sorted({t for m in models for t in _terms(m)}, key=lambda t: (len(t), t))
    names = [*features, label]
    rough = df.select(*names).dropna().agg(*[f(c).alias(f"{p}{i}") for i, c in enumerate(names) for p, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    centre = np.array([rough[f"m{i}"] or 0.0 for i in range(len(names))], float)
    scale = np.array([rough[f"s{i}"] or 1.0 for i in range(len(names))], float)
    blank = Moments(terms, features, centre, scale, np.zeros((k, 0, 0)))
    width = len(terms) + 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, width, width))
        for batch in batches:
            x, of = blank.design(batch, label), batch["_fold"].to_numpy()
            for f in np.unique(of):
                part = x[of == f]
                total[f] += part.T @ part
        yield pd.DataFrame({"f": np.arange(k), "v": list(total.reshape(k, -1))})

    sums = _rows(df, names, fold).mapInPandas(run, "f int, v array<double>").groupBy("f").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
    per_fold = np.zeros((k, width, width))
    for f, v in sums.collect():
        per_fold[f] = np.reshape(v, (width, width))
    return Moments(terms, features, centre, scale, per_fold)


def _rows(df: DataFrame, names: Sequence[str], fold: Column) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys(names)], fold.cast("int").alias("_fold")).dropna()


def _lasso(corr: np.ndarray, product: np.ndarray, alpha: float) -> np.ndarray:
    """Coordinate descent on the products alone."""
    w = np.zeros(len(product))
    for _ in range(10_000):
        before = w.copy()
        for j in range(len(w)):
            rest = product[j] - corr[j] @ w + corr[j, j] * w[j]
            w[j] = np.sign(rest) * max(abs(rest) - alpha, 0) / corr[j, j] if corr[j, j] > 0 else 0.0
        if np.abs(w - before).max(initial=0) < 1e-12:
            break
    return w


def _coefficients(m: Moments, fold: int | None, model: Model, alpha: float | None) -> np.ndarray:
    """Intercept and weights on the scaled columns."""
    n, mean, scale, corr, product = m.standard(fold, model)
    if isinstance(model, Ridge):
        w = np.linalg.solve(corr + alpha / n * np.eye(len(corr)), product)
    elif isinstance(model, Lasso):
        w = _lasso(corr, product, model.alpha / m.scale[-1])  # the label is scaled as well
    else:
        w = np.linalg.lstsq(corr, product, rcond=1e-12)[0]
    w = w / scale
    return np.append(mean[-1] - mean[:-1] @ w, w)


def _penalties(df: DataFrame, m: Moments, models: dict[str, Ridge], label: str, fold: Column, folds: Sequence[int | None]) -> dict[tuple[str, int | None], float]:
    """For every ridge model and training set the penalty of least leave-one-out error; the smaller of equal ones. One job."""
    if not models:
        return {}
    cases = [(name, f, a) for name, model in models.items() for f in folds for a in model.alphas]
    solved = []
    for name, model in models.items():
        at = [1 + m.terms.index(t) for t in _terms(model)]
        for f in folds:
            n, mean, scale, corr, _ = m.standard(f, model)
            # All penalties share the eigenvectors: on those axes a leverage is a weighted sum of squares.
            value, axes = np.linalg.eigh(corr)
            shrunk = 1 / (value[:, None] + np.asarray(model.alphas, float) / n) / n
            weights = np.stack([_coefficients(m, f, model, a) for a in model.alphas], 1)
            solved.append((f, at, n, mean[:-1], axes / scale[:, None], shrunk, weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros(shrunk.shape[1]) for *_, shrunk, _ in solved]
        for batch in batches:
            x, of = m.design(batch, label), batch["_fold"].to_numpy()
            for c, (f, at, n, mean, axes, shrunk, weights) in enumerate(solved):
                part = x if f is None else x[of != f]
                own = part[:, at]
                leverage = ((own - mean) @ axes) ** 2 @ shrunk + 1 / n
                error = part[:, -1:] - weights[0] - own @ weights[1:]
                total[c] += ((error / (1 - leverage)) ** 2).sum(0)
        flat = np.concatenate(total)
        yield pd.DataFrame({"c": np.arange(len(flat)), "s": flat})

    sums = dict(_rows(df, [*m.features, label], fold).mapInPandas(run, "c int, s double").groupBy("c").agg(F.sum("s")).collect())
    best: dict[tuple[str, int | None], tuple[float, float]] = {}
    for c, (name, f, a) in enumerate(cases):
        best[name, f] = min(best.get((name, f), (np.inf, np.inf)), (sums.get(c, 0.0), a))
    return {key: a for key, (_, a) in best.items()}


def cv_table(df: DataFrame, models: dict[str, Model], label: str, fold: Column, k: int = 5) -> DataFrame:
    """Per model the mean and deviation (over folds) of R² and the mean of the absolute error: ``model``, ``r2``, ``r2_std``, ``mae``.

    Three jobs for any number of models, four with ridge models. A fold without rows is left out.
    """
    m = moments(df, list(models.values()), label, fold, k)
    ridges = {name: model for name, model in models.items() if isinstance(model, Ridge)}
    penalty = _penalties(df, m, ridges, label, fold, list(range(k)))
    fitted = [
        (number, [1 + m.terms.index(t) for t in _terms(model)], np.stack([_coefficients(m, f, model, penalty.get((name, f))) for f in range(k)]))
        for number, (name, model) in enumerate(models.items())
    ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(fitted), k, 5))
        for batch in batches:
            x, of = m.design(batch, label), batch["_fold"].to_numpy()
            y = x[:, -1]
            for number, at, w in fitted:
                each = w[:, :1].T + x[:, at] @ w[:, 1:].T  # by the weights of every fold; a row is judged by its own
                error = y - each[np.arange(len(y)), of]
                for c, value in enumerate((np.ones(len(y)), y, y * y, error * error, np.abs(error))):
                    total[number, :, c] += np.bincount(of, value, k)
        number, f = np.divmod(np.arange(len(fitted) * k), k)
        yield pd.DataFrame({"m": number, "f": f, **dict(zip(("n", "y", "yy", "ee", "e"), total.reshape(-1, 5).T))})

    schema = "m int, f int, n double, y double, yy double, ee double, e double"
    sums = _rows(df, [*m.features, label], fold).mapInPandas(run, schema).groupBy("m", "f").agg(*[F.sum(c).alias(c) for c in ("n", "y", "yy", "ee", "e")])
    spread = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    per_fold = sums.filter("n > 0").select("m", (1 - F.try_divide("ee", spread)).alias("r2"), (F.col("e") / F.col("n") * float(m.scale[-1])).alias("mae"))
    names = F.get(F.array(*map(F.lit, models)), F.col("m"))
    scores = per_fold.groupBy("m").agg(F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"), F.avg("mae").alias("mae"))
    return scores.select(names.alias("model"), "r2", "r2_std", "mae")


def fit(df: DataFrame, model: Model, label: str) -> tuple[float, dict[tuple[str, ...], float]]:
    """Intercept and weight of every term in the units of the columns (only for models of degree 1)."""
    if model.degree != 1:
        raise ValueError("weights in the columns' own units are given for degree 1")
    m = moments(df, [model], label, F.lit(0), 1)
    penalty = _penalties(df, m, {"": model} if isinstance(model, Ridge) else {}, label, F.lit(0), [None])
    w = _coefficients(m, None, model, penalty.get(("", None)))
    at = [m.features.index(f) for f in model.features]
    weights = w[1:] * m.scale[-1] / m.scale[at]
    return float(m.centre[-1] + m.scale[-1] * w[0] - weights @ m.centre[at]), {(f,): float(v) for f, v in zip(model.features, weights)}


def predicted(df: DataFrame, intercept: float, weights: dict[tuple[str, ...], float], out: str = "prediction") -> DataFrame:
    """Predictions of :func:`fit` as a column."""
    value = F.lit(intercept)
    for (feature,), w in weights.items():
        value = value + F.lit(w) * F.col(feature)
    return df.withColumn(out, value)


def study(df: DataFrame, model: Model, label: str, key: Column, bounds: Sequence[float], k: int = 5) -> DataFrame:
    """A whole study of one model, one row: cross-validation on training rows only, one fit, one evaluation on held-out rows.

    ``key`` is a whole number per row; rows with ``key % 5 = 0`` are held out, the folds of the others are
    ``(key div 5) % k``. Prediction and label are put into the classes between ``bounds`` (closed on the right): ``accuracy`` is
    the share in the same class, ``within_one`` also allows the neighbouring one.
    """
    train, test = df.filter(F.pmod(key, F.lit(5)) != 0), df.filter(F.pmod(key, F.lit(5)) == 0)
    fold = F.pmod(F.floor(key / 5), F.lit(k))
    cv = cv_table(train, {"model": model}, label, fold, k).select(F.struct("r2", "r2_std", "mae")).scalar()
    place = lambda c: right_closed(F.col(c), bounds, range(len(bounds) + 1))
    scored = predicted(test.select(*dict.fromkeys([*model.features, label])).dropna(), *fit(train, model, label))
    error = F.col(label) - F.col("prediction")
    gap = F.abs(place("prediction") - place(label))
    held = scored.agg(
        F.count(F.lit(1)).alias("n_test"), (1 - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"), F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg((gap == 0).cast("double")).alias("accuracy"), F.avg((gap <= 1).cast("double")).alias("within_one"))
    return held.withColumns({f"cv_{c}": cv[c] for c in ("r2", "r2_std", "mae")})
