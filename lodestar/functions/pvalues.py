"""Tail probabilities of test statistics, evaluated on the one-row test result."""

from __future__ import annotations

import math
from itertools import count

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY, _CLOSE = 1e-300, 1e-15


def _continued(first: float, terms) -> float:
    """Value of ``first + a1/(b1 + a2/(b2 + ...))`` from pairs (a, b), by the modified Lentz method."""
    value = first if first else _TINY
    up, down = value, 0.0
    for a, b in terms:
        down = 1 / ((b + a * down) or _TINY)
        up = (b + a / up) or _TINY
        value *= up * down
        if abs(up * down - 1) < _CLOSE:
            break
    return value


def _chi2_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable: the upper incomplete gamma function, by series or continued fraction."""
    if x <= 0 or dof <= 0:
        return 1.0
    a, x = dof / 2, x / 2
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for n in count(1):
            term *= x / (a + n)
            total += term
            if term < total * _CLOSE:
                return max(0.0, 1 - front * total)
    terms = ((-n * (n - a), x + 2 * n + 1 - a) for n in count(1))
    return min(1.0, front / _continued(x + 1 - a, terms))


def _beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(1 - x, b, a)

    def terms():
        yield 1.0, 1.0
        for m in count(1):
            yield -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1)), 1.0
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    return front * _continued(0.0, terms()) if x else 0.0


def _t_two_sided(t: float, dof: int) -> float:
    """P(|T| > |t|) for any number of degrees of freedom."""
    if math.isinf(t):
        return 0.0
    return _beta_share(dof / (dof + t * t), dof / 2, 0.5)


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_chi2_tail(float(a), int(b)) for a, b in zip(x, dof)])


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_t_two_sided(float(a), int(b)) for a, b in zip(t, dof)])
