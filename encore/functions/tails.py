"""Tail probabilities for one-row test results."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's helpers with the task instead of expecting the package on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def gamma_tail(a: float, x: float) -> float:
    """Upper regularised incomplete gamma: series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a
    c = 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 1000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + num * d)
            c = 1 + num / c
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h / a


@F.pandas_udf(T.DoubleType())
def chi_square_tail(stat: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([gamma_tail(k / 2, x / 2) for x, k in zip(stat, freedom)])


@F.pandas_udf(T.DoubleType())
def t_two_sided(t: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([beta_share(k / 2, 0.5, k / (k + v * v)) for v, k in zip(t, freedom)])
