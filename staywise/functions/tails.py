"""Upper tail probabilities of the χ² and F distributions, for a handful of test statistics.

Spark has no column function for them. Both are Arrow-batched pandas UDFs over the result rows of a test
(one per column tested), never over data rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300
_EPS = 1e-15


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:  # power series of the lower function
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * _EPS:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a  # continued fraction of the upper function
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or _TINY)
        c = b + step / c or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return h * scale


def beta_regularized(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_regularized(b, a, 1 - x)
    log_front = a * math.log(x) + b * math.log1p(-x)
    log_front += math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1 / (1 + step * d or _TINY)
            c = 1 + step / c or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return math.exp(log_front) * h / a


@F.pandas_udf(DoubleType())
def chi2_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([gamma_upper(k / 2, s / 2) if k > 0 else 1.0 for s, k in zip(statistic, dof)])


@F.pandas_udf(DoubleType())
def f_p_value(statistic: pd.Series, between: pd.Series, within: pd.Series) -> pd.Series:
    return pd.Series(
        [
            beta_regularized(d2 / 2, d1 / 2, d2 / (d2 + d1 * s))
            for s, d1, d2 in zip(statistic, between, within)
        ]
    )
