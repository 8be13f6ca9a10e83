"""Upper tail of the F distribution, which Spark SQL lacks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _tail_function():
    """``f_tail`` as a function that carries all it needs, so that workers don't import this package."""
    # Coefficients of the Stirling series, B(2k) / (2k (2k-1)).
    stirling = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)

    def rest(x: float) -> float:
        """log gamma(x) less Stirling's leading terms, for x of 10 or more."""
        return sum(c / x ** (2 * k + 1) for k, c in enumerate(stirling))

    def log_beta(a: float, b: float) -> float:
        """log B(a, b); large arguments go by differences of the series, not of large logarithms."""
        small, large = min(a, b), max(a, b)
        if large < 10:
            return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
        total = small + large
        # log gamma(large) - log gamma(large + small)
        difference = -(large - 0.5) * math.log1p(small / large) - small * math.log(total) + small + rest(large) - rest(total)
        return math.lgamma(small) + difference if small < 10 else (
            (small - 0.5) * math.log(small) - small + 0.5 * math.log(2 * math.pi) + rest(small) + difference
        )

    def fraction(a: float, b: float, x: float) -> float:
        """Continued fraction of the incomplete beta function (modified Lentz method); NaN if it doesn't converge."""
        tiny = 1e-300
        c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or tiny)
        value = d
        for m in range(1, 100_000):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for term in (even, odd):
                d = 1.0 / (1.0 + term * d or tiny)
                c = 1.0 + term / c or tiny
                value *= c * d
            if abs(c * d - 1.0) < 1e-15:
                return value
        return math.nan

    def tail(statistic: float, d1: float, d2: float) -> float:
        if statistic is None or math.isnan(statistic) or not (d1 > 0 and d2 > 0):
            return math.nan
        if statistic <= 0:
            return 1.0
        if math.isinf(statistic):
            return 0.0
        a, b = d2 / 2.0, d1 / 2.0
        # x = d2 / (d2 + d1 W) and 1 - x, each without cancellation.
        x, y = 1 / (1 + d1 * statistic / d2), 1 / (1 + d2 / (d1 * statistic))
        log_x = -math.log1p(d1 * statistic / d2)
        log_y = -math.log1p(d2 / (d1 * statistic))
        if d1 % 2 == 0 and d1 <= 200:  # a finite sum: x^a times the first d1/2 terms of the series of (1-x)^(-a)
            term, total = 1.0, 1.0
            for k in range(1, int(b)):
                term *= (a + k - 1) * y / k
                total += term
            return min(1.0, math.exp(a * log_x + math.log(total)))
        front = math.exp(a * log_x + b * log_y - log_beta(a, b))
        if x < (a + 1.0) / (a + b + 2.0):
            return front * fraction(a, b, x) / a
        return 1.0 - front * fraction(b, a, y) / b

    return tail


f_tail = _tail_function()
f_tail.__doc__ = "P(F >= statistic) for an F distribution with d1 and d2 degrees of freedom; NaN where it is undefined."


def f_upper_tail(statistic: Column, d1: Column, d2: Column) -> Column:
    """``f_tail`` over aggregated rows: one call per experiment group, never per reading."""
    own = _tail_function()

    def tails(w: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        found = [own(x, y, z) for x, y, z in zip(w.astype(float), a.astype(float), b.astype(float))]
        return pd.Series([None if math.isnan(t) else t for t in found], dtype=object)

    return F.pandas_udf(tails, "double")(statistic, d1, d2)
