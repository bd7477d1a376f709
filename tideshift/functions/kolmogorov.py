"""p-values of the two-sample Kolmogorov-Smirnov statistic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TERMS = 100


def asymptotic_p(d: Column, n: Column, m: Column) -> Column:
    """Kolmogorov's limit series at ``d * sqrt(n m / (n + m))``."""
    z2 = d * d * n * m / (n + m)
    ks = F.sequence(F.lit(1), F.lit(TERMS))
    series = F.aggregate(
        ks, F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * z2)
    )
    # Below this argument the series has not converged while the probability is 1 to 12 digits.
    return F.when(z2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def exact_p_value(d: float, n: int, m: int) -> float:
    """Share of the ways to interleave two samples whose distance reaches ``d``.

    Interleavings are lattice paths from (0, 0) to (n, m). Paths that stay strictly inside the band
    ``|i/n - j/m| < d`` are counted row by row; each row is a running sum, rescaled against overflow.
    """
    n, m = (n, m) if n >= m else (m, n)
    common = math.lcm(n, m)
    reach = int(round(d * common))
    if reach == 0:
        return 1.0
    up, across = common // n, common // m
    j = np.arange(m + 1)
    paths = (j * across < reach).astype(float)
    log_scale = 0.0
    for i in range(1, n + 1):
        inside = np.abs(i * up - j * across) < reach
        paths = np.where(inside, np.cumsum(np.where(inside, paths, 0.0)), 0.0)
        top = paths.max()
        if top == 0.0:
            return 1.0
        if top > 1e200:
            paths /= top
            log_scale += math.log(top)
    if paths[m] == 0.0:
        return 1.0
    log_all = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return float(min(1.0, max(0.0, 1.0 - math.exp(math.log(paths[m]) + log_scale - log_all))))


@F.pandas_udf(T.DoubleType())
def exact_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact p-value per row, for samples of any size. One row per feature."""
    sizes = zip(d, n.fillna(0), m.fillna(0))
    return pd.Series(
        [exact_p_value(x, int(a), int(b)) if x == x and min(a, b) > 0 else None for x, a, b in sizes], dtype="float64"
    )


def ks_p_value(d: Column, n: Column, m: Column, method: str = "asymptotic") -> Column:
    """By the limit series (``asymptotic``, plain SQL functions) or by counting (``exact``, steps in the larger size)."""
    if method == "asymptotic":
        return asymptotic_p(d, n, m)
    if method == "exact":
        return exact_p(d, n, m)
    raise ValueError(f"unknown method '{method}'")
