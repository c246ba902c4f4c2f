"""Closed forms for the two tests used here; Spark has no error function."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Abramowitz and Stegun, Handbook of Mathematical Functions, formula 7.1.26.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

KS_TERMS = 100
KS_FLAT = 0.2  # below this argument the Smirnov series equals 1 to six digits


def two_sided_normal_p(z: Column) -> Column:
    """Probability of a standard normal at least as far from 0 as z."""
    x = F.abs(z) / F.lit(2.0) ** F.lit(0.5)
    t = 1.0 / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + F.lit(a)) * t
    return poly * F.exp(-x * x)


def ks_p_value(d: Column, n_a: Column, n_b: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value (Smirnov's series)."""
    a, b = n_a.cast("double"), n_b.cast("double")
    lam = d * F.sqrt(a * b / (a + b))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda s, k: s
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < KS_FLAT, 1.0).otherwise(
        F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0))
    )


EXACT_ROWS = 10_000  # larger samples use the asymptotic law


def ks_exact_p(statistic: float, n_a: int, n_b: int) -> float:
    """Exact two-sided law of the two-sample statistic, by counting lattice paths.

    The order of two pooled samples is a path from (0, 0) to (n_a, n_b). The result is the
    share of paths that somewhere touch |x / n_a - y / n_b| >= statistic. Paths inside the
    band are counted column by column as running sums, rescaled to stay in range.
    """
    y = np.arange(n_b + 1) / n_b
    paths = np.zeros(n_b + 1)
    paths[0] = 1.0
    log_scale = 0.0
    for i in range(n_a + 1):
        band = np.flatnonzero(np.abs(i / n_a - y) < statistic - 1e-12)
        if len(band) == 0:
            return 1.0
        lo, hi = band[0], band[-1] + 1
        paths[:lo] = 0.0
        paths[hi:] = 0.0
        np.cumsum(paths[lo:hi], out=paths[lo:hi])
        top = paths[hi - 1]
        if top == 0.0:
            return 1.0
        paths[lo:hi] /= top
        log_scale += math.log(top)
    if paths[n_b] == 0.0:
        return 1.0
    log_all = math.lgamma(n_a + n_b + 1) - math.lgamma(n_a + 1) - math.lgamma(n_b + 1)
    inside = math.exp(math.log(paths[n_b]) + log_scale - log_all)
    return float(min(max(1.0 - inside, 0.0), 1.0))


@F.pandas_udf(T.DoubleType())
def _exact(d: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    return pd.Series([ks_exact_p(x, int(a), int(b)) for x, a, b in zip(d, n_a, n_b)], dtype=float)


def ks_p_value_auto(d: Column, n_a: Column, n_b: Column) -> Column:
    """Exact up to ``EXACT_ROWS`` rows in the larger sample, asymptotic beyond.

    For reports with one row per tested pair.
    """
    small = F.greatest(n_a, n_b) <= EXACT_ROWS
    one = F.lit(1).cast("long")
    exact = _exact(
        F.when(small, d).otherwise(2.0), F.when(small, n_a).otherwise(one),
        F.when(small, n_b).otherwise(one),
    )
    return F.when(small, exact).otherwise(ks_p_value(d, n_a, n_b))
