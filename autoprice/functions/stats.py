"""Student-t tail probabilities for the A/B t-test.

No scipy in the runtime, so the two-sided p-value ``I_{df/(df+t^2)}(df/2, 1/2)`` uses the
regularised incomplete beta function by Lentz's continued fraction. It runs in a pandas UDF over
one row per compared metric, never over data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 3e-16
_TINY = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom; NaN for undefined inputs."""
    if t is None or df is None or not np.isfinite(df) or df <= 0 or (isinstance(t, float) and math.isnan(t)):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


def t_critical(alpha: float, df: float) -> float:
    """|t| above which the two-sided p-value is below ``alpha`` (bisection on the CDF)."""
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_two_sided_p(mid, df) > alpha:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


@F.pandas_udf(T.DoubleType())
def _p_value_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
                      for a, b in zip(t, df)], dtype="float64")


def p_value(t: Column, df: Column) -> Column:
    """Two-sided Student-t p-value column (NULL stays NULL, NaN for undefined statistics)."""
    return _p_value_udf(t.cast("double"), df.cast("double"))
