"""Tail probabilities of test statistics, for one-row results.

Spark has no distribution functions, so a small Arrow UDF evaluates them on the finished statistic.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


LARGE_DF = 1e5  # from here on the gamma functions lose more digits than the transformation


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_square_one_df(x: float) -> float:
    return math.erfc(math.sqrt(x / 2.0))


def t_two_sided(t: float, df: float) -> float:
    if df > LARGE_DF:
        # The normal transformation of t; its error falls with the square of df.
        z = math.sqrt(df * math.log1p(t * t / df)) * (8.0 * df + 1.0) / (8.0 * df + 3.0)
        return normal_two_sided(z)
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    fraction = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            fraction *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return front * fraction / a
    raise ArithmeticError(f"incomplete beta function did not converge for a={a}, b={b}, x={x}")


# Executors receive these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _p_normal(z: pd.Series) -> pd.Series:
    return z.map(normal_two_sided, na_action="ignore")


def _p_chi_square(x: pd.Series) -> pd.Series:
    return x.map(chi_square_one_df, na_action="ignore")


def _p_student_t(t: pd.Series, df: pd.Series) -> pd.Series:
    known = t.notna() & df.notna()
    values = [t_two_sided(a, b) if ok else None for a, b, ok in zip(t, df, known)]
    return pd.Series(values, dtype="float64")


def p_normal(z: Column) -> Column:
    return F.pandas_udf(_p_normal, DoubleType())(z)


def p_chi_square(x: Column) -> Column:
    return F.pandas_udf(_p_chi_square, DoubleType())(x)


def p_student_t(t: Column, df: Column) -> Column:
    return F.pandas_udf(_p_student_t, DoubleType())(t, df)
