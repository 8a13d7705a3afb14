"""Tails of counting distributions. Spark has no log-gamma; these take Arrow batches and vectorise over their rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(k: int, total: int, good: int, drawn: int) -> tuple[float, float]:
    """P(X <= k) and P(X >= k)."""
    low, high = max(0, drawn - (total - good)), min(good, drawn)
    p = {x: math.exp(_choose(good, x) + _choose(total - good, drawn - x) - _choose(total, drawn)) for x in range(low, high + 1)}
    return min(1.0, sum(v for x, v in p.items() if x <= k)), min(1.0, sum(v for x, v in p.items() if x >= k))


def binomial(k: int, trials: int, share: float) -> tuple[float, float]:
    if share <= 0 or share >= 1:
        at = 0 if share <= 0 else trials
        return float(at <= k), float(at >= k)
    p = [math.exp(_choose(trials, x) + x * math.log(share) + (trials - x) * math.log1p(-share)) for x in range(trials + 1)]
    return min(1.0, sum(p[: k + 1])), min(1.0, sum(p[k:]))


def _hypergeometric_rows(k: pd.Series, total: pd.Series, good: pd.Series, drawn: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([hypergeometric(*map(int, x)) for x in zip(k, total, good, drawn, strict=True)], columns=["low", "high"])


def _binomial_rows(k: pd.Series, trials: pd.Series, share: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([binomial(int(a), int(b), float(c)) for a, b, c in zip(k, trials, share, strict=True)], columns=["low", "high"])


def hypergeometric_tails(k: ColumnOrName, total: ColumnOrName, good: ColumnOrName, drawn: ColumnOrName) -> Column:
    return F.pandas_udf(_hypergeometric_rows, "low double, high double")(k, total, good, drawn)


def binomial_tails(k: ColumnOrName, trials: ColumnOrName, share: ColumnOrName) -> Column:
    return F.pandas_udf(_binomial_rows, "low double, high double")(k, trials, share)


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    f = d
    for m in range(1, 400):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            f *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * f


def f_tail(f: float, between: float, within: float) -> float:
    """P(F >= f)."""
    return 1.0 if f <= 0 else beta_share(within / (within + between * f), within / 2, between / 2)


def chi2_tail(x: float, freedom: float) -> float:
    """P(chi-square >= x), by the series or the continued fraction of the incomplete gamma function."""
    if x <= 0:
        return 1.0
    a, z = freedom / 2, x / 2
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= z / k
            total += term
        return 1 - front * total
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        b += 2
        an = -i * (i - a)
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def f_tails(f: ColumnOrName, between: ColumnOrName, within: ColumnOrName) -> Column:
    return F.pandas_udf(lambda f, m, n: pd.Series([f_tail(*map(float, x)) for x in zip(f, m, n, strict=True)], dtype="float64"), "double")(f, between, within)


def chi2_tails(x: ColumnOrName, freedom: ColumnOrName) -> Column:
    return F.pandas_udf(lambda x, k: pd.Series([chi2_tail(float(a), float(b)) for a, b in zip(x, k, strict=True)], dtype="float64"), "double")(x, freedom)
