"""Numeric expressions: missing values, rounding, small formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAD_TO_SIGMA = 1.482602218505602


def finite(c: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def known(c: Column) -> Column:
    """NaN as null, so that aggregates skip it."""
    return F.when(~F.isnan(c), c)


def rounded(c: Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(c, digits) + F.lit(0.0)


def squeezed(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def sigmoid(x: Column, q: float) -> Column:
    return 1 / (1 + F.exp(-F.lit(q) * x)) - 0.5


def days_of(frequency: Column) -> Column:
    """Period in days of a frequency in microhertz."""
    return F.lit(1e6 / 86400.0) / frequency


def digamma_less_euler(n: Column) -> Column:
    """digamma(n) of a whole number, plus Euler's constant: the harmonic number of n - 1."""
    return F.when(n <= 1, F.lit(0.0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(n.cast("int") - 1, F.lit(1))), F.lit(0.0), lambda a, k: a + 1.0 / k))
