"""Tail probability of the Kolmogorov-Smirnov distance, as the limit series in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 100
# Below this scaled distance the tail is 1 to more places than a double shows.
FLAT_BELOW = 0.2


def asymptotic_tail(d: Column, n: Column, m: Column) -> Column:
    """2 * sum((-1)^(k-1) * exp(-2 k^2 x^2)) at x = d * sqrt(n m / (n + m))."""
    n, m = n.cast("double"), m.cast("double")
    x = d * F.sqrt(n * m / (n + m))

    def add(total: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        return total + sign * F.exp(F.lit(-2.0) * k * k * x * x)

    series = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), F.lit(0.0), add)
    return F.when(x < FLAT_BELOW, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
