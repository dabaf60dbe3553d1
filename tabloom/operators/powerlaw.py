"""Box-Cox transform of a positive column with a fitted exponent."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabloom.functions.columns import NEAR_ZERO, boxcox, boxcox_inverse
from tabloom.operators.frames import as_double, name
from tabloom.session import small_table

POINTS = 9
START = (-2.0, 2.0)
FARTHEST = 100.0
ROUNDS = 50
SERIES_BELOW = 1e-4


@dataclass(frozen=True)
class BoxCox:
    source: str
    output: str
    lmbda: float

    def apply(self, df: DataFrame) -> DataFrame:
        """The transformed column replaces its source and stands last."""
        return df.withColumn(self.output, boxcox(name(self.source).cast("double"), self.lmbda)).drop(self.source)

    def inverse(self, df: DataFrame, column: str, output: str) -> DataFrame:
        return df.withColumn(output, boxcox_inverse(name(column), self.lmbda))


def log_likelihoods(df: DataFrame, column: str, lambdas: Sequence[float]) -> DataFrame:
    """`(lmbda, llf)`: the profile log-likelihood at each exponent, all from one aggregate."""
    n, mean_log = _positive_stats(df, column)
    variances = _variances(_scaled_logs(df, column, mean_log), lambdas)
    rows = [(float(lam), -n / 2.0 * math.log(v) - n * mean_log) for lam, v in zip(lambdas, variances)]
    return small_table(df.sparkSession, rows, "lmbda double, llf double")


def _positive_stats(df: DataFrame, column: str) -> tuple[int, float]:
    v = as_double(column)
    row = df.agg(F.count(v), F.avg(F.when(v > 0, F.ln(v))), F.min(v), F.max(v)).first()
    n, mean_log, low, high = row
    if n == 0:
        raise ValueError(f"Column '{column}' holds no values.")
    if low <= 0:
        raise ValueError(f"Box-Cox requires strictly positive values; column '{column}' has zero or negative ones.")
    if low == high:
        raise ValueError(f"Box-Cox cannot be fitted to the constant column '{column}'.")
    return n, mean_log


def _scaled_logs(df: DataFrame, column: str, mean_log: float) -> DataFrame:
    """`z = ln(x / g)` with the geometric mean g: taken out, it leaves the likelihood -n / 2 ln(var) - n ln(g)."""
    return df.select((F.ln(as_double(column)) - F.lit(mean_log)).alias("z")).where("z is not null")


def _variances(z: DataFrame, lambdas: Sequence[float]) -> list[float]:
    """Variance of (exp(lambda z) - 1) / lambda at each exponent. Its values lie around 0, so plain sums do."""
    sums = []
    for lam in lambdas:
        y = F.col("z") if abs(lam) < NEAR_ZERO else F.expm1(F.col("z") * F.lit(lam)) / F.lit(lam)
        sums += [F.sum(y), F.sum(y * y)]
    n, *s = z.agg(F.count("*"), *sums).first()
    return [s[2 * i + 1] / n - (s[2 * i] / n) ** 2 for i in range(len(lambdas))]


def _variance_slopes(z: DataFrame, lam: float) -> tuple[float, float]:
    """First and second derivative of the variance by the exponent, from one aggregate."""
    c = F.col("z")
    if abs(lam) < SERIES_BELOW:
        y = c + lam * c * c / 2 + lam * lam * c * c * c / 6
        y1 = c * c / 2 + lam * c * c * c / 3 + lam * lam * c * c * c * c / 8
        y2 = c * c * c / 3 + lam * c * c * c * c / 4 + lam * lam * c * c * c * c * c / 10
        parts = z.select(y.alias("y"), y1.alias("y1"), y2.alias("y2"))
    else:
        power = z.select(c, F.exp(c * F.lit(lam)).alias("e"))
        first = power.select("z", "e", ((F.col("e") - 1) / F.lit(lam)).alias("y"))
        second = first.select("z", "e", "y", ((c * F.col("e") - F.col("y")) / F.lit(lam)).alias("y1"))
        parts = second.select("y", "y1", ((c * c * F.col("e") - 2 * F.col("y1")) / F.lit(lam)).alias("y2"))
    y, y1, y2 = F.col("y"), F.col("y1"), F.col("y2")
    m = parts.agg(
        F.avg(y), F.avg(y1), F.avg(y2), F.avg(y * y1), F.avg(y1 * y1), F.avg(y * y2)
    ).first()
    my, m1, m2, my1, m11, my2 = m
    return 2 * (my1 - my * m1), 2 * (m11 - m1 * m1 + my2 - my * m2)


def fit_boxcox(df: DataFrame, source: str, output: str, tolerance: float = 1e-9) -> BoxCox:
    """Maximum-likelihood exponent, the one of least variance once the geometric mean is taken out.

    A coarse grid from one scan encloses it, Newton steps close in; a step that leaves the enclosing
    interval halves it instead. The scans read one kept column of logarithms.
    """
    n, mean_log = _positive_stats(df, source)
    z = _scaled_logs(df, source, mean_log).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lo, hi = START
        while True:
            step = (hi - lo) / (POINTS - 1)
            grid = [lo + i * step for i in range(POINTS)]
            scores = _variances(z, grid)
            best = scores.index(min(scores))
            if 0 < best < POINTS - 1:
                break
            if abs(grid[best]) > FARTHEST:
                raise ValueError(f"no exponent within {FARTHEST} maximises the likelihood of column '{source}'.")
            lo, hi = (lo - (hi - lo), lo + step) if best == 0 else (hi - step, hi + (hi - lo))
        at = grid[best]
        lo, hi = at - step, at + step
        for _ in range(ROUNDS):
            slope, curve = _variance_slopes(z, at)
            lo, hi = (lo, at) if slope > 0 else (at, hi)
            to = at - slope / curve if curve > 0 else (lo + hi) / 2
            if not lo <= to <= hi:
                to = (lo + hi) / 2
            moved, at = abs(to - at), to
            if moved < tolerance:
                return BoxCox(source, output, at)
        raise ValueError(f"the exponent of column '{source}' did not settle in {ROUNDS} steps.")
    finally:
        z.unpersist()
