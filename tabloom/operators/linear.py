"""Ridge, lasso and elastic net from second moments.

The data is read once for its moments per fold; every trial of every fold is then a problem of
p numbers. Held-out errors also follow from the moments, so a search of any length costs one scan.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import as_double, name
from tabloom.operators.moments import pair_moments

MAX_ITER = 5000
TOLERANCE = 1e-10
#: Columns whose squared number of moments the driver holds; wider tables are refused.
WIDEST = 3000


@dataclass(frozen=True)
class Moments:
    """Sums over rows of z = (features, target) minus `shift`: n, sum z, sum z z'."""

    features: tuple[str, ...]
    target: str
    shift: np.ndarray = field(repr=False)
    n: float
    s: np.ndarray = field(repr=False)
    ss: np.ndarray = field(repr=False)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(
            self.features, self.target, self.shift, self.n - other.n, self.s - other.s, self.ss - other.ss
        )

    def take(self, features: Sequence[str]) -> Moments:
        at = [self.features.index(f) for f in features] + [len(self.features)]
        return Moments(
            tuple(features), self.target, self.shift[at], self.n, self.s[at], self.ss[np.ix_(at, at)]
        )


def collect_moments(
    df: DataFrame, features: Sequence[str], target: str, group: str | None = None
) -> dict[int, Moments]:
    """Moments per group over rows without missing values; (p + 1)^2 numbers per group reach the driver."""
    columns = [*features, target]
    complete = df.select(*[as_double(c).alias(c) for c in columns], *([name(group)] if group else [])).dropna(
        subset=columns
    )
    size = len(columns)
    if size > WIDEST:
        raise ValueError(f"{size} columns: moments of more than {WIDEST} do not fit the driver")
    n: dict[int, float] = {}
    mean: dict[int, np.ndarray] = {}
    cov: dict[int, np.ndarray] = {}
    for r in pair_moments(complete, columns, group).collect():
        g, i, j = r["grp"], r["i"], r["j"]
        if g not in n:
            n[g], mean[g], cov[g] = r["n"], np.zeros(size), np.zeros((size, size))
        mean[g][i], mean[g][j] = r["mx"], r["my"]
        cov[g][i, j] = cov[g][j, i] = r["cxy"]
    if not n:
        raise ValueError("no complete rows to fit on")
    first = mean[min(n)]
    rows = sum(n.values())
    shift = first + sum(n[g] * (mean[g] - first) for g in sorted(n)) / rows
    out = {}
    for g in sorted(n):
        d = mean[g] - shift
        out[g] = Moments(tuple(features), target, shift, n[g], n[g] * d, cov[g] + n[g] * np.outer(d, d))
    return out


def total(parts: Mapping[int, Moments]) -> Moments:
    first, *rest = parts.values()
    n, s, ss = first.n, first.s.copy(), first.ss.copy()
    for m in rest:
        n, s, ss = n + m.n, s + m.s, ss + m.ss
    return Moments(first.features, first.target, first.shift, n, s, ss)


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def prediction(self, value_of=None) -> Column:
        """The prediction as an expression: fused into any batch or streaming projection."""
        value_of = value_of or as_double
        out = F.lit(self.intercept)
        for f, w in zip(self.features, self.coefficients):
            out = out + value_of(f) * F.lit(w)
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.prediction())

    def squared_error(self, m: Moments) -> float:
        """Sum of squared errors over the rows behind `m`, without reading them."""
        w = np.append(-np.asarray(self.coefficients), 1.0)
        # y - b - x'w over shifted values
        c = m.shift[-1] - self.intercept - float(np.dot(m.shift[:-1], self.coefficients))
        return float(w @ m.ss @ w + 2 * c * (w @ m.s) + m.n * c * c)


def fit_linear(m: Moments, kind: str, alpha: float = 0.0, l1_ratio: float = 0.5) -> LinearModel:
    """Penalised least squares with a free intercept.

    ridge: |y - Xw|^2 + alpha |w|^2. lasso and elasticnet:
    |y - Xw|^2 / (2 n) + alpha l1 |w|_1 + alpha (1 - l1) |w|^2 / 2, l1 = 1 for lasso.
    """
    mean = m.s / m.n
    cov = m.ss - np.outer(m.s, mean)
    gram, xy = cov[:-1, :-1], cov[:-1, -1]
    if kind == "ridge":
        penalised = gram + alpha * np.eye(len(xy))
        w = np.linalg.lstsq(penalised, xy, rcond=None)[0] if alpha == 0 else np.linalg.solve(penalised, xy)
    elif kind in ("lasso", "elasticnet"):
        l1 = 1.0 if kind == "lasso" else l1_ratio
        w = _descend(gram / m.n, xy / m.n, alpha * l1, alpha * (1.0 - l1))
    else:
        raise ValueError(f"unknown linear model '{kind}'")
    intercept = (mean[-1] + m.shift[-1]) - float(np.dot(mean[:-1] + m.shift[:-1], w))
    return LinearModel(m.features, tuple(float(x) for x in w), intercept)


def _descend(gram: np.ndarray, xy: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Coordinate descent on the p-by-p problem."""
    w = np.zeros(len(xy))
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    for _ in range(MAX_ITER):
        largest = 0.0
        for j in range(len(w)):
            if gram[j, j] + l2 <= 0:
                continue
            rest = xy[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[j, j] + l2)
            largest = max(largest, abs(new - w[j]) * scale[j])
            w[j] = new
        if largest <= TOLERANCE * max(1e-300, float(np.max(np.abs(w) * scale))):
            return w
    warnings.warn(f"coordinate descent did not settle in {MAX_ITER} rounds", RuntimeWarning, stacklevel=2)
    return w


def linear_shap(df: DataFrame, model: LinearModel, means: Mapping[str, float], ids: Sequence[str]) -> DataFrame:
    """`(ids..., feature, value, phi)`: the exact Shapley values of a linear model, w * (x - mean)."""
    parts = [
        F.struct(
            F.lit(f).alias("feature"),
            as_double(f).alias("value"),
            ((as_double(f) - F.lit(means[f])) * F.lit(w)).alias("phi"),
        )
        for f, w in zip(model.features, model.coefficients)
    ]
    return df.select(*[name(c) for c in ids], F.inline(F.array(*parts)))
