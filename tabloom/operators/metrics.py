"""Regression metrics, residuals and their histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import safe_ratio
from tabloom.operators.frames import as_double


def _r2(y: Column, p: Column) -> Column:
    """1 - SSE / SST over rows with both values; on constant y 1 for a perfect fit, else 0."""
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(y)
    flat = F.min(y) == F.max(y)
    return F.when(flat, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1.0 - safe_ratio(sse, sst))


def metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, r2 and n_samples over rows with both values, and n_left_out of the others, per group of `by`."""
    y, p = as_double(actual), as_double(predicted)
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    err = y - p
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        _r2(y, p).alias("r2"),
        F.count_if(both).alias("n_samples"),
        F.count_if(~both).alias("n_left_out"),
    )


def with_residual(df: DataFrame, actual: str, predicted: str, output: str = "residual") -> DataFrame:
    return df.withColumn(output, as_double(actual) - as_double(predicted))


def residual_summary(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    r = as_double(actual) - as_double(predicted)
    return df.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """`(bin, lower, upper, n)` of equal-width bins, 1 to `bins`, the last closed; empty bins included.

    A column of one value gets the range half a unit to each side.
    """
    v = as_double(column)
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    bin_ = F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return (
        every.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def axis_limits(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The common range of actual and predicted values."""
    y, p = as_double(actual), as_double(predicted)
    return df.agg(
        F.least(F.min(y), F.min(p)).alias("lower"), F.greatest(F.max(y), F.max(p)).alias("upper")
    )
