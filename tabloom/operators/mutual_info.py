"""Mutual information of each feature with the target, from two-dimensional histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.buckets import bucket_columns
from tabloom.operators.frames import as_double, melt
from tabloom.operators.grids import quantile_grids
from tabloom.operators.moments import centre_and_span


def mutual_information(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 32, method: str = "quantile"
) -> DataFrame:
    """`(feature, mutual_information)`, in nats, highest first.

    `method` cuts both axes in bins of equal mass ("quantile") or equal width ("width").
    Rows are counted per (feature, bin, bin) before the shuffle: at most bins^2 rows per feature leave a task.
    """
    features = list(features)
    if method == "width":
        binned = _width_bins(df, features, target, bins)
    elif method == "quantile":
        binned = _quantile_bins(df, features, target, bins)
    else:
        raise ValueError(f"unknown method '{method}'")
    joint = binned.groupBy("feature", "bx", "by").agg(F.count("*").alias("c"))
    total = F.sum("c").over(Window.partitionBy("feature"))
    in_x = F.sum("c").over(Window.partitionBy("feature", "bx"))
    in_y = F.sum("c").over(Window.partitionBy("feature", "by"))
    share = F.col("c") / F.col("n")
    return (
        joint.select("feature", "c", total.alias("n"), in_x.alias("nx"), in_y.alias("ny"))
        .groupBy("feature")
        .agg(F.sum(share * F.ln(F.col("c") * F.col("n") / (F.col("nx") * F.col("ny")))).alias("mutual_information"))
        .orderBy(F.desc("mutual_information"), "feature")
    )


def _width_bins(df: DataFrame, features: list[str], target: str, bins: int) -> DataFrame:
    spans = centre_and_span(df, [*features, target])

    def cell(c: str):
        _, lo, hi = spans[c]
        if lo is None or lo == hi:
            return F.when(as_double(c).isNotNull(), F.lit(0.0)).alias(c)
        at = F.floor((as_double(c) - F.lit(lo)) / F.lit((hi - lo) / bins))
        return F.least(at, F.lit(bins - 1)).cast("double").alias(c)

    cells = df.select(*[cell(c) for c in features], cell(target).alias("by")).where("by is not null")
    return melt(cells, features, ["by"]).withColumnRenamed("value", "bx")


def _quantile_bins(df: DataFrame, features: list[str], target: str, bins: int) -> DataFrame:
    columns = [*features, target]
    edges = {c: g.edges(bins) for c, g in quantile_grids(df, columns).items()}
    cells = bucket_columns(df.select(*[as_double(c).alias(c) for c in columns]), edges)
    known = cells.where(F.col(target).isNotNull()).withColumnRenamed(target, "by")
    return melt(known, features, ["by"]).withColumnRenamed("value", "bx")
