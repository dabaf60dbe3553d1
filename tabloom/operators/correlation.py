"""Pearson correlation of all column pairs and the pruning of correlated features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import safe_ratio
from tabloom.operators.frames import numeric_columns
from tabloom.operators.moments import pair_moments
from tabloom.session import small_table

# A deviation this small against the mean is rounding of a constant column.
NO_SPREAD = 1e-15


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(i, j, feature_i, feature_j, r)` for i < j over rows where both have values.

    r is null where one of the two is constant or has no values there.
    """
    return correlations(pair_moments(df, columns), columns)


def correlations(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same from cells of `pair_moments`, one group only."""
    vx, vy, cov = F.col("cxx"), F.col("cyy"), F.col("cxy")
    spread = (vx > F.col("n") * F.pow(F.col("mx") * NO_SPREAD, 2)) & (vy > F.col("n") * F.pow(F.col("my") * NO_SPREAD, 2))
    r = F.when(spread, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), safe_ratio(cov, F.sqrt(vx * vy)))))
    names = F.array(*[F.lit(c) for c in columns])
    # columns of one value or none stand on the diagonal
    flat = cells.where("i = j").where(~F.coalesce(F.col("lo") < F.col("hi"), F.lit(False))).select(F.col("i").alias("flat"))
    named = cells.where("i < j").select("i", "j", F.get(names, "i").alias("feature_i"), F.get(names, "j").alias("feature_j"), r.alias("r"))
    marked = named.join(flat, (F.col("flat") == F.col("i")) | (F.col("flat") == F.col("j")), "left")
    return marked.groupBy("i", "j", "feature_i", "feature_j").agg(F.when(F.count("flat") == 0, F.first("r")).alias("r"))


@dataclass(frozen=True)
class Prune:
    """Which features a fitted pruning removes: `correlated` were found, `listed` were named."""

    threshold: float
    correlated: tuple[str, ...]
    listed: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.correlated, *self.listed)


def correlated_features(pairs: DataFrame, threshold: float) -> DataFrame:
    """`(j, feature, with_feature, r)` of the features to drop: those whose |r| with any earlier column
    exceeds the threshold, dropped ones included; the first such column is named.
    """
    first = Window.partitionBy("j").orderBy("i")
    hits = pairs.where(F.abs("r") > threshold)
    return (
        hits.withColumn("nth", F.row_number().over(first))
        .where("nth = 1")
        .select("j", F.col("feature_j").alias("feature"), F.col("feature_i").alias("with_feature"), "r")
    )


def fit_prune(
    df: DataFrame,
    target: str,
    threshold: float = 0.8,
    protected: Sequence[str] = (),
    listed: Sequence[str] = (),
) -> Prune:
    columns = [c for c in numeric_columns(df) if c not in protected and c != target]
    if len(columns) < 2:
        return Prune(threshold, (), tuple(listed))
    return prune_of(correlation_pairs(df, columns), threshold, listed)


def prune_of(pairs: DataFrame, threshold: float, listed: Sequence[str] = ()) -> Prune:
    found = correlated_features(pairs, threshold).orderBy("j").collect()
    return Prune(threshold, tuple(r["feature"] for r in found), tuple(listed))


def prune_table(spark, prune: Prune) -> DataFrame:
    rows = [(f, "correlated") for f in prune.correlated] + [(f, "listed") for f in prune.listed]
    return small_table(spark, rows, "feature string, reason string")
