"""Feature profiles, medians, dictionaries, skewness and the prediction summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import as_double
from tabloom.operators.quantiles import ORDER_ROWS, column_quantiles, exact_quantiles
from tabloom.session import small_table

# Range columns of a profile and their ranks.
RANGES = {"min": 0.0, "max": 1.0, "p25": 0.25, "p75": 0.75}


def feature_order(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return small_table(df.sparkSession, list(enumerate(features)), "position int, feature string")


def training_medians(df: DataFrame, features: Sequence[str], order_rows: int = ORDER_ROWS) -> DataFrame:
    """`(feature, median)`; kept with the model for imputation."""
    return exact_quantiles(df, features, [0.5], order_rows).select("feature", F.col("value").alias("median"))


def medians_dict(medians: DataFrame) -> dict[str, float]:
    """One number per feature, for use in expressions."""
    return {r["feature"]: r["median"] for r in medians.collect()}


def describe_features(features: DataFrame, dictionary: DataFrame) -> DataFrame:
    """`features` with a `description`: the dictionary's, or the feature's own name.

    Both tables hold one row per column of a data table. Spark broadcasts the dictionary
    by its size, so no hint is given.
    """
    return features.join(dictionary.select("feature", "description"), "feature", "left").withColumn(
        "description", F.coalesce("description", "feature")
    )


def feature_profile(
    df: DataFrame,
    features: Sequence[str],
    medians: DataFrame,
    dictionary: DataFrame,
    order_rows: int = ORDER_ROWS,
) -> DataFrame:
    """Per feature: description, stored median (0.0 if unknown), range and quartiles, all to 4 places.

    A feature the table does not have keeps null range columns.
    """
    present = [f for f in features if f in df.columns]
    found = column_quantiles(df, present, list(RANGES.values()), order_rows) if present else {}
    ranges = small_table(
        df.sparkSession,
        [(f, *[float(found[f, p]) if (f, p) in found else None for p in RANGES.values()]) for f in features],
        "feature string, " + ", ".join(f"{c} double" for c in RANGES),
    )
    rows = (
        describe_features(feature_order(df, features), dictionary)
        .join(medians.select("feature", "median"), "feature", "left")
        .join(ranges, "feature")
    )
    return rows.orderBy("position").select(
        "feature",
        "description",
        F.round(F.coalesce("median", F.lit(0.0)), 4).alias("median"),
        F.lit(True).alias("auto_imputed_if_missing"),
        *[F.round(c, 4).alias(c) for c in RANGES],
    )


def example_row(features: DataFrame, medians: DataFrame) -> DataFrame:
    """`(feature, example)`: the stored median to 4 places, 0.0 if unknown."""
    return features.join(medians.select("feature", "median"), "feature", "left").select(
        "feature", F.round(F.coalesce("median", F.lit(0.0)), 4).alias("example")
    )


def skewness(c: Column) -> Column:
    """Population skewness; null on a constant column."""
    return F.skewness(c)


def prediction_summary(log: DataFrame, column: str = "prediction", order_rows: int = ORDER_ROWS) -> DataFrame:
    """One row: number of logged predictions and their distribution to 4 places (sample deviation)."""
    p = as_double(column)
    stats = log.agg(
        F.count(p).alias("n_predictions"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
    )
    found = column_quantiles(log, [column], [0.25, 0.5, 0.75], order_rows)
    quartiles = [F.lit(found.get((column, q))).cast("double").alias(a) for a, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    return stats.select("*", *quartiles).select(
        "n_predictions", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    )
