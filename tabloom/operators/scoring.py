"""Scoring of feature maps and tables, with or without imputation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import require

Score = Callable[[DataFrame], DataFrame]


def given_value(given: Column, feature: str) -> Column:
    """A feature's value in a map; NaN is missing, as it is at every source."""
    return F.nanvl(given[feature], F.lit(None).cast("double"))


def impute(
    requests: DataFrame, expected: Sequence[str], medians: Mapping[str, float], features: str = "features"
) -> DataFrame:
    """One column per expected feature from a map column: the given value, else the median.

    Adds `imputed_features` (feature order) and `unfillable`, the expected features that have
    neither. Everything is one projection, so it serves batches and streams alike.
    """
    given = F.col(features)

    def value(f: str) -> Column:
        return F.coalesce(given_value(given, f), F.lit(medians.get(f)).cast("double"))

    def named(names: Sequence[str]) -> Column:
        if not names:
            return F.array().cast("array<string>")
        return F.array_compact(F.array(*[F.when(given_value(given, f).isNull(), F.lit(f)) for f in names]))

    filled = [f for f in expected if f in medians]
    hopeless = [f for f in expected if f not in medians]
    return requests.select(
        "*",
        *[value(f).alias(f) for f in expected],
        named(filled).alias("imputed_features"),
        named(hopeless).alias("unfillable"),
    )


def score_requests(
    requests: DataFrame,
    expected: Sequence[str],
    medians: Mapping[str, float],
    score: Score,
    model_type: str = "unknown",
    features: str = "features",
) -> tuple[DataFrame, DataFrame]:
    """(scored, rejects). A rejected row names the first feature that cannot be filled."""
    ready = impute(requests, expected, medians, features)
    rejects = ready.where(F.size("unfillable") > 0).select(
        *requests.columns,
        F.concat(
            F.lit("no value and no median for feature '"), F.get("unfillable", F.lit(0)), F.lit("'")
        ).alias("reason"),
    )
    scored = score(ready.where(F.size("unfillable") == 0).drop("unfillable"))
    return with_record(scored, expected, model_type), rejects


def score_strict(df: DataFrame, expected: Sequence[str], score: Score, model_type: str = "unknown") -> DataFrame:
    """Score a table that must have every expected column; further columns are ignored by the model."""
    require(df, expected)
    return with_record(score(df), expected, model_type)


def absent_everywhere(requests: DataFrame, expected: Sequence[str], features: str = "features") -> list[str]:
    """Expected features that no row of a batch of maps gives."""
    seen = requests.agg(*[F.bool_or(given_value(F.col(features), f).isNotNull()).alias(f"s{i}") for i, f in enumerate(expected)])
    row = seen.first()
    return sorted(f for i, f in enumerate(expected) if not row[f"s{i}"])


def score_batch(
    requests: DataFrame, expected: Sequence[str], score: Score, model_type: str = "unknown", features: str = "features"
) -> DataFrame:
    """Score a batch of maps without imputation. A feature absent from all rows fails the batch,
    one absent from some reaches the model as a missing value.
    """
    absent = absent_everywhere(requests, expected, features)
    if absent:
        raise ValueError(f"features that no row gives: {absent}")
    wide = requests.select("*", *[given_value(F.col(features), f).alias(f) for f in expected])
    return with_record(score(wide), expected, model_type)


def with_record(scored: DataFrame, expected: Sequence[str], model_type: str) -> DataFrame:
    """Add the model's name, its number of features, and a request id where there is none."""
    out = scored.withColumn("model_type", F.lit(model_type)).withColumn("n_features", F.lit(len(expected)))
    if "request_id" not in out.columns:
        return out.withColumn("request_id", F.uuid())
    return out.withColumn("request_id", F.coalesce("request_id", F.uuid()))
