"""Forests and boosted trees by family, and importances of any fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.boosting import Spec, TreeModel, binned, errors_by_round, fit_models
from tabloom.operators.frames import as_double, name
from tabloom.operators.linear import LinearModel
from tabloom.session import small_table

BOOSTED = ("lightgbm", "xgboost")


def fit_trees(df: DataFrame, features: Sequence[str], target: str, family: str, params: dict, seed: int = 42) -> TreeModel:
    """Fit on the rows that have a target; missing features go the side that the fit learns for them."""
    return fit_models(binned(df, features, target), [Spec(family, params)], seed)[0]


def complete_rows(df: DataFrame, features: Sequence[str], target: str, *others: str) -> DataFrame:
    """The columns of a fit as doubles, rows without a missing value only: what families are compared on."""
    columns = [*features, target]
    return df.select(*[as_double(c).alias(c) for c in columns], *[name(c) for c in others]).dropna(subset=columns)


def learning_curve(model: TreeModel, df: DataFrame, target: str) -> DataFrame:
    """`(round, rmse)` of a boosted model after each of its rounds."""
    if not isinstance(model, TreeModel) or not model.boosted:
        raise AttributeError(f"a model of type {type(model).__name__} is not fitted in rounds")
    return errors_by_round(model, df, target)


def importances(model, spark) -> DataFrame:
    """`(position, feature, importance)` by falling importance: shares of the gains of trees, or |coefficients|."""
    if isinstance(model, LinearModel):
        names, values = list(model.features), [abs(w) for w in model.coefficients]
    elif isinstance(model, TreeModel):
        names, values = model.features, model.importances().tolist()
    else:
        raise AttributeError(f"a model of type {type(model).__name__} has no importances or coefficients")
    rows = [(i, f, float(v)) for i, (f, v) in enumerate(zip(names, values))]
    return small_table(spark, rows, "position int, feature string, importance double").orderBy(
        F.desc("importance"), "position"
    )


def top_k(importance: DataFrame, k: int) -> DataFrame:
    """The k most important features; all of them if there are fewer."""
    return importance.orderBy(F.desc("importance"), "position").limit(k)
