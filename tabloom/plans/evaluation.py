"""Evaluation of a fitted model: reduction sweep and run report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.boosting import Spec, binned, fit_models
from tabloom.operators.linear import collect_moments, fit_linear
from tabloom.operators.metrics import metrics
from tabloom.operators.trees import complete_rows, importances
from tabloom.plans.search import FittedModel
from tabloom.session import small_table

SWEEP_SCHEMA = "n_features int, rmse double"


def ranked_features(fitted: FittedModel, spark) -> list[str]:
    return [r["feature"] for r in importances(fitted.model, spark).collect()]


def reduction_sweep(
    fitted: FittedModel,
    train: DataFrame,
    test: DataFrame,
    target: str,
    counts: Sequence[int],
    order: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """`(n_features, rmse)`: the architecture refitted on the k most important features, scored on the test rows.

    Linear models need one scan of each side for all counts; trees are refitted side by side for all
    counts and score the test rows together.
    """
    spark = train.sparkSession
    order = list(order) if order is not None else ranked_features(fitted, spark)
    if fitted.family == "linear":
        columns = [*order, target]
        both = train.select(*columns, F.lit(0).alias("_side")).unionByName(
            test.select(*columns, F.lit(1).alias("_side"))
        )
        sides = collect_moments(both, order, target, "_side")
        fit_side, test_side = sides[0], sides[1]
        rows = []
        for k in counts:
            top = order[:k]
            p = fitted.params
            model = fit_linear(
                fit_side.take(top), str(p["reg_type"]), float(p["alpha"]), float(p.get("l1_ratio", 0.5))
            )
            held_out = test_side.take(top)
            rows.append((int(k), (max(0.0, model.squared_error(held_out)) / held_out.n) ** 0.5))
        return small_table(spark, rows, SWEEP_SCHEMA)
    scored = test
    matrix = binned(complete_rows(train, order, target), order, target)
    models = fit_models(matrix, [Spec(fitted.family, fitted.params, features=tuple(order[:k])) for k in counts], seed)
    for k, model in zip(counts, models):
        scored = model.transform(scored).withColumnRenamed("prediction", f"p{k}")
    errors = F.array(
        *[
            F.struct(
                F.lit(int(k)).alias("n_features"), F.sqrt(F.avg(F.pow(F.col(target) - F.col(f"p{k}"), 2))).alias("rmse")
            )
            for k in counts
        ]
    )
    return scored.agg(errors.alias("rows")).select(F.inline("rows"))


def run_report(full: DataFrame, top: DataFrame) -> DataFrame:
    """`(metric, full, top_k)` from two one-row metric tables."""
    names = ["rmse", "mae", "r2"]

    def long(df: DataFrame, value: str) -> DataFrame:
        return df.select(*[F.col(n).cast("double") for n in names]).unpivot([], names, "metric", value)

    return long(full, "full").join(long(top, "top_k"), "metric")


def evaluate(fitted: FittedModel, df: DataFrame, target: str, label: str = "test") -> DataFrame:
    """One row: label, rmse, mae, r2, n_samples, n_left_out."""
    return metrics(fitted.transform(df), target, "prediction").select(F.lit(label).alias("label"), "*")
