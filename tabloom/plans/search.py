"""Model search: trial draws, cross-validated scores, the winner and its record."""

from __future__ import annotations

import json
import logging
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.operators.boosting import Spec, TreeModel, binned, fit_models, from_nodes, growth_of, held_out_errors
from tabloom.operators.linear import LinearModel, collect_moments, fit_linear, total
from tabloom.operators.trees import complete_rows, fit_trees
from tabloom.session import small_table

log = logging.getLogger(__name__)

FAMILIES = ("linear", "lightgbm", "xgboost", "random_forest")

# The search space. (low, high) ranges; "log" draws on a log scale, "int" whole numbers.
BOOSTED_SPACE = {
    "n_estimators": ("int", 200, 1000),
    "learning_rate": ("log", 1e-3, 0.3),
    "max_depth": ("int", 3, 15),
    "subsample": ("float", 0.5, 1.0),
    "colsample_bytree": ("float", 0.5, 1.0),
}
SPACES = {
    "lightgbm": {**BOOSTED_SPACE, "num_leaves": ("int", 10, 200)},
    "xgboost": {**BOOSTED_SPACE, "gamma": ("float", 0.0, 5.0)},
    "random_forest": {
        "n_estimators": ("int", 100, 500),
        "max_depth": ("int", 5, 30),
        "max_features": ("choice", "sqrt", "log2"),
        "min_samples_split": ("int", 2, 10),
        "min_samples_leaf": ("int", 1, 4),
    },
}
LINEAR_KINDS = ("ridge", "lasso", "elasticnet")
ALPHA_RANGE = ("log", 1e-4, 10.0)
L1_RANGE = ("float", 0.0, 1.0)


@dataclass(frozen=True)
class Trial:
    number: int
    family: str
    params: Mapping[str, object]


def _draw(rng: random.Random, spec: tuple) -> object:
    kind, *limits = spec
    if kind == "choice":
        return rng.choice(limits)
    low, high = limits
    if kind == "int":
        return rng.randint(low, high)
    if kind == "log":
        return math.exp(rng.uniform(math.log(low), math.log(high)))
    return rng.uniform(low, high)


def draw_trials(n: int, families: Sequence[str] = FAMILIES, seed: int = 42) -> list[Trial]:
    """Seeded random draws; which parameters a trial has depends on its family."""
    rng = random.Random(seed)
    trials = []
    for number in range(n):
        family = rng.choice(list(families))
        if family == "linear":
            params: dict[str, object] = {"reg_type": rng.choice(LINEAR_KINDS), "alpha": _draw(rng, ALPHA_RANGE)}
            if params["reg_type"] == "elasticnet":
                params["l1_ratio"] = _draw(rng, L1_RANGE)
        else:
            params = {k: _draw(rng, spec) for k, spec in SPACES[family].items()}
        trials.append(Trial(number, family, params))
    return trials


def _linear(moments, params: Mapping[str, object]) -> LinearModel:
    return fit_linear(
        moments, str(params["reg_type"]), float(params["alpha"]), float(params.get("l1_ratio", 0.5))
    )


def _linear_scores(df, features, target, fold, trials) -> list[tuple[int, int, float]]:
    parts = collect_moments(df, features, target, fold)
    everything = total(parts)
    rows = []
    for f, held_out in parts.items():
        train = everything - held_out
        for t in trials:
            sse = _linear(train, t.params).squared_error(held_out)
            rows.append((t.number, f, max(0.0, sse) / held_out.n))
    return rows


def _tree_scores(df, features, target, fold, trials, seed) -> list[tuple[int, int, float]]:
    """All trials and folds are fitted side by side on one binned table, and scored in one pass.

    A trial whose parameters a learner refuses gets no error in any fold; the reason is logged.
    """
    good = []
    for t in trials:
        try:
            growth_of(t.family, t.params)
            good.append(t)
        except (KeyError, TypeError, ValueError) as error:
            log.warning("trial %d failed: %s", t.number, error)
    if not good:
        return []
    matrix = binned(complete_rows(df, features, target, fold), features, target, fold)
    folds = sorted(r[0] for r in matrix.rows.select("fold").distinct().collect())
    pairs = [(t, f) for t in good for f in folds]
    specs = [Spec(t.family, t.params, f) for t, f in pairs]
    errors = held_out_errors(matrix, fit_models(matrix, specs, seed), specs)
    return [(t.number, f, s / n) for (t, f), (s, n) in zip(pairs, errors)]


def fold_scores(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    trials: Sequence[Trial],
    fold: str = "fold",
    seed: int = 42,
) -> DataFrame:
    """`(trial, fold, mse)`. All linear trials share one scan, and all tree trials every pass of their fits."""
    linear = [t for t in trials if t.family == "linear"]
    trees = [t for t in trials if t.family != "linear"]
    rows: list[tuple[int, int, float]] = []
    if linear:
        rows += _linear_scores(df, features, target, fold, linear)
    if trees:
        rows += _tree_scores(df, features, target, fold, trees, seed)
    return small_table(df.sparkSession, rows, "trial int, fold int, mse double")


def trial_table(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    rows = [(t.number, t.family, {k: str(v) for k, v in t.params.items()}) for t in trials]
    return small_table(spark, rows, "trial int, family string, params map<string,string>")


def score_trials(trials: DataFrame, scores: DataFrame) -> DataFrame:
    """Add `cv_rmse`, the root of the mean of the folds' mean squared errors; null for a failed trial."""
    per_trial = scores.groupBy("trial").agg(F.sqrt(F.avg("mse")).alias("cv_rmse"))
    return trials.join(per_trial, "trial", "left")


def best_trial(scored: DataFrame) -> DataFrame:
    """The one trial of least cv_rmse, the earliest among equals."""
    done = scored.where("cv_rmse is not null")
    best = done.agg(F.min_by(F.struct(*done.columns), F.struct("cv_rmse", "trial")).alias("b"))
    return best.where("b is not null").select("b.*")


def best_so_far(scored: DataFrame) -> DataFrame:
    """`(trial, cv_rmse, best)`: the running minimum; infinity before the first success.

    The trial table has one row per trial, so one window partition is enough.
    """
    upto = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    best = F.coalesce(F.min("cv_rmse").over(upto), F.lit(float("inf")))
    return scored.select("trial", "cv_rmse", best.alias("best"))


@dataclass
class FittedModel:
    """A fitted model with its record. `cv_rmse` always belongs to the full feature set."""

    family: str
    params: dict
    features: tuple[str, ...]
    model: LinearModel | TreeModel
    cv_rmse: float | None
    n_trials: int
    train_rows: int
    searched_features: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction`."""
        return self.model.transform(df)

    def record(self, spark: SparkSession) -> DataFrame:
        row = (
            self.family,
            {k: str(v) for k, v in self.params.items()},
            None if self.cv_rmse is None else round(self.cv_rmse, 6),
            self.n_trials,
            len(self.features),
            list(self.features),
            self.train_rows,
            self.searched_features,
        )
        return small_table(
            spark,
            [row],
            "model_type string, best_params map<string,string>, cv_rmse double, n_trials int, n_features int, "
            "feature_names array<string>, train_rows bigint, searched_features int",
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Model and record under `path`."""
        self.record(spark).coalesce(1).write.mode("overwrite").json(f"{path}/record")
        if isinstance(self.model, LinearModel):
            text = json.dumps({"coefficients": self.model.coefficients, "intercept": self.model.intercept})
            small_table(spark, [(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/linear")
        else:
            head = [(self.model.base, self.model.boosted)]
            small_table(spark, head, "base double, boosted boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
            self.model.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    """Read a saved model; a missing path raises Spark's path error."""
    r = spark.read.json(f"{path}/record").first().asDict(recursive=True)
    features = tuple(r["feature_names"])
    if r["model_type"] == "linear":
        d = json.loads(spark.read.text(f"{path}/linear").first()[0])
        model = LinearModel(features, tuple(d["coefficients"]), d["intercept"])
    else:
        head = spark.read.parquet(f"{path}/trees").first()
        model = from_nodes(features, head["base"], spark.read.parquet(f"{path}/nodes").collect(), head["boosted"])
    params = {k: v for k, v in (r.get("best_params") or {}).items() if v is not None}
    return FittedModel(
        r["model_type"], params, features, model, r.get("cv_rmse"), r["n_trials"], r["train_rows"], r["searched_features"]
    )


def fit_family(df: DataFrame, features: Sequence[str], target: str, family: str, params: dict, seed: int = 42):
    if family == "linear":
        return _linear(collect_moments(df, features, target)[0], params)
    return fit_trees(df, features, target, family, params, seed)


def fit_winner(
    train: DataFrame, features: Sequence[str], target: str, trial: Trial, cv_rmse: float, n_trials: int, seed: int = 42
) -> FittedModel:
    """The trial's model on the whole training split."""
    params = dict(trial.params)
    if trial.family == "linear":
        moments = collect_moments(train, features, target)[0]
        model, rows = _linear(moments, params), int(moments.n)
    else:
        matrix = binned(complete_rows(train, features, target), features, target)
        model, rows = fit_models(matrix, [Spec(trial.family, params)], seed)[0], matrix.rows.count()
    return FittedModel(trial.family, params, tuple(features), model, cv_rmse, n_trials, rows, len(features))


def refit(fitted: FittedModel, train: DataFrame, features: Sequence[str], target: str, seed: int = 42) -> FittedModel:
    """The same architecture on fewer features, as a new model."""
    model = fit_family(train, features, target, fitted.family, fitted.params, seed)
    return FittedModel(
        fitted.family,
        fitted.params,
        tuple(features),
        model,
        fitted.cv_rmse,
        fitted.n_trials,
        fitted.train_rows,
        fitted.searched_features,
    )


def promote(versions: DataFrame | None, candidates: DataFrame, threshold: float = 1.0) -> DataFrame:
    """New rows `(name, version, cv_rmse, stage)` for candidates `(name, seq, cv_rmse)`.

    Versions count up per name; the stage is Staging strictly below the threshold, else None.
    Rows already registered stay as they are.
    """
    nth = F.row_number().over(Window.partitionBy("name").orderBy("seq"))
    if versions is None:
        numbered = candidates.select("name", nth.alias("version"), "cv_rmse")
    else:
        latest = versions.groupBy("name").agg(F.max("version").alias("latest"))
        numbered = candidates.join(latest, "name", "left").select(
            "name", (nth + F.coalesce("latest", F.lit(0))).alias("version"), "cv_rmse"
        )
    stage = F.when(F.col("cv_rmse") < threshold, F.lit("Staging")).otherwise(F.lit("None"))
    return numbered.withColumn("stage", stage)
