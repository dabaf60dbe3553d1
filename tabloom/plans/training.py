"""The training run: ingest, features, split, search, evaluation, kept artifacts."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.profile import training_medians
from tabloom.operators.split import with_exact_split, with_fold
from tabloom.operators.validate import (
    MIN_COLUMNS,
    REQUIRED_COLUMNS,
    manifest,
    row_fingerprint,
    validate,
)
from tabloom.plans.evaluation import evaluate, ranked_features, reduction_sweep, run_report
from tabloom.plans.features import fit_features, from_config
from tabloom.plans.search import (
    best_trial,
    draw_trials,
    fit_winner,
    fold_scores,
    promote,
    refit,
    score_trials,
    trial_table,
)
from tabloom.session import small_table
from tabloom.sources.tables import read_csv, read_optional_csv, uri, write_small, write_table

log = logging.getLogger(__name__)

DIGEST = "_row_digest"


def load_config(path: str) -> dict:
    """A JSON config, or a YAML one where a YAML reader is installed."""
    text = Path(path).read_text()
    if path.endswith((".yml", ".yaml")):
        import yaml

        return yaml.safe_load(text)
    return json.loads(text)


def ingest(spark: SparkSession, cfg: Mapping) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(validated table, manifest, metadata table or None)."""
    data = cfg["data"]
    remote = cfg.get("storage", {}).get("backend") == "s3"
    path = uri(cfg, data["s3_raw_train_key"]) if remote else data["raw_train_path"]
    df = read_csv(spark, path)
    # the manifest counts the nulls, so the checks need not
    validate(df, data.get("required_columns", REQUIRED_COLUMNS), data.get("min_columns", MIN_COLUMNS), null_counts=False)
    counted = manifest(df, path, row_fingerprint(df).first()["fingerprint"])
    row = counted.first()
    if row["missing_values"]:
        log.warning("Null values in columns: %s", row["missing_values"])
    record = spark.createDataFrame([tuple(row)], counted.schema)
    return df, record, read_optional_csv(spark, data.get("raw_metadata_path"))


def run_training(
    spark: SparkSession, cfg: Mapping, n_trials: int | None = None, fit_on: str = "train"
) -> dict:
    """Run all steps and keep their results below `artifacts.model_dir`.

    `fit_on="train"` fits the feature plan on training rows only; "all" fits it before the split.
    Each stage reads what the one before wrote, so no stage repeats another's work.
    """
    target = cfg["feature_engineering"]["engineered_target_column"]
    seed = cfg["experiment"]["random_seed"]
    out = uri(cfg, cfg["artifacts"]["model_dir"]).rstrip("/")

    raw, record, _ = ingest(spark, cfg)
    keyed = raw.withColumn(DIGEST, F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]))
    split = with_exact_split(keyed, [DIGEST], cfg["preprocessing"]["test_size"], seed)
    write_table(with_fold(split, [DIGEST], cfg["modeling"]["cv_folds"], seed + 1), f"{out}/split")
    marked = spark.read.parquet(f"{out}/split")

    marks = ["split", "fold"]
    fit_rows = marked if fit_on == "all" else marked.where("split = 'train'")
    plan = fit_features(fit_rows, from_config(cfg), ignore=[DIGEST, *marks])
    small_table(spark, [(plan.to_json(),)], "plan string").coalesce(1).write.mode("overwrite").json(f"{out}/feature_plan")
    processed = uri(cfg, cfg["data"]["s3_processed_key"]) if out.startswith("s3a:") else cfg["data"]["processed_path"]
    write_table(plan.transform(marked, keep=marks), processed)
    ready = spark.read.parquet(processed)
    train, test = ready.where("split = 'train'"), ready.where("split = 'test'")
    features = list(plan.features)
    write_small(training_medians(train, features), f"{out}/feature_medians")

    modeling = cfg["modeling"]
    n = n_trials or modeling["n_trials"]
    trials = draw_trials(n, modeling["search_space"], seed)
    scores = fold_scores(train, features, target, trials, "fold", seed)
    write_small(score_trials(trial_table(spark, trials), scores), f"{out}/trials")
    scored = spark.read.schema("trial int, family string, params map<string,string>, cv_rmse double").json(
        f"{out}/trials"
    )
    best = best_trial(scored).first()
    full = fit_winner(train, features, target, trials[best["trial"]], best["cv_rmse"], n, seed)

    evaluation = cfg["evaluation"]
    order = ranked_features(full, spark)
    sweep = reduction_sweep(full, train, test, target, evaluation["feature_counts"], order, seed)
    write_small(sweep, f"{out}/sweep")
    top = order[: evaluation["final_top_k_features"]]
    small = refit(full, train, top, target, seed)
    full_metrics = evaluate(full, test, target, "full")
    top_metrics = evaluate(small, test, target, "top_k")
    write_small(full_metrics.unionByName(top_metrics), f"{out}/metrics")
    write_small(run_report(full_metrics, top_metrics), f"{out}/report")

    full.save(spark, f"{out}/{_stem(cfg['artifacts']['model_filename'])}")
    small.save(spark, f"{out}/{_stem(cfg['artifacts']['top_k_model_filename'])}")
    write_small(small_table(spark, enumerate(top), "position int, feature string"), f"{out}/top_features")
    write_small(record, f"{out}/data_manifest")
    _register(spark, cfg, out, best["cv_rmse"])

    m = spark.read.json(f"{out}/metrics").where("label = 'top_k'").first()
    return {
        "model_type": full.family,
        "cv_rmse": best["cv_rmse"],
        "test_rmse": m["rmse"],
        "test_r2": m["r2"],
        "top_features": top,
    }


def _stem(filename: str) -> str:
    return filename.rsplit(".", 1)[0]


def _register(spark: SparkSession, cfg: Mapping, out: str, cv_rmse: float) -> None:
    """Append a version row to the registry table, unless promotion is switched off."""
    settings = cfg.get("mlflow") or {}
    if not settings.get("promote_to_staging_on_improvement", True):
        return
    path = f"{out}/registry"
    candidate = small_table(
        spark, [(settings.get("registered_model_name", "model"), 0, cv_rmse)], "name string, seq int, cv_rmse double"
    )
    try:
        versions = spark.read.parquet(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        versions = None
    promote(versions, candidate, float(settings.get("staging_rmse_threshold", 1.0))).write.mode("append").parquet(path)
