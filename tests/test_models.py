"""Splits, linear and tree fits, search, evaluation, Shapley values, the training run."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators.correlation import correlation_pairs
from tabloom.operators.linear import LinearModel, collect_moments, fit_linear, total
from tabloom.operators.metrics import histogram, metrics
from tabloom.operators.moments import collect_cells
from tabloom.operators.mutual_info import mutual_information
from tabloom.operators.scaling import scaler_of
from tabloom.operators.shapley import sampled_shapley
from tabloom.operators.split import background_sample, percent_sample, with_exact_split, with_fold, with_split
from tabloom.operators.trees import fit_trees, importances, learning_curve, top_k
from tabloom.plans.evaluation import reduction_sweep
from tabloom.plans.search import (
    SPACES,
    Trial,
    best_so_far,
    best_trial,
    draw_trials,
    fit_winner,
    fold_scores,
    load_model,
    promote,
    refit,
    score_trials,
    trial_table,
)

FOREST = {"n_estimators": 5, "max_depth": 4, "max_features": "sqrt", "min_samples_leaf": 1}
BOOSTED = {"n_estimators": 5, "learning_rate": 0.3, "max_depth": 3, "subsample": 1.0, "colsample_bytree": 1.0}
NAMES = ["f0", "f1", "f2", "f3"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4)) * [1, 2, 0.5, 1] + [0, 5, -3, 100]
    y = 2 * x[:, 0] - 1.5 * x[:, 1] + rng.normal(scale=0.05, size=300)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in NAMES) + ", y double").cache()


def test_split_is_disjoint_and_complete(spark):
    df = with_split(spark.range(5000), ["id"], 0.2)
    n = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(n.values()) == 5000 and abs(n["test"] - 1000) < 120
    again = with_split(spark.range(5000).repartition(7), ["id"], 0.2)
    assert df.exceptAll(again).isEmpty()


@pytest.mark.parametrize("order_rows", [5_000_000, 20])
def test_exact_split_counts(spark, order_rows):
    for n, want in ((21263, 4253), (7, 2), (5, 1)):
        df = with_exact_split(spark.range(n), ["id"], 0.2, order_rows=order_rows)
        assert df.where("split = 'test'").count() == want == math.ceil(0.2 * n)


def test_folds_cover_all(spark):
    n = {r["fold"]: r["count"] for r in with_fold(spark.range(3000), ["id"], 5).groupBy("fold").count().collect()}
    assert sorted(n) == [0, 1, 2, 3, 4] and sum(n.values()) == 3000


def test_percent_sample(spark):
    assert percent_sample(spark.range(500), "id", 100.0).count() == 500
    assert percent_sample(spark.range(500), "id", 0.0).count() == 0


def test_ridge_solves_the_normal_equations(table, data):
    x, y = data
    m = total(collect_moments(table, NAMES, "y"))
    for alpha in (0.0, 3.0):
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
        model = fit_linear(m, "ridge", alpha)
        assert np.allclose(model.coefficients, w, rtol=1e-8)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-8)
        p = x @ w + model.intercept
        assert model.squared_error(m) == pytest.approx(((y - p) ** 2).sum(), rel=1e-6)


@pytest.mark.parametrize("kind,l1", [("lasso", 1.0), ("elasticnet", 0.3)])
def test_penalised_fits_meet_the_optimality_conditions(table, data, kind, l1):
    x, y = data
    alpha = 0.4
    model = fit_linear(total(collect_moments(table, NAMES, "y")), kind, alpha, l1)
    w = np.array(model.coefficients)
    r = y - x @ w - model.intercept
    grad = -x.T @ r / len(y) + alpha * (1 - l1) * w
    assert abs(r.mean()) < 1e-8
    for j in range(4):
        if w[j] == 0:
            assert abs(grad[j]) <= alpha * l1 + 1e-8
        else:
            assert grad[j] == pytest.approx(-alpha * l1 * np.sign(w[j]), abs=1e-7)
    if kind == "lasso":
        assert (w[2:] == 0).all()


def test_lasso_matches_the_mllib_solver(table):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    ready = VectorAssembler(inputCols=NAMES, outputCol="features").transform(table)
    lr = LinearRegression(labelCol="y", standardization=False, solver="l-bfgs", regParam=0.1, elasticNetParam=1.0, tol=1e-12, maxIter=500)
    ours = fit_linear(total(collect_moments(table, NAMES, "y")), "lasso", 0.1)
    assert np.allclose(lr.fit(ready).coefficients.toArray(), ours.coefficients, atol=1e-5)


def test_linear_search_equals_refitting_per_fold(table, data):
    x, y = data
    df = with_fold(table, ["id"], 3)
    folds = np.array([r["fold"] for r in df.orderBy("id").collect()])
    trials = [
        Trial(0, "linear", {"reg_type": "ridge", "alpha": 5.0}),
        Trial(1, "linear", {"reg_type": "elasticnet", "alpha": 0.5, "l1_ratio": 0.5}),
    ]
    got = {r["trial"]: r["cv_rmse"] for r in score_trials(trial_table(table.sparkSession, trials), fold_scores(df, NAMES, "y", trials)).collect()}
    mses = []
    for f in range(3):
        tr, te = folds != f, folds == f
        xc, yc = x[tr] - x[tr].mean(0), y[tr] - y[tr].mean()
        w = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(4), xc.T @ yc)
        p = (x[te] - x[tr].mean(0)) @ w + y[tr].mean()
        mses.append(((y[te] - p) ** 2).mean())
    assert got[0] == pytest.approx(np.sqrt(np.mean(mses)), rel=1e-9)
    assert got[1] > got[0]


def test_draws_are_seeded_and_within_their_space():
    a = draw_trials(60, seed=1)
    assert a == draw_trials(60, seed=1) != draw_trials(60, seed=2)
    assert {t.family for t in a} == {"linear", *SPACES}
    for t in a:
        if t.family == "linear":
            assert 1e-4 <= t.params["alpha"] <= 10
            assert ("l1_ratio" in t.params) == (t.params["reg_type"] == "elasticnet")
        else:
            assert set(t.params) == set(SPACES[t.family])


def test_search_with_trees_refit_and_storage(spark, table, tmp_path):
    df = with_fold(table, ["id"], 2)
    trials = [
        Trial(0, "linear", {"reg_type": "ridge", "alpha": 1.0}),
        Trial(1, "random_forest", FOREST),
        Trial(2, "xgboost", {**BOOSTED, "gamma": 0.0}),
    ]
    scored = score_trials(trial_table(spark, trials), fold_scores(df, NAMES, "y", trials))
    best = best_trial(scored).first()
    assert scored.count() == 3 and best["family"] == "linear"
    for t in trials[:2]:
        full = fit_winner(df, NAMES, "y", t, best["cv_rmse"], 3)
        small = refit(full, df, ["f1", "f0"], "y")
        assert small.features == ("f1", "f0") and full.features == tuple(NAMES) and small.searched_features == 4
        path = str(tmp_path / t.family)
        small.save(spark, path)
        loaded = load_model(spark, path)
        a = small.transform(df).agg(F.sum("prediction")).first()[0]
        assert loaded.transform(df).agg(F.sum("prediction")).first()[0] == pytest.approx(a)
        assert loaded.features == small.features and loaded.train_rows == 300


def test_loading_a_missing_model_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_model(spark, str(tmp_path / "none"))


def test_importances(spark, table):
    rows = importances(fit_trees(table, NAMES, "y", "random_forest", FOREST), spark).collect()
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    linear = importances(LinearModel(("a", "b", "c"), (1.0, -3.0, 3.0), 0.0), spark)
    assert [r["feature"] for r in top_k(linear, 2).collect()] == ["b", "c"]
    with pytest.raises(AttributeError):
        importances(object(), spark)


@pytest.mark.parametrize("family,params", [("linear", {"reg_type": "ridge", "alpha": 0.1}), ("random_forest", FOREST)])
def test_sweep(table, family, params):
    df = with_split(table, ["id"])
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    fitted = fit_winner(train, NAMES, "y", Trial(0, family, params), 0.0, 1)
    rows = reduction_sweep(fitted, train, test, "y", [28, 2, 1], ["f1", "f0", "f2", "f3"]).collect()
    assert [r["n_features"] for r in rows] == [28, 2, 1]
    again = metrics(refit(fitted, train, ["f1", "f0"], "y").transform(test), "y", "prediction").first()
    assert rows[1]["rmse"] == pytest.approx(again["rmse"], rel=1e-6)
    assert rows[2]["rmse"] > rows[1]["rmse"]


def test_best_so_far_and_gate(spark):
    trials = spark.createDataFrame([(0, None), (1, 2.0), (2, 3.0), (3, None), (4, 1.0)], "trial int, cv_rmse double")
    assert [r["best"] for r in best_so_far(trials).orderBy("trial").collect()] == [float("inf"), 2.0, 2.0, 2.0, 1.0]
    first = promote(None, spark.createDataFrame([("m", 0, 1.0), ("m", 1, 0.5)], "name string, seq int, cv_rmse double"))
    assert [(r["version"], r["stage"]) for r in first.orderBy("version").collect()] == [(1, "None"), (2, "Staging")]
    more = promote(first, spark.createDataFrame([("m", 0, 0.1), ("n", 0, 0.1)], "name string, seq int, cv_rmse double"))
    assert {(r["name"], r["version"]) for r in more.collect()} == {("m", 3), ("n", 1)}


def test_metrics_leave_gaps_out(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (100.0, None), (None, 4.0)], "y double, p double")
    m = metrics(df, "y", "p").first()
    assert m["r2"] == pytest.approx(0.96) and (m["n_samples"], m["n_left_out"]) == (2, 2)


def test_a_failing_trial_ends_alone(table):
    df = with_fold(table, ["id"], 2)
    trials = [Trial(0, "random_forest", FOREST), Trial(1, "random_forest", {**FOREST, "max_depth": 99})]
    scored = score_trials(trial_table(table.sparkSession, trials), fold_scores(df, NAMES, "y", trials))
    got = {r["trial"]: r["cv_rmse"] for r in scored.collect()}
    assert got[0] > 0 and got[1] is None


def test_families_fit_on_the_same_rows(spark, table):
    gappy = table.withColumn("f2", F.when(F.col("id") % 3 != 0, F.col("f2")))
    sizes = {
        family: fit_winner(gappy, NAMES, "y", Trial(0, family, params), 0.0, 1).train_rows
        for family, params in (("linear", {"reg_type": "ridge", "alpha": 0.1}), ("random_forest", FOREST))
    }
    assert sizes == {"linear": 200, "random_forest": 200}


def test_learning_curve(table):
    curve = learning_curve(fit_trees(table, NAMES, "y", "xgboost", BOOSTED), table, "y").orderBy("round").collect()
    assert [r["round"] for r in curve] == [1, 2, 3, 4, 5] and curve[-1]["rmse"] < curve[0]["rmse"]


def test_moments_at_a_high_level(spark):
    """A column whose first rows are missing and whose level dwarfs its spread."""
    df = spark.range(0, 30_000, 1, 3).select(F.when(F.col("id") >= 1000, F.rand(1)).alias("u"), F.rand(2).alias("b"), F.lit(3.5).alias("k"))
    df = df.withColumn("a", F.col("u") + 1e9).withColumn("b", F.col("b") + F.coalesce("u", F.lit(0.5))).cache()
    level = df.select((F.col("a") - 1e9).alias("u"), "b")
    want, mean, sd = level.agg(F.corr("u", "b"), F.avg("u"), F.stddev_pop("u")).first()
    got = {(r["feature_i"], r["feature_j"]): r["r"] for r in correlation_pairs(df, ["a", "b", "k"]).collect()}
    assert got["a", "b"] == pytest.approx(want, abs=1e-9) and got["a", "k"] is None
    scaler = scaler_of(collect_cells(df, ["a", "b", "k"]), ["a", "b", "k"])
    assert scaler.mean[0] - 1e9 == pytest.approx(mean, abs=1e-6) and scaler.sd[0] == pytest.approx(sd, rel=1e-9)
    assert (scaler.mean[2], scaler.sd[2]) == (3.5, 1.0)


def test_pairwise_gaps_do_not_lose_digits(spark):
    rows = [(1e9 + i // 50 % 7, float(i // 50 % 5 + i // 50 % 7)) if i % 50 == 0 else (float(i % 3), None) for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(2)
    both = df.where("b IS NOT NULL").select((F.col("a") - 1e9).alias("a"), "b")
    assert correlation_pairs(df, ["a", "b"]).first()["r"] == pytest.approx(both.agg(F.corr("a", "b")).first()[0], abs=1e-9)


def test_metrics_of_constant_targets(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 0.5)], "y double, good double, bad double")
    assert metrics(df, "y", "good").first()["r2"] == 1.0
    assert metrics(df, "y", "bad").first()["r2"] == 0.0


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=500), [5.0]])
    df = spark.createDataFrame([(float(x),) for x in v], "r double")
    n, edges = np.histogram(v, 50)
    rows = histogram(df, "r", 50).collect()
    assert [r["n"] for r in rows] == n.tolist()
    assert np.allclose([r["lower"] for r in rows], edges[:-1])
    one = histogram(spark.createDataFrame([(2.0,)], "r double"), "r", 4).collect()
    assert sum(r["n"] for r in one) == 1 and one[0]["lower"] == 1.5


@pytest.mark.parametrize("kind", ["linear", "forest"])
def test_shapley_values_add_up(spark, table, kind):
    if kind == "linear":
        score = LinearModel(tuple(NAMES), (1.0, -2.0, 0.5, 3.0), 7.0).transform
    else:
        score = fit_trees(table, NAMES, "y", "random_forest", FOREST).transform
    background = background_sample(table, ["id"], 6)
    phi = sampled_shapley(table, ["id"], NAMES, score, background)
    sums = {r["id"]: r["s"] for r in phi.groupBy("id").agg(F.sum("phi").alias("s")).collect()}
    base = score(background).agg(F.avg("prediction")).first()[0]
    for r in score(table).collect():
        assert sums[r["id"]] == pytest.approx(r["prediction"] - base, abs=1e-6)


def test_mutual_information_ranks_the_informative_feature_first(table):
    for method in ("quantile", "width"):
        rows = mutual_information(table, NAMES, "y", 8, method).collect()
        assert rows[0]["feature"] == "f1" and all(r["mutual_information"] >= 0 for r in rows)


GRAINS, SHADES, TARGET = "grain_count", "shade", "yield_value"
WIDTH, ROWS = 6, 150


def run_config(tmp_path, **more):
    """A run whose signal is known: the target grows with `signal_0`, the bins and categories are noise."""
    return {
        "experiment": {"random_seed": 7},
        "data": {
            "raw_train_path": str(tmp_path / "in.csv"), "processed_path": str(tmp_path / "ready"),
            "required_columns": [TARGET, GRAINS], "min_columns": 2 * WIDTH,
        },
        "feature_engineering": {
            "target_column": TARGET, "engineered_target_column": "yield_power",
            "element_bins": {"column": GRAINS, "low_threshold": 2, "low_value": 3, "high_threshold": 11, "high_value": 10},
            "valence_bins": {"column": SHADES, "merge_zero_to": 2, "high_threshold": 3, "high_value": 3},
            "protected_columns": [], "correlation_threshold": 0.9, "drop_low_mi_columns": [],
        },
        "preprocessing": {"columns_to_skip_scaling": [], "test_size": 0.3},
        "modeling": {"n_trials": 3, "cv_folds": 3, "search_space": ["linear"]},
        "evaluation": {"feature_counts": [2, 1], "final_top_k_features": 1},
        "artifacts": {"model_dir": str(tmp_path / "kept"), "model_filename": "all.bin", "top_k_model_filename": "few.bin"},
        "storage": {"backend": "local"},
        "mlflow": {"registered_model_name": "yields", "staging_rmse_threshold": 5.0},
        **more,
    }


def write_signal_csv(path):
    """Six informative-or-not columns, a copy of each with a little noise, and a target that is an exact law of one of them."""
    rng = np.random.default_rng(21)
    signal = rng.gamma(4.0, 2.0, (ROWS, WIDTH))
    lines = [",".join([TARGET, GRAINS, SHADES, *(f"signal_{i}" for i in range(WIDTH)), *(f"echo_{i}" for i in range(WIDTH))])]
    for row, grains, shade in zip(signal, rng.integers(1, 15, ROWS), rng.integers(0, 5, ROWS)):
        echo = row + rng.normal(0, 1e-3, WIDTH)
        lines.append(",".join(map(str, [(3 + row[0]) ** 2, grains, shade, *row, *echo])))
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def test_training_run_finds_the_signal(spark, tmp_path):
    from tabloom.plans.features import FeaturePlan
    from tabloom.plans.training import run_training
    from tabloom.sources.tables import read_csv

    cfg = run_config(tmp_path)
    write_signal_csv(cfg["data"]["raw_train_path"])
    out = run_training(spark, cfg)
    assert out["top_features"] == ["signal_0"] and out["test_r2"] > 0.8
    kept = cfg["artifacts"]["model_dir"]
    ready = spark.read.parquet(cfg["data"]["processed_path"])
    assert ready.where("split = 'test'").count() == math.ceil(0.3 * ROWS) and ready.count() == ROWS
    assert not any(c.startswith("echo") for c in ready.columns)  # copies correlate with their signal
    sweep = {r["n_features"]: r["rmse"] for r in spark.read.json(f"{kept}/sweep").collect()}
    assert set(sweep) == {2, 1} and sweep[1] == pytest.approx(out["test_rmse"], rel=1e-6)
    manifest = spark.read.json(f"{kept}/data_manifest").first()
    assert (manifest["row_count"], manifest["column_count"]) == (ROWS, 2 * WIDTH + 3) and manifest["fingerprint"].isdigit()
    assert list(load_model(spark, f"{kept}/few").features) == ["signal_0"]

    plan = FeaturePlan.from_json(spark.read.json(f"{kept}/feature_plan").first()["plan"])
    raw = read_csv(spark, cfg["data"]["raw_train_path"])
    assert plan.transform(raw).columns == [*plan.features, "yield_power"]
    assert plan.transform(raw.drop(TARGET)).columns == list(plan.features)

    run_training(spark, cfg, n_trials=1, fit_on="all")
    registry = spark.read.parquet(f"{kept}/registry")
    assert sorted(r["version"] for r in registry.collect()) == [1, 2]
    assert all((r["stage"] == "Staging") == (r["cv_rmse"] < 5.0) for r in registry.collect())


def test_missing_csv(spark, tmp_path):
    from tabloom.sources.tables import read_csv, read_optional_csv

    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "none.csv"))
    assert read_optional_csv(spark, None) is None


def test_locations():
    from tabloom.sources.tables import uri

    s3 = {"storage": {"backend": "s3", "s3_bucket": "b", "s3_prefix": "p/q/"}}
    assert uri(s3, "/data/x.csv") == "s3a://b/p/q/data/x.csv"
    assert uri({"storage": {"backend": "s3", "s3_bucket": "b"}}, "x") == "s3a://b/x"
    assert uri({}, "data/x.csv") == "data/x.csv"
