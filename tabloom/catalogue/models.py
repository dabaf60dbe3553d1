"""Queries on model fits, search, evaluation and explanation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.catalogue.data import (
    FEATURES,
    LINE_SQL,
    LINES,
    NET,
    ORDER_FEATURES,
    ORDER_SQL,
    ORDER_TARGET,
    TARGET,
    lines,
    orders,
    rounded,
    table,
)
from tabloom.operators.correlation import correlation_pairs
from tabloom.operators.linear import LinearModel, collect_moments, fit_linear, linear_shap, total
from tabloom.operators.metrics import axis_limits, histogram, metrics, residual_summary, with_residual
from tabloom.operators.shapley import sampled_shapley, shap_summary
from tabloom.operators.split import background_sample, with_fold, with_split
from tabloom.operators.tree_shap import expected_value, tree_shap
from tabloom.operators.trees import fit_trees, importances, learning_curve, top_k
from tabloom.plans.evaluation import evaluate, reduction_sweep, run_report
from tabloom.plans.search import (
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
from tabloom.session import materialise, shared_dir, small_table

PAIR = ["l_quantity", "p_retailprice"]
ALPHA = 5000.0
FORMULA = LinearModel(("l_quantity", "p_size", "gross"), (120.37, 35.91, 0.4567), 38000.0)
FORMULA_SQL = "(38000.0 + l_quantity * 120.37 + p_size * 35.91 + gross * 0.4567)"
ORDER_MODEL = LinearModel(tuple(ORDER_FEATURES), (1500.0, -80.0, 310.0, 9000.0), 150000.0)
DRAWS = 100
RIDGE_ALPHAS = [1.0, 1000.0, 100000.0, 10000000.0]
SMALL_FOREST = {"n_estimators": 8, "max_depth": 5, "max_features": "sqrt", "min_samples_leaf": 2}
FOREST = {"n_estimators": 100, "max_depth": 5, "max_features": "sqrt", "min_samples_leaf": 2}
BOOSTED = {"n_estimators": 8, "learning_rate": 0.2, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}


def _coefficients(spark, model):
    rows = [*zip(model.features, model.coefficients), ("(intercept)", float(model.intercept))]
    return rounded(small_table(spark, rows, "term string, coefficient double"))


def _ridge(spark, sf):
    m = total(collect_moments(lines(spark, sf), PAIR, TARGET))
    return _coefficients(spark, fit_linear(m, "ridge", ALPHA))


def _elastic(spark, sf):
    m = total(collect_moments(lines(spark, sf), ["l_quantity"], "gross"))
    return _coefficients(spark, fit_linear(m, "elasticnet", 3.0, 0.4))


def _unexplained(df, model, features, target, alpha=0.0):
    """What the normal equations of a fit leave over per feature, against the spread of both sides; 0 for an exact fit."""
    n = F.count("*")
    spread = F.greatest(F.lit(1e-300), F.stddev_pop("y"))
    scored = model.transform(df).withColumn("y", F.col(target)).withColumn("e", F.col("y") - F.col("prediction"))
    rows = [
        F.struct(F.lit(f).alias("term"), ((F.covar_pop(f, "e") - alpha * w / n) / (F.stddev_pop(f) * spread)).alias("left_over"))
        for f, w in zip(features, model.coefficients)
    ]
    mean = F.struct(F.lit("(intercept)").alias("term"), (F.avg("e") / spread).alias("left_over"))
    return scored.agg(F.array(*rows, mean).alias("r")).select(F.inline("r")).select("term", (F.round("left_over", 6) + 0.0).alias("left_over"))


def _ols(spark, sf):
    df, x = lines(spark, sf), FEATURES[:-1]
    return _unexplained(df, fit_linear(total(collect_moments(df, x, "gross")), "ridge", 0.0), x, "gross")


def _ridge_all(spark, sf):
    df = lines(spark, sf)
    return _unexplained(df, fit_linear(total(collect_moments(df, FEATURES, TARGET)), "ridge", ALPHA), FEATURES, TARGET, ALPHA)


def _far_level(spark, sf):
    """Correlations of columns at a high level whose first rows are missing."""
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") > 400, F.col("l_discount") + 1e9).alias("far"), "l_discount", "l_tax", "l_quantity")
    return rounded(correlation_pairs(df, ["far", "l_discount", "l_tax", "l_quantity"]).select("feature_i", "feature_j", "r"), 5)


def _ols_pair(spark, sf):
    return _coefficients(spark, fit_linear(collect_moments(lines(spark, sf), PAIR, TARGET)[0], "ridge", 0.0))


def _folded(spark, sf):
    return with_fold(lines(spark, sf), LINES)


def _ridge_trials():
    return [Trial(i, "linear", {"reg_type": "ridge", "alpha": a}) for i, a in enumerate(RIDGE_ALPHAS)]


def _linear_search(spark, sf):
    trials = _ridge_trials()
    scores = fold_scores(_folded(spark, sf), PAIR, TARGET, trials)
    return rounded(score_trials(trial_table(spark, trials), scores).select("trial", "family", "cv_rmse"))


MIXED = [
    Trial(0, "linear", {"reg_type": "lasso", "alpha": 10.0}),
    Trial(1, "random_forest", SMALL_FOREST),
    Trial(2, "lightgbm", BOOSTED),
    Trial(3, "xgboost", {**BOOSTED, "gamma": 0.1}),
]


def _kept_orders(spark, sf):
    """The orders with their sums, joined once for the many scans of a fit."""
    return materialise(orders(spark, sf), "orders")


def _spread_of(df, target):
    return df.agg(F.stddev_pop(target)).first()[0]


def _beats_mean(error, df, target=NET):
    """Whether an error is below half that of the mean, on a target that the features explain."""
    return (F.col(error) < 0.5 * _spread_of(df, target)).alias("beats_mean")


def _mixed_search(spark, sf):
    """Every family's cross-validated error against that of the mean."""
    df = with_fold(_kept_orders(spark, sf), ["o_orderkey"], 3)
    scored = score_trials(trial_table(spark, MIXED), fold_scores(df, ORDER_FEATURES, NET, MIXED))
    return scored.select("trial", "family", _beats_mean("cv_rmse", df))


def _trial_rows(spark, sf):
    """A trial per part size; some have failed."""
    per_size = lines(spark, sf).groupBy(F.col("p_size").cast("int").alias("trial"))
    value = F.stddev_pop("l_extendedprice") / 10000
    return per_size.agg(value.alias("v")).select(
        "trial", F.when(F.col("trial") % 7 != 1, F.col("v")).alias("cv_rmse"))


def _best_so_far(spark, sf):
    return rounded(best_so_far(_trial_rows(spark, sf)))


def _candidates(spark, sf):
    """A candidate per return flag and line number, from the whole table."""
    g = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("name"), F.col("l_linenumber").alias("seq"))
    return g.agg((F.avg("l_tax") * 25).alias("cv_rmse"))


def _promotion(spark, sf):
    old = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").groupBy(F.col("l_returnflag").alias("name")).agg(
        F.max("l_linenumber").alias("version"))
    return rounded(promote(old, _candidates(spark, sf), 1.0))


def _predicted(spark, sf):
    return FORMULA.transform(with_split(lines(spark, sf), LINES))


def _run_report(spark, sf):
    df = _predicted(spark, sf).where("split = 'test'").withColumn("mean_only", F.lit(52500.0))
    return rounded(run_report(metrics(df, TARGET, "prediction"), metrics(df, TARGET, "mean_only")))


def _importances_linear(spark, sf):
    model = fit_linear(total(collect_moments(lines(spark, sf), PAIR, TARGET)), "ridge", ALPHA)
    return rounded(top_k(importances(model, spark), 1).select("feature", "importance"))


def _sweep_linear(spark, sf):
    df = with_split(lines(spark, sf), LINES)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    fitted = fit_winner(train, PAIR, TARGET, Trial(0, "linear", {"reg_type": "ridge", "alpha": ALPHA}), 0.0, 1)
    return rounded(reduction_sweep(fitted, train, test, TARGET, [5, 2, 1], PAIR))


def _order_sides(spark, sf):
    df = with_split(_kept_orders(spark, sf), ["o_orderkey"])
    return df.where("split = 'train'"), df.where("split = 'test'")


def _forest(spark, sf):
    model = fit_trees(orders(spark, sf), ORDER_FEATURES, NET, "random_forest", FOREST)
    shares = importances(model, spark)
    return shares.agg(F.count("*").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"), F.count_if(F.col("importance") >= 0).alias("n_shares"),
                      F.max_by("feature", "importance").alias("top"))


def _boosted(spark, sf):
    train, test = _order_sides(spark, sf)
    fitted = fit_winner(train, ORDER_FEATURES, NET, Trial(0, "lightgbm", BOOSTED), 0.0, 1)
    top = [r["feature"] for r in top_k(importances(fitted.model, spark), 2).collect()]
    both = evaluate(fitted, test, NET, "full").unionByName(evaluate(refit(fitted, train, top, NET), test, NET, "top_k"))
    return both.select("label", "n_samples", "n_left_out", _beats_mean("rmse", test))


def _curve(spark, sf):
    """Training error after each boosting round: each round takes a tenth off what the mean leaves, at least."""
    train, _ = _order_sides(spark, sf)
    curve = learning_curve(fit_trees(train, ORDER_FEATURES, NET, "lightgbm", {**BOOSTED, "subsample": 1.0, "colsample_bytree": 1.0}), train, NET)
    limit = F.lit(_spread_of(train, NET)) * F.pow(F.lit(0.9), F.col("round"))
    before = F.coalesce(F.lag("rmse").over(Window.orderBy("round")), F.lit(_spread_of(train, NET)))  # a row per round
    return curve.select("round", ((F.col("rmse") < before) & (F.col("rmse") < limit)).alias("falls"))


def _sweep_forest(spark, sf):
    train, test = _order_sides(spark, sf)
    fitted = fit_winner(train, ORDER_FEATURES, NET, Trial(0, "random_forest", SMALL_FOREST), 0.0, 1)
    rows = reduction_sweep(fitted, train, test, NET, [4, 3, 2])
    return rows.select("n_features", _beats_mean("rmse", test))


REPLAYED = ["l_quantity", "p_size", "l_discount", "tax"]
REPLAY = {"n_estimators": 3, "learning_rate": 0.5, "num_leaves": 3, "max_depth": 4, "min_child_samples": 20}


def _replayed_trees(spark, sf):
    """All nodes of three boosted trees of three leaves each; a column has gaps."""
    df = lines(spark, sf).withColumn("tax", F.when(F.col("l_tax") != 0.05, F.col("l_tax")))
    model = fit_trees(df, REPLAYED, "gross", "lightgbm", REPLAY)
    scale = df.agg(F.var_pop("gross") * F.count("*")).first()[0]
    names = F.array(*[F.lit(f) for f in REPLAYED])
    inner = F.col("feature") >= 0
    return model.nodes(spark).select(
        "tree", "node", F.when(inner, F.get(names, F.greatest("feature", F.lit(0)))).alias("feature"), F.when(inner, F.col("threshold")).alias("threshold"),
        F.when(inner, F.col("missing_left")).alias("missing_left"), F.when(inner, F.round(2 * F.col("gain") / scale, 8)).alias("gain_share"),
        F.col("cover").cast("long").alias("n"), F.round("value", 4).alias("value"))


def _tree_shap(spark, sf):
    """Exact Shapley values of a forest of 100 trees: they add up to prediction minus mean for every test row."""
    df = _kept_orders(spark, sf)
    model = fit_trees(df, ORDER_FEATURES, NET, "random_forest", FOREST)
    test = with_split(df, ["o_orderkey"]).where("split = 'test'")
    phi = tree_shap(model.transform(test), ["o_orderkey", "prediction"], model)
    sums = phi.groupBy("o_orderkey", "prediction").agg(F.sum("phi").alias("s"), F.count("*").alias("k"), F.max_by("feature", F.abs("phi")).alias("top"))
    off = F.abs(F.col("s") + expected_value(model) - F.col("prediction")) > 1e-6 * F.greatest(F.lit(1.0), F.abs("prediction"))
    return sums.agg(F.count("*").alias("n"), F.sum("k").alias("n_values"), F.count_if(off).alias("n_off"), F.mode("top").alias("top"))


def _reloaded(spark, sf):
    """A model saved and read back predicts the same."""
    train, test = _order_sides(spark, sf)
    fitted = fit_winner(train, ORDER_FEATURES, ORDER_TARGET, Trial(0, "linear", {"reg_type": "ridge", "alpha": 1.0}), 0.5, 1)
    path = shared_dir(spark, "model")
    fitted.save(spark, path)
    again = load_model(spark, path).transform(fitted.transform(test).withColumnRenamed("prediction", "first"))
    return again.agg(F.count("*").alias("n"), F.count_if(~F.col("first").eqNullSafe(F.col("prediction"))).alias("n_differ"))


def _record(spark, sf):
    df = orders(spark, sf)
    fitted = fit_winner(
        df, ORDER_FEATURES, ORDER_TARGET, Trial(0, "linear", {"reg_type": "ridge", "alpha": 1.0}), 1.2345678, 3
    )
    r = fitted.record(spark)
    return r.select("model_type", F.to_json("best_params").alias("best_params"), "cv_rmse", "n_trials", "n_features",
                    F.array_join("feature_names", ",").alias("feature_names"), "train_rows")


def _linear_phi(spark, sf):
    df = lines(spark, sf)
    means = df.agg(*[F.avg(f).alias(f) for f in FORMULA.features]).first().asDict()
    return linear_shap(df, FORMULA, means, LINES)


def _sampled(spark, sf, score):
    """Shapley values of the test rows against a background of the reference's size."""
    df = orders(spark, sf)
    explained = with_split(df, ["o_orderkey"]).where("split = 'test'").drop("split")
    return sampled_shapley(explained, ["o_orderkey"], ORDER_FEATURES, score, background_sample(df, ["o_orderkey"], DRAWS))


def _shapley_forest(spark, sf):
    """Per order the values add up to its prediction minus the background's mean."""
    df = orders(spark, sf)
    model = fit_trees(df, ORDER_FEATURES, ORDER_TARGET, "random_forest", SMALL_FOREST)
    base = model.transform(background_sample(df, ["o_orderkey"], DRAWS)).agg(F.avg("prediction")).first()[0]
    sums = _sampled(spark, sf, model.transform).groupBy("o_orderkey").agg(F.sum("phi").alias("s"), F.count("*").alias("k"))
    off = F.abs(F.col("s") - (F.col("prediction") - base)) > 1e-6 * F.greatest(F.lit(1.0), F.abs("prediction"))
    rows = model.transform(df).select("o_orderkey", "prediction").join(sums, "o_orderkey")
    return rows.agg(F.count("*").alias("n"), F.sum("k").alias("n_values"), F.count_if(off).alias("n_off"))


def _gappy_metrics(spark, sf):
    """Metrics where the model gave no prediction for some rows."""
    df = _predicted(spark, sf).withColumn("prediction", F.when(F.col("l_linenumber") != 3, F.col("prediction")))
    return rounded(metrics(df, TARGET, "prediction", ["split"]))


def _drawn(spark, sf):
    """Trials as the search draws them: within their ranges, repeatable, and the best of the linear ones beats the mean."""
    trials = draw_trials(12, ("linear",), seed=5)
    df = _folded(spark, sf)
    scored = score_trials(trial_table(spark, trials), fold_scores(df, FEATURES[:-1], "gross", trials))
    alpha = F.element_at("params", "alpha").cast("double")
    sound = alpha.between(1e-4, 10.0) & F.element_at("params", "reg_type").isin("ridge", "lasso", "elasticnet")
    same = F.lit(trials == draw_trials(12, ("linear",), seed=5))
    return scored.agg(
        F.count("*").alias("n_trials"), F.count_if(sound).alias("n_sound"), F.count("cv_rmse").alias("n_scored"),
        (F.min("cv_rmse") < 0.5 * _spread_of(df, "gross")).alias("beats_mean"), F.bool_and(same).alias("repeatable"))


QUERIES = {
    "drawn_trials": _drawn,
    "ridge_fit": _ridge,
    "elasticnet_fit": _elastic,
    "ols_fit": _ols,
    "ols_pair_fit": _ols_pair,
    "ridge_fit_all": _ridge_all,
    "corr_far_level": _far_level,
    "metrics_with_gaps": _gappy_metrics,
    "learning_curve": _curve,
    "model_reload": _reloaded,
    "linear_search": _linear_search,
    "mixed_search": _mixed_search,
    "best_trial": lambda s, sf: rounded(best_trial(_trial_rows(s, sf))),
    "best_so_far": _best_so_far,
    "promotion_gate": _promotion,
    "model_record": _record,
    "metrics_by_split": lambda s, sf: rounded(metrics(_predicted(s, sf), TARGET, "prediction", ["split"])),
    "residual_summary": lambda s, sf: rounded(residual_summary(_predicted(s, sf), TARGET, "prediction")),
    "residual_histogram": lambda s, sf: rounded(
        histogram(with_residual(_predicted(s, sf), TARGET, "prediction"), "residual"), 4),
    "axis_limits": lambda s, sf: rounded(axis_limits(_predicted(s, sf), TARGET, "prediction")),
    "run_report": _run_report,
    "importances_linear": _importances_linear,
    "reduction_sweep_linear": _sweep_linear,
    "forest_importances": _forest,
    "boosted_metrics": _boosted,
    "reduction_sweep_forest": _sweep_forest,
    "linear_shap": lambda s, sf: rounded(_linear_phi(s, sf), 4),
    "shap_summary": lambda s, sf: rounded(shap_summary(_linear_phi(s, sf)), 4),
    "sampled_shapley": lambda s, sf: rounded(_sampled(s, sf, ORDER_MODEL.transform)),
    "shapley_forest": _shapley_forest,
    "boosted_trees": _replayed_trees,
    "tree_shap": _tree_shap,
}

_HASH = "md5(concat_ws(':', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"
_SPLIT = f"CASE WHEN substr({_HASH}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END"


def _ridge_sql(rows: str, alpha: str, by: str = "") -> str:
    """Closed form of ridge on two features over the CTE `rows`."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
      SELECT {lead}(d * c - b * e) / (a * c - b * b) AS w1, (a * e - b * d) / (a * c - b * b) AS w2, m1, m2, my
      FROM (SELECT {lead}var_pop(l_quantity) * count(*) + {alpha} AS a,
                   covar_pop(l_quantity, p_retailprice) * count(*) AS b,
                   var_pop(p_retailprice) * count(*) + {alpha} AS c,
                   covar_pop(l_quantity, {TARGET}) * count(*) AS d,
                   covar_pop(p_retailprice, {TARGET}) * count(*) AS e,
                   avg(l_quantity) AS m1, avg(p_retailprice) AS m2, avg({TARGET}) AS my
            FROM {rows} {group})"""


_TEST_ORDER = "substr(md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), 1, 8) < '33333333'"
_PREDICTED_SQL = f"p AS (SELECT *, {TARGET} AS y, {FORMULA_SQL} AS p, {_SPLIT} AS split FROM f)"
_METRICS = "sqrt(avg(pow(y - p, 2)))", "avg(abs(y - p))", "1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*))"
_SHAP_ROWS = " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{f}' AS feature, {f} AS value, ({f} - m_{f}) * {w} AS phi FROM f, m"
    for f, w in zip(FORMULA.features, FORMULA.coefficients)
)
_SHAP_MEANS = "m AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}" for f in FORMULA.features) + " FROM f)"
_TRIALS_SQL = """t AS (SELECT CAST(p_size AS INT) AS trial, CASE WHEN CAST(p_size AS INT) % 7 <> 1
    THEN stddev_pop(l_extendedprice) / 10000 END AS cv_rmse FROM f GROUP BY p_size)"""

def _replay_sql() -> str:
    """Boosting in SQL: per tree the best cut of all rows, then of both sides, of which the better one is split."""
    lr, least, out = REPLAY["learning_rate"], REPLAY["min_child_samples"], []
    steps = [f"{LINE_SQL}, d AS (SELECT l_quantity, p_size, l_discount, nullif(l_tax, 0.05) AS tax, gross AS y FROM f)",
             "p0 AS (SELECT *, (SELECT avg(y) FROM d) AS pred FROM d)"]

    def value(alias: str, f: str) -> str:
        return "CASE " + " ".join(f"WHEN {alias}.{f} = {i} THEN {c}" for i, c in enumerate(REPLAYED)) + " END"

    def cuts(to: str, source: str) -> None:
        """Best cut per side of `source`, with a column side and g."""
        steps.append(f"{to}l AS (" + " UNION ALL ".join(f"SELECT side, {i} AS fi, {c} AS v, g FROM {source}" for i, c in enumerate(REPLAYED)) + ")")
        steps.append(f"""{to}t AS (SELECT side, fi, sum(g) AS tg, count(*) AS tn, coalesce(sum(g) FILTER (WHERE v IS NULL), 0) AS mg,
            count(*) FILTER (WHERE v IS NULL) AS mn FROM {to}l GROUP BY side, fi)""")
        steps.append(f"""{to}c AS (SELECT side, fi, v, sum(sum(g)) OVER w AS cg, sum(count(*)) OVER w AS cn FROM {to}l WHERE v IS NOT NULL
            GROUP BY side, fi, v WINDOW w AS (PARTITION BY side, fi ORDER BY v))""")
        steps.append(f"""{to}s AS (SELECT side, fi, v, gap_left, tg, tn, cg + CASE WHEN gap_left THEN mg ELSE 0 END AS lg,
            cn + CASE WHEN gap_left THEN mn ELSE 0 END AS ln FROM {to}c JOIN {to}t USING (side, fi), (VALUES (false), (true)) o(gap_left)
            WHERE NOT gap_left OR mn > 0)""")
        steps.append(f"""{to} AS (SELECT *, tg - lg AS rg, tn - ln AS rn FROM (SELECT *,
            0.5 * (lg * lg / ln + (tg - lg) * (tg - lg) / (tn - ln) - tg * tg / tn) AS gain FROM {to}s WHERE least(ln, tn - ln) >= {least})
            QUALIFY row_number() OVER (PARTITION BY side ORDER BY gain DESC, fi, gap_left, v) = 1)""")

    for k in range(REPLAY["n_estimators"]):
        steps.append(f"g{k} AS (SELECT *, pred - y AS g, 0 AS side FROM p{k})")
        cuts(f"a{k}", f"g{k}")
        goes = f"coalesce({value('a', 'fi')} <= a.v, a.gap_left)"
        steps.append(f"h{k} AS (SELECT g.* EXCLUDE (side), CASE WHEN {goes} THEN 1 ELSE 2 END AS side FROM g{k} g, a{k} a)")
        cuts(f"b{k}", f"h{k}")
        steps.append(f"m{k} AS (SELECT * FROM b{k} ORDER BY gain DESC LIMIT 1)")
        below = f"coalesce({value('m', 'fi')} <= m.v, m.gap_left)"
        steps.append(f"i{k} AS (SELECT h.*, CASE WHEN h.side <> m.side THEN h.side WHEN {below} THEN 3 ELSE 4 END AS leaf FROM h{k} h, m{k} m)")
        steps.append(f"v{k} AS (SELECT leaf, -{lr} * sum(g) / count(*) AS w FROM i{k} GROUP BY leaf)")
        steps.append(f"p{k + 1} AS (SELECT l_quantity, p_size, l_discount, tax, y, pred + w AS pred FROM i{k} JOIN v{k} USING (leaf))")
        feature = "CASE fi " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(REPLAYED)) + " END"
        share = "round(2 * gain / (SELECT var_pop(y) * count(*) FROM d), 8)"
        split = f"{feature} AS feature, v AS threshold, gap_left AS missing_left, {share} AS gain_share, tn AS n, round(-{lr} * tg / tn, 4) AS value"
        out += [f"SELECT {k} AS tree, 0 AS node, {split} FROM a{k}", f"SELECT {k}, side, {split} FROM m{k}"]
        out.append(f"SELECT {k}, side, NULL, NULL, NULL, NULL, count(*), round(-{lr} * sum(g) / count(*), 4) FROM h{k} WHERE side <> (SELECT side FROM m{k}) GROUP BY side")
        out.append(f"SELECT {k}, leaf, NULL, NULL, NULL, NULL, count(*), round(-{lr} * sum(g) / count(*), 4) FROM i{k} WHERE leaf > 2 GROUP BY leaf")
    rows = " UNION ALL ".join(out)
    return f"WITH {', '.join(steps)} SELECT * REPLACE (CAST(n AS BIGINT) AS n) FROM ({rows})"


ORACLE = {
    "drawn_trials": """SELECT CAST(12 AS BIGINT) AS n_trials, CAST(12 AS BIGINT) AS n_sound, CAST(12 AS BIGINT) AS n_scored, true AS beats_mean,
        true AS repeatable FROM lineitem HAVING count(*) > 0""",
    "boosted_trees": _replay_sql(),
    "tree_shap": f"""WITH {ORDER_SQL} SELECT count(*) AS n, CAST(4 * count(*) AS BIGINT) AS n_values, CAST(0 AS BIGINT) AS n_off, 'sum_price' AS top
        FROM o WHERE {_TEST_ORDER}""",
    "ridge_fit": f"""WITH {LINE_SQL}, r AS ({_ridge_sql('f', str(ALPHA))})
        SELECT 'l_quantity' AS term, round(w1, 6) AS coefficient FROM r
        UNION ALL SELECT 'p_retailprice', round(w2, 6) FROM r
        UNION ALL SELECT '(intercept)', round(my - w1 * m1 - w2 * m2, 6) FROM r""",
    "ols_pair_fit": f"""WITH {LINE_SQL}, r AS ({_ridge_sql('f', '0')})
        SELECT 'l_quantity' AS term, round(w1, 6) AS coefficient FROM r
        UNION ALL SELECT 'p_retailprice', round(w2, 6) FROM r
        UNION ALL SELECT '(intercept)', round(my - w1 * m1 - w2 * m2, 6) FROM r""",
    "elasticnet_fit": f"""WITH {LINE_SQL}, c AS (SELECT covar_pop(l_quantity, gross) AS xy, var_pop(l_quantity) AS xx,
          avg(l_quantity) AS mx, avg(gross) AS my FROM f),
        w AS (SELECT *, sign(xy) * greatest(abs(xy) - 3.0 * 0.4, 0) / (xx + 3.0 * 0.6) AS w FROM c)
        SELECT 'l_quantity' AS term, round(w, 6) AS coefficient FROM w
        UNION ALL SELECT '(intercept)', round(my - w * mx, 6) FROM w""",
    "linear_search": f"""WITH {LINE_SQL},
        k AS (SELECT *, CAST('0x' || substr({_HASH}, 1, 15) AS BIGINT) % 5 AS fold FROM f),
        a(trial, alpha) AS (VALUES {", ".join(f"({i}, {a})" for i, a in enumerate(RIDGE_ALPHAS))}),
        j AS (SELECT h.fold AS held, k.* FROM k JOIN (SELECT unnest(range(5)) AS fold) h ON k.fold <> h.fold),
        c AS (SELECT held, trial, alpha, count(*) AS n, var_pop(l_quantity) * count(*) + alpha AS a,
                     covar_pop(l_quantity, p_retailprice) * count(*) AS b,
                     var_pop(p_retailprice) * count(*) + alpha AS c,
                     covar_pop(l_quantity, {TARGET}) * count(*) AS d, covar_pop(p_retailprice, {TARGET}) * count(*) AS e,
                     avg(l_quantity) AS m1, avg(p_retailprice) AS m2, avg({TARGET}) AS my
              FROM j, a GROUP BY held, trial, alpha),
        w AS (SELECT *, (d * c - b * e) / (a * c - b * b) AS w1, (a * e - b * d) / (a * c - b * b) AS w2 FROM c),
        s AS (SELECT trial, fold, avg(pow({TARGET} - (my + w1 * (l_quantity - m1) + w2 * (p_retailprice - m2)), 2)) AS mse
              FROM k JOIN w ON k.fold = w.held GROUP BY trial, fold)
        SELECT CAST(trial AS INT) AS trial, 'linear' AS family, round(sqrt(avg(mse)), 6) AS cv_rmse FROM s GROUP BY trial""",
    "best_trial": f"""WITH {LINE_SQL}, {_TRIALS_SQL}
        SELECT trial, round(cv_rmse, 6) AS cv_rmse FROM t WHERE cv_rmse IS NOT NULL ORDER BY t.cv_rmse, trial LIMIT 1""",
    "best_so_far": f"""WITH {LINE_SQL}, {_TRIALS_SQL}
        SELECT trial, round(cv_rmse, 6) AS cv_rmse, round(coalesce(min(cv_rmse) OVER (ORDER BY trial
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), CAST('Infinity' AS DOUBLE)), 6) AS best FROM t""",
    "promotion_gate": """WITH c AS (SELECT l_returnflag AS name, l_linenumber AS seq, avg(l_tax) * 25 AS cv_rmse
          FROM lineitem GROUP BY 1, 2),
        v AS (SELECT l_returnflag AS name, max(l_linenumber) AS latest FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
        SELECT c.name, CAST(row_number() OVER (PARTITION BY c.name ORDER BY seq) + coalesce(latest, 0) AS INT) AS version,
               round(cv_rmse, 6) AS cv_rmse, CASE WHEN cv_rmse < 1.0 THEN 'Staging' ELSE 'None' END AS stage
        FROM c LEFT JOIN v ON c.name = v.name""",
    "model_record": f"""WITH {ORDER_SQL} SELECT 'linear' AS model_type,
        '{{"reg_type":"ridge","alpha":"1.0"}}' AS best_params, CAST(1.234568 AS DOUBLE) AS cv_rmse, 3 AS n_trials, 4 AS n_features,
        'n_lines,sum_qty,sum_price,avg_discount' AS feature_names, count(*) AS train_rows FROM o""",
    "metrics_by_split": f"""WITH {LINE_SQL}, {_PREDICTED_SQL} SELECT split, round({_METRICS[0]}, 6) AS rmse,
        round({_METRICS[1]}, 6) AS mae, round({_METRICS[2]}, 6) AS r2, count(*) AS n_samples,
        CAST(0 AS BIGINT) AS n_left_out FROM p GROUP BY split""",
    "metrics_with_gaps": f"""WITH {LINE_SQL}, {_PREDICTED_SQL}, s AS (SELECT split, round({_METRICS[0]}, 6) AS rmse,
        round({_METRICS[1]}, 6) AS mae, round({_METRICS[2]}, 6) AS r2, count(*) AS n_samples FROM p WHERE l_linenumber <> 3 GROUP BY split)
        SELECT s.*, o.n AS n_left_out FROM s JOIN (SELECT split, count(*) FILTER (WHERE l_linenumber = 3) AS n FROM p GROUP BY split) o
        USING (split)""",
    "ols_fit": f"""SELECT term, CAST(0 AS DOUBLE) AS left_over FROM (SELECT unnest({[*FEATURES[:-1], '(intercept)']}) AS term)
        WHERE EXISTS (SELECT 1 FROM lineitem)""",
    "ridge_fit_all": f"""SELECT term, CAST(0 AS DOUBLE) AS left_over FROM (SELECT unnest({[*FEATURES, '(intercept)']}) AS term)
        WHERE EXISTS (SELECT 1 FROM lineitem)""",
    "corr_far_level": """WITH f AS (SELECT CASE WHEN l_orderkey > 400 THEN l_discount END AS far, l_discount, l_tax, l_quantity FROM lineitem)
        SELECT 'far' AS feature_i, 'l_discount' AS feature_j, round(corr(far, l_discount), 5) AS r FROM f
        UNION ALL SELECT 'far', 'l_tax', round(corr(far, l_tax), 5) FROM f
        UNION ALL SELECT 'far', 'l_quantity', round(corr(far, l_quantity), 5) FROM f
        UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 5) FROM f
        UNION ALL SELECT 'l_discount', 'l_quantity', round(corr(l_discount, l_quantity), 5) FROM f
        UNION ALL SELECT 'l_tax', 'l_quantity', round(corr(l_tax, l_quantity), 5) FROM f""",
    "mixed_search": """SELECT CAST(i AS INT) AS trial, family, count(*) > 0 AS beats_mean FROM orders,
        (VALUES (0, 'linear'), (1, 'random_forest'), (2, 'lightgbm'), (3, 'xgboost')) t(i, family) GROUP BY ALL""",
    "forest_importances": """SELECT CAST(4 AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS total, CAST(4 AS BIGINT) AS n_shares, 'sum_price' AS top
        FROM orders HAVING count(*) > 0""",
    "boosted_metrics": f"""WITH {ORDER_SQL}, t AS (SELECT count(*) AS n FROM o WHERE {_TEST_ORDER})
        SELECT unnest(['full', 'top_k']) AS label, n AS n_samples, CAST(0 AS BIGINT) AS n_left_out, true AS beats_mean FROM t""",
    "learning_curve": f"""SELECT CAST(r AS INT) AS round, true AS falls
        FROM (SELECT unnest(range(1, {BOOSTED["n_estimators"] + 1})) AS r) WHERE EXISTS (SELECT 1 FROM orders)""",
    "reduction_sweep_forest": """SELECT CAST(k AS INT) AS n_features, true AS beats_mean FROM (SELECT unnest([4, 3, 2]) AS k)
        WHERE EXISTS (SELECT 1 FROM orders)""",
    "model_reload": f"""WITH {ORDER_SQL} SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM o WHERE {_TEST_ORDER}""",
    "shapley_forest": f"""WITH {ORDER_SQL} SELECT count(*) AS n, CAST(4 * count(*) AS BIGINT) AS n_values, CAST(0 AS BIGINT) AS n_off
        FROM o WHERE {_TEST_ORDER}""",
    "residual_summary": f"""WITH {LINE_SQL}, {_PREDICTED_SQL}
        SELECT round(avg(y - p), 6) AS mean, round(stddev_pop(y - p), 6) AS std FROM p""",
    "residual_histogram": f"""WITH {LINE_SQL}, {_PREDICTED_SQL}, l AS (SELECT min(y - p) AS lo, max(y - p) AS hi FROM p),
        c AS (SELECT least(CAST(floor((y - p - lo) / ((hi - lo) / 50)) AS INT) + 1, 50) AS bin, count(*) AS n
              FROM p, l GROUP BY 1)
        SELECT CAST(b.bin AS INT) AS bin, round(lo + (b.bin - 1) * ((hi - lo) / 50), 4) AS lower,
               round(lo + b.bin * ((hi - lo) / 50), 4) AS upper, coalesce(n, 0) AS n
        FROM l, (SELECT unnest(range(1, 51)) AS bin) b LEFT JOIN c ON b.bin = c.bin""",
    "axis_limits": f"""WITH {LINE_SQL}, {_PREDICTED_SQL}
        SELECT round(least(min(y), min(p)), 6) AS lower, round(greatest(max(y), max(p)), 6) AS upper FROM p""",
    "run_report": f"""WITH {LINE_SQL}, {_PREDICTED_SQL}, t AS (SELECT y, p FROM p WHERE split = 'test'),
        u AS (SELECT y, CAST(52500.0 AS DOUBLE) AS p FROM t) """ + " UNION ALL ".join(
        f"SELECT '{n}' AS metric, round((SELECT {e} FROM t), 6) AS \"full\", round((SELECT {e} FROM u), 6) AS top_k"
        for n, e in zip(("rmse", "mae", "r2"), _METRICS)
    ),
    "importances_linear": f"""WITH {LINE_SQL}, r AS ({_ridge_sql('f', str(ALPHA))}),
        i AS (SELECT 0 AS p, 'l_quantity' AS feature, abs(w1) AS v FROM r
              UNION ALL SELECT 1, 'p_retailprice', abs(w2) FROM r)
        SELECT feature, round(v, 6) AS importance FROM i ORDER BY v DESC, p LIMIT 1""",
    "reduction_sweep_linear": f"""WITH {LINE_SQL}, s AS (SELECT *, {_SPLIT} AS split FROM f),
        tr AS (SELECT * FROM s WHERE split = 'train'), te AS (SELECT * FROM s WHERE split = 'test'),
        r AS ({_ridge_sql('tr', str(ALPHA))}),
        q AS (SELECT covar_pop(l_quantity, {TARGET}) * count(*) / (var_pop(l_quantity) * count(*) + {ALPHA}) AS w,
                     avg(l_quantity) AS m, avg({TARGET}) AS my FROM tr),
        two AS (SELECT sqrt(avg(pow({TARGET} - (my + w1 * (l_quantity - m1) + w2 * (p_retailprice - m2)), 2))) AS v
                FROM te, r),
        one AS (SELECT sqrt(avg(pow({TARGET} - (my + w * (l_quantity - m)), 2))) AS v FROM te, q)
        SELECT 5 AS n_features, round(v, 6) AS rmse FROM two UNION ALL SELECT 2, round(v, 6) FROM two
        UNION ALL SELECT 1, round(v, 6) FROM one""",
    "linear_shap": f"""WITH {LINE_SQL}, {_SHAP_MEANS}, v AS ({_SHAP_ROWS})
        SELECT l_orderkey, l_linenumber, feature, round(value, 4) AS value, round(phi, 4) AS phi FROM v""",
    "shap_summary": f"""WITH {LINE_SQL}, {_SHAP_MEANS}, v AS ({_SHAP_ROWS})
        SELECT feature, round(avg(abs(phi)), 4) AS mean_abs_phi, round(avg(phi), 4) + 0.0 AS mean_phi FROM v GROUP BY feature""",
    "sampled_shapley": f"""WITH {ORDER_SQL},
        b AS (SELECT * FROM o ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT {DRAWS}),
        m AS (SELECT {", ".join(f"avg({f}) AS m_{f}" for f in ORDER_FEATURES)} FROM b) """ + " UNION ALL ".join(
        f"SELECT o_orderkey, '{f}' AS feature, round({f}, 6) AS value, round(({f} - m_{f}) * {w}, 6) AS phi FROM o, m WHERE {_TEST_ORDER}"
        for f, w in zip(ORDER_FEATURES, ORDER_MODEL.coefficients)
    ),
}
