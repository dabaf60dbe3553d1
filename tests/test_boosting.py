"""Trees on binned columns against a plain grower, and exact Shapley values against all subsets."""

import heapq
import math
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import boosting, tree_shap
from tabloom.operators.boosting import Growth, Spec, binned, fit_models, held_out_errors
from tabloom.operators.trees import fit_trees, importances

NAMES = ["a", "b", "c", "d"]


def values(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), rng.normal(0, 1, n).round(1), rng.integers(0, 3, n)], axis=1).astype(float)
    x[rng.random(n) < 0.2, 1] = np.nan
    y = 3 * x[:, 0] + np.where(np.isnan(x[:, 1]), 9, x[:, 1]) * (x[:, 2] > 0) + rng.normal(0, 0.3, n)
    return x, y


@pytest.fixture(scope="module")
def data(spark):
    x, y = values()
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t), int(i % 3)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, fold int").repartition(4).cache()
    return df, x, y


def plain_cut(x, g, growth):
    """(gain, -column, rows that go left) of the best cut of some rows, by trying every value and side."""
    best = None
    lam = growth.reg_lambda
    for f in range(x.shape[1]):
        gap = np.isnan(x[:, f])
        for gap_left in (False, True) if gap.any() else (False,):
            for v in np.unique(x[~gap, f]):
                left = np.where(gap, gap_left, x[:, f] <= v)
                n = left.sum(), (~left).sum()
                if min(n) < growth.least_leaf:
                    continue
                gain = 0.5 * (g[left].sum() ** 2 / (n[0] + lam) + g[~left].sum() ** 2 / (n[1] + lam) - g.sum() ** 2 / (len(g) + lam)) - growth.gamma
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, left)
    return best


def plain_tree(x, g, growth, rate):
    """Leaf value per row, splits taken one by one in the order of gains."""
    out, leaves, heap = np.zeros(len(g)), 1, []

    def offer(rows, depth):
        cut = plain_cut(x[rows], g[rows], growth) if depth < growth.depth and len(rows) >= growth.least_split else None
        out[rows] = -rate * g[rows].sum() / (len(rows) + growth.reg_lambda)
        if cut:
            heapq.heappush(heap, (-cut[0], len(heap), rows, cut, depth))

    offer(np.arange(len(g)), 0)
    while heap and (not growth.leaves or leaves < growth.leaves):
        _, _, rows, cut, depth = heapq.heappop(heap)
        leaves += 1
        offer(rows[cut[2]], depth + 1)
        offer(rows[~cut[2]], depth + 1)
    return out, leaves


@pytest.mark.parametrize("family,params", [
    ("lightgbm", {"num_leaves": 7, "max_depth": 6, "min_child_samples": 5}), ("lightgbm", {"num_leaves": 31, "max_depth": 4, "min_child_samples": 1}),
    ("xgboost", {"max_depth": 3, "gamma": 0.0}), ("xgboost", {"max_depth": 4, "gamma": 40.0}), ("xgboost", {"max_depth": 2, "reg_lambda": 25.0}),
])
def test_boosting_against_plain(spark, data, family, params):
    df, x, y = data
    params = {"n_estimators": 3, "learning_rate": 0.4, **params}
    growth = boosting.growth_of(family, params)
    model = fit_trees(df, NAMES, "y", family, params)
    want = np.full(len(y), y.mean())
    for t in model.trees:
        add, leaves = plain_tree(x, want - y, growth, 0.4)
        assert sum(f < 0 for f in t.feature) == leaves
        want += add
    assert np.allclose(model.scores(x), want)
    got = {tuple(r[:4]): r["prediction"] for r in model.transform(df).select(*NAMES, "prediction").collect()}
    key = [tuple(None if np.isnan(v) else v for v in r) for r in x]
    assert np.allclose([got[k] for k in key], want)


def test_limits_act(spark, data):
    df, x, y = data
    matrix = binned(df, NAMES, "y", "fold")
    few, many, strict, shallow = fit_models(matrix, [
        Spec("lightgbm", {"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 3, "max_depth": 9}), Spec("lightgbm", {"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 12, "max_depth": 9}),
        Spec("xgboost", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 6, "gamma": 1e9}), Spec("random_forest", {"n_estimators": 3, "max_depth": 9, "min_samples_split": 400}),
    ])
    leaves = lambda m: [sum(f < 0 for f in t.feature) for t in m.trees]
    assert leaves(few) == [3] and leaves(many) == [12] and leaves(strict) == [1] and max(leaves(shallow)) <= 3
    assert strict.scores(x) == pytest.approx(np.full(len(y), y.mean()))
    assert few.nodes(spark).count() == 5


def test_folds_and_refreshed_scores(spark, data, monkeypatch):
    """Models side by side equal models on their own, whether or not scores are brought up to date on the way."""
    df, x, y = data
    matrix = binned(df, NAMES, "y", "fold")
    params = {"n_estimators": 7, "learning_rate": 0.3, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.5}
    specs = [Spec("xgboost", params, f) for f in range(3)]
    side_by_side = fit_models(matrix, specs)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    refreshed = fit_models(matrix, specs)
    alone = fit_models(matrix, specs[1:2])[0]
    assert np.allclose(side_by_side[1].scores(x), alone.scores(x)) and np.allclose(side_by_side[2].scores(x), refreshed[2].scores(x))
    fold = np.arange(len(y)) % 3
    for k, (s, n) in enumerate(held_out_errors(matrix, side_by_side, specs)):
        own = fold == k
        assert n == own.sum() and s == pytest.approx(((side_by_side[k].scores(x)[own] - y[own]) ** 2).sum())


def test_many_open_leaves_take_several_passes(spark, data, monkeypatch):
    df, x, _ = data
    params = {"n_estimators": 2, "learning_rate": 0.5, "num_leaves": 16, "max_depth": 6}
    want = fit_trees(df, NAMES, "y", "lightgbm", params).scores(x)
    monkeypatch.setattr(boosting, "SUM_BYTES", 3 * 4 * 256 * 16)
    assert np.allclose(fit_trees(df, NAMES, "y", "lightgbm", params).scores(x), want)


def test_forest(spark, data):
    df, x, y = data
    model = fit_trees(df, NAMES, "y", "random_forest", {"n_estimators": 30, "max_depth": 8, "max_features": "sqrt", "min_samples_leaf": 2})
    assert ((model.scores(x) - y) ** 2).mean() < 0.1 * y.var() and len(model.trees) == 30
    assert all(c >= 2 for t in model.trees for f, c in zip(t.feature, t.cover) if f < 0)
    shares = {r["feature"]: r["importance"] for r in importances(model, spark).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a"
    with pytest.raises(ValueError, match="max_features"):
        fit_trees(df, NAMES, "y", "random_forest", {"n_estimators": 1, "max_depth": 2, "max_features": "half"})


def test_degenerate_tables(spark):
    none = spark.createDataFrame([], "a double, y double")
    with pytest.raises(ValueError, match="no rows"):
        fit_trees(none, ["a"], "y", "xgboost", {"n_estimators": 1, "learning_rate": 1.0, "max_depth": 2})
    same = spark.createDataFrame([(None, 2.0), (None, 2.0), (float("nan"), 5.0), (1.0, None)], "a double, y double")
    model = fit_trees(same, ["a"], "y", "xgboost", {"n_estimators": 2, "learning_rate": 1.0, "max_depth": 2})
    assert model.transform(same).first()["prediction"] == pytest.approx(3.0) and model.importances().tolist() == [0.0]


def enumerated(tree, row, base=0.0):
    """Shapley values by all subsets of known features."""
    def value(v, known):
        f = tree.feature[v]
        if f < 0:
            return tree.value[v]
        sides = tree.left[v], tree.right[v]
        if f in known:
            goes_left = tree.missing_left[v] if np.isnan(row[f]) else row[f] <= tree.threshold[v]
            return value(sides[0] if goes_left else sides[1], known)
        return sum(tree.cover[u] / tree.cover[v] * value(u, known) for u in sides)

    p = len(row)
    phi = np.zeros(p)
    for j in range(p):
        rest = [k for k in range(p) if k != j]
        for s in range(p):
            for some in combinations(rest, s):
                phi[j] += factorial(s) * factorial(p - s - 1) / factorial(p) * (value(0, {*some, j}) - value(0, set(some)))
    return phi, value(0, set())


@pytest.mark.parametrize("tabled", [8, 0])
def test_tree_shap_against_all_subsets(spark, data, monkeypatch, tabled):
    monkeypatch.setattr(tree_shap, "TABLED", tabled)
    df, x, _ = data
    model = fit_trees(df, NAMES, "y", "xgboost", {"n_estimators": 4, "learning_rate": 0.6, "max_depth": 4})
    paths = tree_shap.leaf_paths(model)
    got = tree_shap.shap_matrix(paths, x[:25])
    for row, phi in zip(x[:25], got):
        parts = [enumerated(t, row) for t in model.trees]
        assert np.allclose(phi, sum(p for p, _ in parts))
        assert tree_shap.expected_value(model) == pytest.approx(model.base + sum(e for _, e in parts))
    assert np.allclose(got.sum(1) + tree_shap.expected_value(model), model.scores(x[:25]))


def test_tree_shap_as_a_table(spark, data):
    df, x, _ = data
    model = fit_trees(df, NAMES, "y", "lightgbm", {"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 8, "max_depth": 5})
    keyed = model.transform(df.withColumn("k", F.monotonically_increasing_id()))
    rows = tree_shap.tree_shap(keyed, ["k", "prediction"], model)
    sums = rows.groupBy("k", "prediction").agg(F.sum("phi").alias("s"), F.count("*").alias("n")).collect()
    assert len(sums) == len(x) and all(r["n"] == 4 and r["s"] + tree_shap.expected_value(model) == pytest.approx(r["prediction"]) for r in sums)
    gaps = rows.where("feature = 'b'").agg(F.count_if(F.col("value").isNull())).first()[0]
    assert gaps == np.isnan(x[:, 1]).sum()
    assert tree_shap.tree_shap(df.limit(0), ["fold"], model).count() == 0


@pytest.mark.parametrize("most", [1, boosting.MOST_CELLS])
def test_cells_hold_what_the_walk_finds(monkeypatch, data, most):
    """Bins by the table of a tree's cells and by walking; the cells of Shapley values against the leaves' paths, gaps and infinite thresholds included."""
    monkeypatch.setattr(boosting, "MOST_CELLS", most)
    rng = np.random.default_rng(2)
    trees = []
    for _ in range(6):
        t = boosting.Tree()
        for v in range(7):
            t.feature[v], t.cut[v], t.missing_left[v] = int(rng.integers(0, 3)), int(rng.integers(0, 9)), bool(rng.integers(0, 2))
            t.threshold[v] = float(t.cut[v]) if t.cut[v] < 8 else math.inf
            t.left[v], t.right[v] = t.add(), t.add()
        t.value = list(rng.normal(0, 1, len(t.feature)))
        t.cover = [0.0] * len(t.feature)
        for v in reversed(range(len(t.feature))):
            t.cover[v] = t.cover[t.left[v]] + t.cover[t.right[v]] if t.feature[v] >= 0 else float(rng.integers(1, 9))
        trees.append(t)
    values = rng.integers(-1, 12, (500, 3)).astype(float)
    values[rng.random(values.shape) < 0.2] = np.nan
    model = boosting.TreeModel(("a", "b", "c"), 1.5, trees)
    walked = 1.5 + sum(np.array(t.value)[t.leaf_of_values(values)] for t in trees)
    assert all((t.cells() is None) == (most == 1) for t in trees)
    assert np.allclose(model.scores(values), walked, rtol=0, atol=1e-12)
    bins = boosting.encoded(values, [np.arange(8.0)] * 3)
    for t in trees:
        assert np.array_equal(boosting.Lookup(t, np.arange(len(t.feature))).of(boosting.Columns(bins)), t.leaf_of_bins(bins))
    assert np.allclose(tree_shap.Cells(model).matrix(values), tree_shap.shap_matrix(tree_shap.leaf_paths(model), values))
