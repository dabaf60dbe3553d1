"""Validation, profiles, quantiles, bins, transforms, pruning, scaling."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions.columns import boxcox, boxcox_inverse, feature_label
from tabloom.operators.binning import Bins, apply_bins, fit_categories, one_hot
from tabloom.operators.buckets import running_totals, weighted_summary
from tabloom.operators.correlation import correlation_pairs, fit_prune
from tabloom.operators.grids import quantile_grids
from tabloom.operators.powerlaw import fit_boxcox
from tabloom.operators.profile import prediction_summary
from tabloom.operators.quantiles import column_quantiles, exact_quantiles
from tabloom.operators.scaling import fit_scaler
from tabloom.operators.validate import file_digests, manifest, null_profile, row_fingerprint, validate

NAN = float("nan")


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    rows = zip(x.tolist(), (x + rng.normal(scale=0.01, size=n)).tolist(), rng.normal(size=n).tolist(), rng.normal(size=n).tolist())
    return spark.createDataFrame(list(rows), "x1 double, x2 double, x3 double, target double")


def test_validation_errors_come_in_order(spark):
    df = spark.createDataFrame([(1.0, 2)], "a double, number_of_elements int")
    with pytest.raises(ValueError, match="lacks"):
        validate(df)
    with pytest.raises(ValueError, match="80 are the least"):
        validate(df, required=["a"])
    with pytest.raises(ValueError, match="no rows"):
        validate(df.where("a > 5"), required=["a"], min_columns=2)
    assert validate(df, required=["a"], min_columns=2) == {}


def test_nulls_and_nans_are_counted_alike(spark):
    df = spark.createDataFrame([(1.0, "x"), (NAN, None), (None, "y")], "a double, b string")
    assert {r["column_name"]: r["n_null"] for r in null_profile(df).collect()} == {"a": 2, "b": 1}
    m = manifest(df.withColumn("full", F.lit(1)), "p", "s").first()
    assert (m["row_count"], m["column_count"], m["missing_values"]) == (3, 3, {"a": 2, "b": 1})
    assert validate(df, required=["a"], min_columns=2) == {"a": 2, "b": 1}


def test_digests(spark, tmp_path):
    import hashlib

    p = tmp_path / "t.csv"
    p.write_bytes(b"a,b\n1,2\n")
    assert file_digests(spark, str(p)).first()["sha256"] == hashlib.sha256(b"a,b\n1,2\n").hexdigest()


def test_large_files_are_hashed_range_by_range(spark, tmp_path):
    import hashlib

    rng = np.random.default_rng(3)
    sizes = {"short": 7, "one range": 640, "one more": 641, "two%20ranges": 1280, "many+\u00e4": 6_789}
    for file, n in sizes.items():
        (tmp_path / file).write_bytes(rng.bytes(n))
    want = sorted((n, hashlib.sha256((tmp_path / file).read_bytes()).hexdigest()) for file, n in sizes.items())
    for size in (640, 6_400):
        got = file_digests(spark, str(tmp_path), size)
        assert sorted(map(tuple, got.select("length", "sha256").collect())) == want
        assert {r["path"] for r in got.collect()} == {r["path"] for r in file_digests(spark, str(tmp_path)).collect()}
    with pytest.raises(ValueError, match="multiple of 64"):
        file_digests(spark, str(tmp_path), 100)


def test_no_range_is_longer_than_asked_for(tmp_path):
    from tabloom.functions.running_sha256 import START, advance
    from tabloom.operators.validate import _range

    p = tmp_path / "t"
    p.write_bytes(bytes(range(200)))
    assert [b"".join(_range(f"file:{p}", 200, at, 64)) for at in (0, 64, 192)] == [
        bytes(range(64)), bytes(range(64, 128)), bytes(range(192, 200))
    ]
    with pytest.raises(OSError, match="200 now"):
        list(_range(f"file:{p}", 300, 0, 64))
    with pytest.raises(ValueError, match="inside a block"):
        advance(START, 0, [b"a"], last=False)
    with pytest.raises(ValueError, match="whole blocks"):
        advance(START, 65, [b"a"], last=True)


def test_files_that_cannot_be_opened_by_range_are_rows(spark, tmp_path, monkeypatch):
    import hashlib

    from tabloom.operators import validate as module

    (tmp_path / "t").write_bytes(b"x" * 1000)
    monkeypatch.setattr(module, "_opens", lambda uri, length: False)
    assert file_digests(spark, str(tmp_path), 64).first()["sha256"] == hashlib.sha256(b"x" * 1000).hexdigest()


def test_a_file_that_changes_between_its_ranges_is_refused(spark, tmp_path, monkeypatch):
    import os

    from tabloom.operators import validate as module

    p = tmp_path / "t"
    p.write_bytes(b"x" * 1000)
    advance = module._next_ranges

    def changing(todo, size):
        os.utime(p, (1_000_000, 1_000_000 + todo[0][2]))
        return advance(todo, size)

    monkeypatch.setattr(module, "_next_ranges", changing)
    with pytest.raises(OSError, match="changed while"):
        file_digests(spark, str(tmp_path), 640)


def test_a_file_over_two_gigabytes_has_a_digest(spark, tmp_path):
    import hashlib

    p = tmp_path / "t"
    with open(p, "wb") as f:
        f.truncate(2**31 + 5)
    with open(p, "rb") as f:
        want = hashlib.file_digest(f, "sha256").hexdigest()
    assert [tuple(r) for r in file_digests(spark, str(p)).select("length", "sha256").collect()] == [(2**31 + 5, want)]


def test_row_fingerprint_ignores_order_but_not_copies(spark):
    df = spark.range(100)
    a = row_fingerprint(df).first()
    assert a == row_fingerprint(df.orderBy(F.desc("id")).repartition(3)).first()
    twice = row_fingerprint(df.union(df)).first()
    assert twice["row_count"] == 200 and twice["fingerprint"] not in ("0", a["fingerprint"])


@pytest.mark.parametrize("order_rows", [5_000_000, 40])
def test_quantiles_are_exact(spark, order_rows):
    rng = np.random.default_rng(0)
    n = 20_000
    heavy = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n) * 1e6)  # one value is a large share
    tail = np.exp(rng.normal(scale=4, size=n))
    gaps = [None if v else float(u) for v, u in zip(rng.random(n) < 0.1, rng.random(n))]
    df = spark.createDataFrame(
        list(zip(heavy.tolist(), tail.tolist(), gaps, [3.5] * n)), "heavy double, tail double, gaps double, flat double"
    ).repartition(4)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {(r["feature"], r["prob"]): r["value"] for r in exact_quantiles(df, df.columns, probs, order_rows).collect()}
    data = {"heavy": heavy, "tail": tail, "gaps": np.array([g for g in gaps if g is not None]), "flat": np.full(n, 3.5)}
    for c, values in data.items():
        for p in probs:
            assert got[c, p] == pytest.approx(np.quantile(values, p), rel=1e-12), (c, p)


def test_quantiles_of_few_and_no_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert column_quantiles(df, ["a", "b"], [0.5, 1.0]) == {("a", 0.5): 2.0, ("a", 1.0): 3.0}
    assert quantile_grids(df, ["b"])["b"].n == 0


def test_quantile_search_recovers_from_a_wrong_range(spark):
    from tabloom.operators.grids import Grid
    from tabloom.operators.quantiles import order_values

    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    wrong = Grid(1000, 0.0, 999.0, tuple(float(900 + i / 100) for i in range(1023)))
    assert order_values(df, {("v", 100), ("v", 501)}, {"v": wrong}, 50) == {("v", 100): 100.0, ("v", 501): 501.0}


def test_prediction_summary_of_one_row(spark):
    r = prediction_summary(spark.createDataFrame([(2.5,)], "prediction double")).first()
    assert (r["n_predictions"], r["mean"], r["std"], r["p50"]) == (1, 2.5, None, 2.5)
    empty = prediction_summary(spark.createDataFrame([], "prediction double")).first()
    assert (empty["n_predictions"], empty["mean"], empty["p25"]) == (0, None, None)


def test_running_totals_with_buckets(spark):
    rng = np.random.default_rng(3)
    rows = [("f", float(v), int(c)) for v, c in zip(range(500), rng.integers(1, 9, 500))]
    df = spark.createDataFrame(rows, "feature string, value double, n bigint")
    sums = np.cumsum([r[2] for r in rows])
    for edges in ([], [10.0, 10.5, 250.0, 499.0]):
        got = running_totals(df, ["feature"], "n", {"f": edges}).orderBy("value").collect()
        assert [r["upto"] for r in got] == sums.tolist() and got[0]["total"] == sums[-1]
    flat = np.repeat([r[1] for r in rows], [r[2] for r in rows])
    s = weighted_summary(df, ["feature"], {"q": 0.37}, {"f": [100.0, 200.0]}).first()
    assert s["q"] == pytest.approx(np.quantile(flat, 0.37)) and s["mean"] == pytest.approx(flat.mean())


def test_bins(spark):
    df = spark.createDataFrame([(i,) for i in [1, 2, 5, 7, 9, None]], "n int")
    b = [Bins("n", "out", (("lte", 1, 2), ("gte", 7, 6))), Bins("n", "eq", (("eq", 2, 1), ("gte", 7, 4))), Bins("zz", "z", ())]
    got = apply_bins(df, b)
    assert [tuple(r) for r in got.orderBy(F.asc_nulls_last("n")).collect()] == [
        (1, 2, 1), (2, 2, 1), (5, 5, 5), (7, 6, 4), (9, 6, 4), (None, 2, 4)]
    assert "z" not in got.columns
    with pytest.raises(ValueError, match="Unknown bin operator"):
        apply_bins(df, [Bins("n", "out", (("between", 1, 2),))])
    apply_bins(df, [Bins("absent", "out", (("between", 1, 2),))])


def test_one_hot_uses_fitted_categories(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    cats = fit_categories(df, "v")
    assert cats == [1, 3]
    new = spark.createDataFrame([(3,), (8,), (None,)], "v int")
    out = one_hot(new, "v", cats, "p")
    assert out.columns == ["p_1", "p_3"] and [tuple(r) for r in out.collect()] == [(0, 1), (0, 0), (0, 0)]
    assert one_hot(df.withColumn("v", F.col("v").cast("double")), "v", [1.0], "p").columns == ["p_1.0"]
    with pytest.raises(ValueError, match="distinct values"):
        fit_categories(spark.range(50), "id", 10)


@pytest.mark.parametrize("lmbda", [0.0, 1.0, 0.5, -0.5])
def test_boxcox_round_trip(spark, lmbda):
    df = spark.range(1, 50).select((F.col("id") / 7).alias("x"))
    for r in df.select("x", boxcox_inverse(boxcox(F.col("x"), lmbda), lmbda).alias("back")).collect():
        assert r["back"] == pytest.approx(r["x"], rel=1e-9)


def brute_lambda(x):
    """Least variance of the transform of x over its geometric mean, by golden section."""
    z = np.log(x) - np.log(x).mean()

    def var(lam):
        return np.var(z if abs(lam) < 1e-12 else np.expm1(lam * z) / lam)

    lo, hi, g = -8.0, 8.0, (5**0.5 - 1) / 2
    for _ in range(200):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if var(a) < var(b) else (a, hi)
    return (lo + hi) / 2


@pytest.mark.parametrize("kind", ["lognormal", "normal", "steep", "reciprocal"])
def test_boxcox_fit(spark, kind):
    rng = np.random.default_rng(2)
    base = rng.normal(size=400)
    x = {"lognormal": np.exp(3 + base), "normal": 100 + 5 * base, "steep": (20 + base) ** 0.2, "reciprocal": 1 / (50 + base)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    fit = fit_boxcox(df, "x", "y")
    assert fit.lmbda == pytest.approx(brute_lambda(x), abs=2e-5)
    if kind == "lognormal":
        before, after = df.agg(F.skewness("x")).first()[0], fit.apply(df).agg(F.skewness("y")).first()[0]
        assert abs(after) < abs(before) and abs(after) < 0.1


def test_boxcox_refuses_bad_columns(spark):
    for rows, text in (([(0.0,), (1.0,)], "positive"), ([(2.0,), (2.0,)], "constant"), ([(None,)], "no values")):
        with pytest.raises(ValueError, match=text):
            fit_boxcox(spark.createDataFrame(rows, "x double"), "x", "y")


def test_correlation_prune(spark):
    df = frame(spark)
    assert fit_prune(df, "target", 0.8).correlated == ("x2",)
    assert fit_prune(df, "target", 0.8, protected=["x2"]).correlated == ()
    p = fit_prune(df, "target", 0.8, listed=["x3", "absent"])
    assert p.apply(df).columns == ["x1", "target"]


def test_prune_is_not_transitive(spark):
    """A column goes if it is close to any earlier one, dropped or not."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=3000)
    b = a + rng.normal(scale=0.5, size=3000)
    c = b + rng.normal(scale=0.5, size=3000)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), c.tolist(), a.tolist())), "a double, b double, c double, t double")
    assert abs(np.corrcoef(a, c)[0, 1]) < 0.85 < min(np.corrcoef(a, b)[0, 1], np.corrcoef(b, c)[0, 1])
    assert fit_prune(df, "t", 0.85).correlated == ("b", "c")


def test_correlation_with_nulls_and_constants(spark):
    import pandas as pd

    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=300) * 1e-3 + 1e6, "b": rng.normal(size=300), "k": 1.1})
    pdf["c"] = pdf["a"] * 2 + pdf["b"] * 1e-4
    pdf.loc[rng.random(300) < 0.3, "b"] = np.nan
    pdf["none"] = np.nan
    df = spark.createDataFrame(pdf)
    want = pdf.corr()
    for r in correlation_pairs(df, list(pdf.columns)).collect():
        expected = want.loc[r["feature_i"], r["feature_j"]]
        if math.isnan(expected):
            assert r["r"] is None, r
        else:
            assert r["r"] == pytest.approx(expected, abs=1e-7), r


def test_wide_correlation(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 81))
    df = spark.createDataFrame(x.tolist(), ", ".join(f"f{i} double" for i in range(81)))
    got = {(r["i"], r["j"]): r["r"] for r in correlation_pairs(df, df.columns).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 81 * 80 // 2
    assert max(abs(got[k] - want[k]) for k in got) < 1e-10


def test_scaler(spark):
    df = spark.createDataFrame([(float(i), 10.0 * i, 4.2, i) for i in range(1, 6)], "a double, b double, k double, skip int")
    s = fit_scaler(df, ["skip"])
    out = s.apply(df).toPandas()
    assert out["a"].mean() == pytest.approx(0) and out["a"].std(ddof=0) == pytest.approx(1)
    assert out["skip"].tolist() == [1, 2, 3, 4, 5] and (out["k"].abs() < 1e-12).all()
    assert list(out.columns) == df.columns


def test_label(spark):
    got = spark.range(1).select(feature_label(F.lit("wtd_range_FIE"))).first()[0]
    assert got == "Weighted Range Fie"
