"""Queries on bins, one-hot columns, power transforms, pruning, scaling and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.data import FEATURES, LINE_SQL, LINES, TARGET, lines, rounded, table
from tabloom.functions.columns import approximate_celsius, approximate_kelvin
from tabloom.operators.binning import Bins, apply_bins, category_table, fit_categories, one_hot, one_hot_vector
from tabloom.operators.correlation import Prune, correlated_features, correlation_pairs
from tabloom.operators.frames import melt
from tabloom.operators.mutual_info import mutual_information
from tabloom.operators.neighbour_info import neighbour_information
from tabloom.operators.powerlaw import BoxCox, fit_boxcox, log_likelihoods
from tabloom.operators.scaling import fit_scaler, scale_stats
from tabloom.operators.split import (
    background_sample,
    with_exact_split,
    with_fold,
    with_split,
    with_stratified_split,
)
from tabloom.plans.features import FeatureConfig, FeaturePlan, fit_features, from_config

SIZE_BINS = Bins("size", "size_bin", (("lte", 5, 6), ("gte", 45, 40)))
LINE_BINS = Bins("line", "line_bin", (("eq", 1, 2), ("gte", 5, 4)))
LAMBDA = 0.72
BOXCOX = BoxCox("l_extendedprice", "price_boxcox", LAMBDA)
THRESHOLD = 0.8

CONFIG = FeatureConfig(
    target=TARGET,
    transformed_target="l_extendedprice_boxcox",
    bins=(
        Bins("p_size", "size_bin", (("lte", 5, 6), ("gte", 45, 40))),
        Bins("l_linenumber", "line_bin", (("eq", 1, 2), ("gte", 5, 4))),
    ),
    one_hot_column="line_bin",
    one_hot_prefix="line",
    drop_raw=("p_size", "l_linenumber"),
    correlation_threshold=THRESHOLD,
    protected=("size_bin",),
    drop_listed=("line_2",),
    skip_scaling=("size_bin",),
)
TEXT = ["l_orderkey", "l_returnflag", "l_linestatus"]


def _bin_sizes(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.nullif("p_size", F.lit(30)).alias("size"))
    return apply_bins(parts, [SIZE_BINS])


def _bin_lines(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(3)).alias("line"))
    absent = Bins("not_there", "unused", (("lte", 1, 1),))
    return apply_bins(items, [LINE_BINS, absent]).groupBy("line", "line_bin").agg(F.count("*").alias("n"))


def _one_hot(spark, sf):
    items = table(spark, sf, "lineitem").select("l_returnflag", F.nullif("l_linenumber", F.lit(3)).alias("line"))
    binned = apply_bins(items, [Bins("line", "line_bin", (("eq", 1, 2),))])
    cats = fit_categories(binned, "line_bin")
    wide = one_hot(binned, "line_bin", cats, "line")
    sums = [F.sum(f"line_{v}").alias(f"line_{v}") for v in cats]
    return wide.groupBy("l_returnflag").agg(F.count("*").alias("n"), *sums)


def _corr_matrix(spark, sf):
    df = lines(spark, sf).withColumn("constant", F.lit(1.1))
    return rounded(correlation_pairs(df, [*FEATURES, TARGET, "constant"]).select("feature_i", "feature_j", "r"))


def _corr_prune(spark, sf):
    return rounded(correlated_features(correlation_pairs(lines(spark, sf), FEATURES), THRESHOLD).select("feature", "with_feature", "r"))


def _scaler_apply(spark, sf):
    df = lines(spark, sf).select(*LINES, *FEATURES)
    return rounded(fit_scaler(df, skip=[*LINES, "p_size"]).apply(df))


def _plan_fit(spark, sf):
    """Fitted plan applied to all rows, summed up per feature."""
    df = lines(spark, sf)
    plan = fit_features(df, CONFIG, ignore=TEXT)
    out = plan.transform(df)
    return melt(out, plan.features).groupBy("feature").agg(
        F.count("*").alias("n"), (F.round(F.avg("value"), 6) + 0.0).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("sd"))


def _plan_apply(spark, sf):
    """A kept plan applied to a table without its target being refitted."""
    df = lines(spark, sf)
    scaler = fit_scaler(df.select("l_quantity", "l_discount"))
    plan = FeaturePlan(
        CONFIG, (2, 3, 4), BoxCox(TARGET, CONFIG.transformed_target, LAMBDA), Prune(THRESHOLD, ("gross",), ("line_2",)),
        scaler, ("l_quantity", "l_discount", "size_bin", "line_3", "line_4"),
    )
    return rounded(plan.transform(df, keep=["l_orderkey", "l_linenumber"]))


def _hash_split(spark, sf):
    return with_split(table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


def _exact_split(spark, sf):
    return with_exact_split(table(spark, sf, "orders"), ["o_orderkey"]).groupBy("split").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


def _stratified(spark, sf):
    df = with_stratified_split(table(spark, sf, "orders"), ["o_orderkey"], "o_orderpriority")
    return df.groupBy("o_orderpriority", "split").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


def _folds(spark, sf):
    df = with_fold(table(spark, sf, "orders"), ["o_orderkey"])
    return df.groupBy("fold").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


def _background(spark, sf):
    df = background_sample(table(spark, sf, "orders"), ["o_orderkey"], 100)
    return df.select("draw", "o_orderkey", "o_totalprice")


def _temperature(spark, sf):
    raw = F.ln("value")
    return rounded(table(spark, sf, "events").select(
        "event_id", approximate_kelvin(raw).alias("kelvin"), approximate_celsius(raw).alias("celsius")), 4)


GRID = [round(-2 + 0.1 * i, 1) for i in range(41)]

def _sparse_categories(spark, sf):
    """Part keys as sparse one-hot vectors; every fiftieth key was not seen when the categories were fitted."""
    items = table(spark, sf, "lineitem").select("l_partkey")
    categories = category_table(items.where("l_partkey % 50 <> 0"), "l_partkey")
    vectors = one_hot_vector(items, "l_partkey", categories, "part").withColumn("v", F.unwrap_udt("part"))
    return vectors.groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.max(F.get("v.indices", F.lit(0))).alias("index"), F.max("v.size").alias("size"),
        F.max(F.get("v.values", F.lit(0))).alias("value"))


SETTINGS = {
    "feature_engineering": {
        "target_column": TARGET, "engineered_target_column": "price_boxcox", "correlation_threshold": THRESHOLD,
        "element_bins": {"column": "p_size", "low_threshold": 5, "low_value": 6, "high_threshold": 45, "high_value": 40},
        "valence_bins": {"column": "line", "merge_zero_to": 2, "high_threshold": 5, "high_value": 4},
        "protected_columns": [], "drop_low_mi_columns": ["l_tax"],
    },
    "preprocessing": {"columns_to_skip_scaling": []},
}


def _configured(spark, sf):
    """Bins, one-hot columns and drops as a configuration names them, fitted and applied."""
    df = lines(spark, sf).select("p_size", (F.col("l_linenumber") - 1).alias("line"), "l_quantity", "l_tax", TARGET)
    config = from_config(SETTINGS)
    binned = apply_bins(df, config.bins)
    flags = one_hot(binned, config.one_hot_column, fit_categories(binned, config.one_hot_column), config.one_hot_prefix)
    kept = flags.drop(*config.drop_raw, *config.drop_listed)
    bins = [c for c in kept.columns if c not in ("l_quantity", TARGET)]
    return kept.groupBy(*bins).agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"))


def _neighbours(spark, sf):
    """Parts: what tells most about the price, by nearest neighbours."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    p = p.withColumns({"mixed": F.col("p_retailprice") % 97 + F.col("p_size"), "key": F.col("p_partkey").cast("double")})
    return rounded(neighbour_information(p, ["p_size", "mixed", "key"], "p_retailprice", ["p_partkey"]))


def _psi(n: str) -> str:
    m = f"(({n}) + 6.0)"
    tail = " ".join(f"- 1 / (({n}) + {j}.0)" for j in range(6))
    return f"(ln({m}) - 1 / (2 * {m}) - 1 / (12 * {m} * {m}) + 1 / (120 * {m} * {m} * {m} * {m}) - 1 / (252 * {m} * {m} * {m} * {m} * {m} * {m}) {tail})"


def _jitter(salt: int) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws(':', '{salt}', CAST(p_partkey AS VARCHAR))), 1, 15) AS BIGINT) / 1152921504606846976.0 - 0.5) * 1e-10"


QUERIES = {
    "mi_neighbours": _neighbours,
    "one_hot_sparse": _sparse_categories,
    "configured_features": _configured,
    "bin_lte_gte": _bin_sizes,
    "bin_eq_chain": _bin_lines,
    "one_hot": _one_hot,
    "boxcox_fit": lambda s, sf: s.createDataFrame(
        [(round(fit_boxcox(table(s, sf, "lineitem"), "l_extendedprice", "y").lmbda, 3),)], "lmbda double"),
    "boxcox_profile": lambda s, sf: rounded(log_likelihoods(table(s, sf, "lineitem"), "l_extendedprice", GRID), 3),
    "boxcox_apply": lambda s, sf: rounded(BOXCOX.apply(table(s, sf, "lineitem").select(*LINES, "l_extendedprice"))),
    "boxcox_inverse": lambda s, sf: rounded(BOXCOX.inverse(
        table(s, sf, "lineitem").select(*LINES, F.col("l_extendedprice").alias("raw"),
                                        (F.col("l_extendedprice") / 1000 - 2).alias("v")), "v", "back")),
    "approximate_temperature": _temperature,
    "corr_matrix": _corr_matrix,
    "corr_prune": _corr_prune,
    "mi_ranking": lambda s, sf: rounded(mutual_information(lines(s, sf), FEATURES, TARGET, 16, "width")),
    "mi_ranking_quantile": lambda s, sf: mutual_information(lines(s, sf), FEATURES, TARGET, 16, "quantile"),
    "scaler_fit": lambda s, sf: rounded(scale_stats(lines(s, sf).withColumn("constant", F.lit(1.1)),
                                                    [*FEATURES, "constant"]), 8),
    "scaler_apply": _scaler_apply,
    "feature_plan_fit": _plan_fit,
    "feature_plan_apply": _plan_apply,
    "hash_split": _hash_split,
    "exact_split": _exact_split,
    "stratified_split": _stratified,
    "folds": _folds,
    "background_sample": _background,
}

_MD5 = "md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR)))"
_NUM = "CAST('0x' || substr({h}, 1, 15) AS BIGINT)"
_PAIR_NAMES = [*FEATURES, TARGET, "constant"]


def _llf(lam: str, var: str) -> str:
    return f"({lam} - 1) * sl - n / 2.0 * ln({var})"


_FIT_SQL = """
    x AS (SELECT l_extendedprice AS x FROM lineitem),
    s AS (SELECT count(*) AS n, sum(ln(x)) AS sl FROM x)"""

ORACLE = {
    "one_hot_sparse": """WITH c AS (SELECT l_partkey, CAST(row_number() OVER (ORDER BY l_partkey) - 1 AS INT) AS i, CAST(count(*) OVER () AS INT) AS size
          FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey % 50 <> 0)),
        s AS (SELECT max(size) AS size FROM c)
        SELECT l_partkey, count(*) AS n, max(i) AS index, max(s.size) AS size, CASE WHEN max(i) IS NOT NULL THEN CAST(1 AS DOUBLE) END AS value
        FROM lineitem LEFT JOIN c USING (l_partkey), s GROUP BY l_partkey""",
    "mi_neighbours": f"""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, p_retailprice % 97 + p_size AS mixed,
            CAST(p_partkey AS DOUBLE) AS key FROM part),
        s AS (SELECT stddev_pop(p_size) AS a, stddev_pop(mixed) AS b, stddev_pop(key) AS c, stddev_pop(p_retailprice) AS d FROM p),
        l AS (SELECT 'p_size' AS feature, p_partkey, p_size / a + {_jitter(0)} AS x, p_retailprice / d + {_jitter(3)} AS y FROM p, s
              UNION ALL SELECT 'mixed', p_partkey, mixed / b + {_jitter(1)}, p_retailprice / d + {_jitter(3)} FROM p, s
              UNION ALL SELECT 'key', p_partkey, key / c + {_jitter(2)}, p_retailprice / d + {_jitter(3)} FROM p, s),
        j AS (SELECT a.feature, a.p_partkey, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy, a.p_partkey = b.p_partkey AS self
              FROM l a JOIN l b USING (feature)),
        r AS (SELECT feature, p_partkey, list_sort(min(greatest(dx, dy), 3) FILTER (WHERE NOT self))[3] AS r FROM j GROUP BY 1, 2),
        c AS (SELECT feature, p_partkey, CAST(count(*) FILTER (WHERE dx < r) AS DOUBLE) AS nx, CAST(count(*) FILTER (WHERE dy < r) AS DOUBLE) AS ny
              FROM j JOIN r USING (feature, p_partkey) GROUP BY 1, 2)
        SELECT feature, round(greatest(0, {_psi('CAST(count(*) AS DOUBLE)')} + {_psi('3.0')} - avg({_psi('nx')}) - avg({_psi('ny')})), 6) AS mutual_information
        FROM c GROUP BY feature""",
    "configured_features": """WITH f AS (SELECT CAST(p_size AS DOUBLE) AS p_size, l_linenumber - 1 AS line, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey),
        b AS (SELECT CASE WHEN p_size <= 5 THEN 6 WHEN p_size >= 45 THEN 40 ELSE p_size END AS num_elements_simplified,
                     CASE WHEN line = 0 THEN 2 WHEN line >= 5 THEN 4 ELSE line END AS v, l_quantity FROM f)
        SELECT num_elements_simplified, CAST(v = 1 AS INT) AS "rangeValence_1", CAST(v = 2 AS INT) AS "rangeValence_2",
               CAST(v = 3 AS INT) AS "rangeValence_3", CAST(v = 4 AS INT) AS "rangeValence_4", count(*) AS n, max(l_quantity) AS most
        FROM b GROUP BY 1, 2, 3, 4, 5""",
    "bin_lte_gte": """WITH p AS (SELECT p_partkey, nullif(p_size, 30) AS size FROM part),
        a AS (SELECT *, CASE WHEN size > 5 THEN size ELSE 6 END AS b FROM p)
        SELECT p_partkey, size, CASE WHEN b < 45 THEN b ELSE 40 END AS size_bin FROM a""",
    "bin_eq_chain": """WITH p AS (SELECT nullif(l_linenumber, 3) AS line FROM lineitem),
        a AS (SELECT *, CASE WHEN line = 1 THEN 2 ELSE line END AS b FROM p)
        SELECT line, CASE WHEN b < 5 THEN b ELSE 4 END AS line_bin, count(*) AS n FROM a GROUP BY 1, 2""",
    "one_hot": """WITH p AS (SELECT l_returnflag, nullif(l_linenumber, 3) AS line FROM lineitem),
        a AS (SELECT *, CASE WHEN line = 1 THEN 2 ELSE line END AS b FROM p)
        SELECT l_returnflag, count(*) AS n, """ + ", ".join(
        f"count(*) FILTER (WHERE b = {v}) AS line_{v}" for v in (2, 4, 5, 6, 7)
    ) + " FROM a GROUP BY 1",
    "boxcox_fit": f"""WITH {_FIT_SQL},
        g AS (SELECT unnest(range(-200, 201)) / 100.0 AS lam),
        c AS (SELECT lam, {_llf('lam', 'v')} AS llf FROM (
                SELECT lam, var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END) AS v
                FROM x, g GROUP BY lam), s),
        b AS (SELECT arg_max(lam, llf) AS lam FROM c),
        h AS (SELECT b.lam + i / 1000.0 AS lam FROM b, (SELECT unnest(range(-15, 16)) AS i)),
        e AS (SELECT lam, {_llf('lam', 'v')} AS llf FROM (
                SELECT lam, var_pop((pow(x, lam) - 1) / lam) AS v FROM x, h GROUP BY lam), s)
        SELECT CAST(round(arg_max(lam, llf), 3) AS DOUBLE) AS lmbda FROM e""",
    "boxcox_profile": f"""WITH {_FIT_SQL},
        g AS (SELECT CAST(unnest(range(-20, 21)) / 10.0 AS DOUBLE) AS lam),
        v AS (SELECT lam, avg(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x / gm, lam) - 1) / lam END) AS m
              FROM x, g, (SELECT exp(avg(ln(x))) AS gm FROM x) GROUP BY lam),
        w AS (SELECT g.lam, avg(pow(CASE WHEN g.lam = 0 THEN ln(x) ELSE (pow(x / gm, g.lam) - 1) / g.lam END - m, 2)) AS v
              FROM x, g JOIN v ON v.lam = g.lam, (SELECT exp(avg(ln(x))) AS gm FROM x) GROUP BY g.lam)
        SELECT lam AS lmbda, round(-sl - n / 2.0 * ln(v), 3) AS llf FROM w, s""",
    "boxcox_apply": f"""SELECT l_orderkey, l_linenumber, round((pow(l_extendedprice, {LAMBDA}) - 1) / {LAMBDA}, 6)
        AS price_boxcox FROM lineitem""",
    "boxcox_inverse": f"""SELECT l_orderkey, l_linenumber, l_extendedprice AS raw,
        round(l_extendedprice / 1000 - 2, 6) AS v,
        round(pow(greatest({LAMBDA} * (l_extendedprice / 1000 - 2) + 1, 0), 1 / {LAMBDA}), 6) AS back FROM lineitem""",
    "approximate_temperature": """WITH r AS (SELECT event_id, ln(value) AS raw FROM events),
        k AS (SELECT event_id, CASE WHEN raw > 0 THEN pow(raw, 1 / 0.24) ELSE 0 END AS k FROM r)
        SELECT event_id, round(k, 4) AS kelvin, round(k - 273.15, 4) AS celsius FROM k""",
    "corr_matrix": f"WITH {LINE_SQL}, c AS (SELECT *, CAST(1.1 AS DOUBLE) AS constant FROM f) " + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, "
        f"round(CASE WHEN min({b}) = max({b}) THEN NULL ELSE corr({a}, {b}) END, 6) AS r FROM c"
        for i, a in enumerate(_PAIR_NAMES) for b in _PAIR_NAMES[i + 1:]
    ),
    "corr_prune": f"WITH {LINE_SQL}, c AS (" + " UNION ALL ".join(
        f"SELECT {i} AS i, '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM f"
        for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]
    ) + f") SELECT b AS feature, arg_min(a, i) AS with_feature, round(arg_min(r, i), 6) AS r FROM c "
    f"WHERE abs(r) > {THRESHOLD} GROUP BY b",
    "mi_ranking": f"WITH {LINE_SQL}, y AS (SELECT min({TARGET}) AS a, max({TARGET}) AS z FROM f), l AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, least(floor(({c} - a1) / ((z1 - a1) / 16)), 15) AS bx,
            least(floor(({TARGET} - a) / ((z - a) / 16)), 15) AS b_y
            FROM f, y, (SELECT min({c}) AS a1, max({c}) AS z1 FROM f)""" for c in FEATURES)
    + """), j AS (SELECT feature, bx, b_y, count(*) AS c FROM l GROUP BY ALL),
        t AS (SELECT feature, c, sum(c) OVER (PARTITION BY feature) AS n,
              sum(c) OVER (PARTITION BY feature, bx) AS nx, sum(c) OVER (PARTITION BY feature, b_y) AS ny FROM j)
        SELECT feature, round(sum(CAST(c AS DOUBLE) / CAST(n AS DOUBLE) * ln(CAST(c AS DOUBLE) * CAST(n AS DOUBLE)
               / (CAST(nx AS DOUBLE) * CAST(ny AS DOUBLE)))), 6) AS mutual_information FROM t GROUP BY feature""",
    "scaler_fit": f"WITH {LINE_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_pop({c}), 8) AS sd FROM f" for c in FEATURES
    ) + " UNION ALL SELECT 'constant', CAST(1.1 AS DOUBLE), CAST(1 AS DOUBLE)",
    "scaler_apply": f"WITH {LINE_SQL}, s AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES
    ) + " FROM f) SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"round({c}, 6) AS {c}" if c == "p_size" else f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FEATURES
    ) + " FROM f, s",
    "feature_plan_fit": f"""WITH {LINE_SQL},
        b AS (SELECT *, CASE WHEN p_size > 5 THEN p_size ELSE 6 END AS pb FROM f),
        c AS (SELECT *, CASE WHEN pb < 45 THEN pb ELSE 40 END AS size_bin FROM b),
        l AS (SELECT DISTINCT CASE WHEN l_linenumber = 1 THEN 2 WHEN l_linenumber >= 5 THEN 4 ELSE l_linenumber END AS v
              FROM lineitem)
        SELECT 'size_bin' AS feature, count(*) AS n, round(avg(size_bin), 6) AS mean, round(stddev_pop(size_bin), 6) AS sd
        FROM c
        UNION ALL SELECT name, (SELECT count(*) FROM f), CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) FROM (
          SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'p_retailprice']) AS name
          UNION ALL SELECT 'gross' FROM f HAVING greatest(abs(corr(l_quantity, gross)), abs(corr(l_discount, gross)),
            abs(corr(l_tax, gross)), abs(corr(p_retailprice, gross))) <= 0.8
          UNION ALL SELECT 'line_' || CAST(v AS VARCHAR) FROM l WHERE v <> 2)""",
    "feature_plan_apply": f"""WITH {LINE_SQL},
        s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md,
                     stddev_pop(l_discount) AS sd FROM f),
        b AS (SELECT *, CASE WHEN l_linenumber = 1 THEN 2 ELSE l_linenumber END AS lb,
                     CASE WHEN p_size > 5 THEN p_size ELSE 6 END AS pb FROM f)
        SELECT round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_discount - md) / sd, 6) AS l_discount,
               CASE WHEN pb < 45 THEN pb ELSE 40.0 END AS size_bin, CAST(lb = 3 AS INT) AS line_3,
               CAST(lb >= 4 AS INT) AS line_4,
               round((pow(l_extendedprice, {LAMBDA}) - 1) / {LAMBDA}, 6) AS l_extendedprice_boxcox,
               l_orderkey, l_linenumber FROM b, s""",
    "hash_split": f"SELECT o_orderkey, CASE WHEN substr({_MD5}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END "
    "AS split FROM orders",
    "exact_split": f"""WITH h AS (SELECT o_orderkey, {_NUM.format(h=_MD5)} >> 8 AS h FROM orders),
        r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM h)
        SELECT CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split, count(*) AS n,
               CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM r GROUP BY 1""",
    "stratified_split": """WITH h AS (SELECT *, CASE WHEN substr(md5(concat_ws(':', '42', o_orderpriority,
          CAST(o_orderkey AS VARCHAR))), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split FROM orders)
        SELECT o_orderpriority, split, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM h GROUP BY 1, 2""",
    "folds": f"""SELECT CAST({_NUM.format(h=_MD5)} % 5 AS INT) AS fold, count(*) AS n,
        CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""",
    "background_sample": f"""SELECT CAST(row_number() OVER (ORDER BY {_MD5}, o_orderkey) - 1 AS INT) AS draw, o_orderkey,
        o_totalprice FROM orders ORDER BY {_MD5}, o_orderkey LIMIT 100""",
}
