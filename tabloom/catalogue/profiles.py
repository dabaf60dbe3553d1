"""Queries on validation, profiles, medians and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.data import FEATURES, LINE_SQL, LINES, TARGET, events, lines, rounded, table
from tabloom.functions.columns import boxcox, feature_label
from tabloom.operators.frames import melt, numeric_columns
from tabloom.operators.powerlaw import fit_boxcox
from tabloom.operators.profile import (
    describe_features,
    example_row,
    feature_order,
    feature_profile,
    prediction_summary,
    skewness,
    training_medians,
)
from tabloom.operators.split import with_split
from tabloom.operators.validate import file_digests, manifest, null_profile, row_fingerprint, validate
from tabloom.session import small_table

# Descriptions of some of the features.
DICTIONARY = [
    ("l_quantity", "Quantity of the line"),
    ("p_size", "Size of the part"),
    ("gross", "Quantity times list price"),
]
DICTIONARY_SQL = "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in DICTIONARY) + ") d(feature, description)"

LAMBDA = 0.72

GAPPY_SQL = """
g AS (SELECT l_orderkey, l_partkey, l_suppkey, nullif(l_linenumber, 3) AS l_linenumber, l_quantity, l_extendedprice,
             CASE WHEN l_discount = 0.05 THEN NULL ELSE l_discount END AS l_discount, l_tax, l_returnflag,
             l_linestatus, l_shipdate FROM lineitem)"""


def _gappy(spark, sf):
    """Line items with a null and a NaN put in, both of which count as missing."""
    return table(spark, sf, "lineitem").withColumns(
        {
            "l_linenumber": F.nullif("l_linenumber", F.lit(3)),
            "l_discount": F.when(F.col("l_discount") == 0.05, F.lit(float("nan"))).otherwise(F.col("l_discount")),
        }
    )


def _null_profile(spark, sf):
    df = _gappy(spark, sf)
    validate(df, required=("l_orderkey", "l_extendedprice"), min_columns=10, null_counts=False)
    return null_profile(df).withColumn("is_numeric", F.col("column_name").isin(numeric_columns(df)))


def _manifest(spark, sf):
    df = _gappy(spark, sf)
    m = manifest(df, "lineitem")
    pairs = F.array_sort(F.transform(F.map_entries("missing_values"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return m.select("source_path", "row_count", "column_count", F.array_join(pairs, ",").alias("missing_values"))


def _dictionary(spark):
    return small_table(spark, DICTIONARY, "feature string, description string")


def _train(spark, sf):
    return with_split(lines(spark, sf), LINES).where("split = 'train'")


def _feature_profile(spark, sf):
    known = training_medians(_train(spark, sf), FEATURES[:-1])
    return feature_profile(lines(spark, sf), FEATURES, known, _dictionary(spark))


def _example(spark, sf):
    known = training_medians(_train(spark, sf), FEATURES[:-1])
    return example_row(feature_order(spark.read.parquet(f"{sf}/part.parquet"), FEATURES), known)


def _dictionary_lookup(spark, sf):
    counts = melt(lines(spark, sf), FEATURES).groupBy("feature").agg(F.count("*").alias("n_values"))
    return describe_features(counts, _dictionary(spark)).select(
        "feature", "description", feature_label(F.col("feature")).alias("label"), "n_values"
    )


def _skew(spark, sf):
    df = table(spark, sf, "lineitem")
    x = F.col("l_extendedprice")
    return rounded(df.agg(skewness(x).alias("before"), skewness(boxcox(x, LAMBDA)).alias("after")))


def _refused(spark, sf):
    """What the checks say of tables that break them."""
    df = table(spark, sf, "lineitem")
    cases = {
        "columns": lambda: validate(df, required=("l_orderkey", "l_weight"), min_columns=1),
        "width": lambda: validate(df.select("l_orderkey", "l_tax"), required=("l_orderkey",), min_columns=3),
        "rows": lambda: validate(df.where("l_quantity < 0"), required=("l_orderkey",), min_columns=1),
        "boxcox": lambda: fit_boxcox(df.select((F.col("l_discount") - 1).alias("d")), "d", "d_bc"),
    }
    rows = []
    for case, check in cases.items():
        try:
            check()
            rows.append((case, None))
        except ValueError as error:
            rows.append((case, str(error)))
    return small_table(spark, rows, "check string, message string")


QUERIES = {
    "null_profile": _null_profile,
    "refused_tables": _refused,
    "manifest": _manifest,
    "file_digests": lambda s, sf: file_digests(s, f"{sf}/lineitem.parquet").select("length", "sha256"),
    "row_fingerprint": lambda s, sf: row_fingerprint(table(s, sf, "lineitem")),
    "feature_profile": _feature_profile,
    "training_medians": lambda s, sf: rounded(training_medians(_train(s, sf), [*FEATURES, TARGET])),
    "example_row": _example,
    "dictionary_lookup": _dictionary_lookup,
    "skew_before_after": _skew,
    "prediction_summary": lambda s, sf: prediction_summary(events(s, sf), "value"),
}

_TRAIN_SQL = (
    "t AS (SELECT * FROM f WHERE substr(md5(concat_ws(':', '42', CAST(l_orderkey AS VARCHAR), "
    "CAST(l_linenumber AS VARCHAR))), 1, 8) >= '33333333')"
)


def _per_feature(features, template):
    return " UNION ALL ".join(template.format(f=f) for f in features)


_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_TEXT = ("l_returnflag", "l_linestatus", "l_shipdate")

_MEDIANS_SQL = "m AS (" + _per_feature(
    FEATURES[:-1], "SELECT '{f}' AS feature, quantile_cont({f}, 0.5) AS median FROM t"
) + ")"

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate",
)

ORACLE = {
    "refused_tables": """SELECT unnest(['columns', 'width', 'rows', 'boxcox']) AS check, unnest([
        'the training table lacks [''l_weight'']', '2 columns where 3 are the least: is the table cut short?',
        'the training table has no rows',
        'Box-Cox requires strictly positive values; column ''d'' has zero or negative ones.']) AS message
        FROM (SELECT count(*) FROM lineitem)""",
    "row_fingerprint": f"""SELECT count(*) AS row_count, CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws('|',
        {", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(92) || 'N')" for c in _LINE_COLUMNS)})), 1, 15) AS BIGINT) AS DECIMAL(38, 0)))
        AS VARCHAR) AS fingerprint FROM lineitem""",
    "null_profile": f"WITH {GAPPY_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, "
        f"{'false' if c in _TEXT else 'true'} AS is_numeric FROM g" for c in _COLUMNS
    ),
    "manifest": f"""WITH {GAPPY_SQL}
        SELECT 'lineitem' AS source_path, count(*) AS row_count, CAST(11 AS BIGINT) AS column_count,
               'l_discount=' || CAST(count(*) - count(l_discount) AS VARCHAR) || ',l_linenumber='
               || CAST(count(*) - count(l_linenumber) AS VARCHAR) AS missing_values
        FROM g""",
    "feature_profile": f"WITH {LINE_SQL}, {_TRAIN_SQL}, {_MEDIANS_SQL}, r AS (" + _per_feature(
        FEATURES,
        "SELECT '{f}' AS feature, min({f}) AS lo, max({f}) AS hi, quantile_cont({f}, 0.25) AS q1, "
        "quantile_cont({f}, 0.75) AS q3 FROM f",
    ) + f""")
        SELECT r.feature, coalesce(d.description, r.feature) AS description,
               round(coalesce(m.median, 0.0), 4) AS median, true AS auto_imputed_if_missing,
               round(lo, 4) AS min, round(hi, 4) AS max, round(q1, 4) AS p25, round(q3, 4) AS p75
        FROM r LEFT JOIN m ON r.feature = m.feature LEFT JOIN {DICTIONARY_SQL} ON r.feature = d.feature""",
    "training_medians": f"WITH {LINE_SQL}, {_TRAIN_SQL} " + _per_feature(
        [*FEATURES, TARGET], "SELECT '{f}' AS feature, round(quantile_cont({f}, 0.5), 6) AS median FROM t"
    ),
    "example_row": f"WITH {LINE_SQL}, {_TRAIN_SQL}, {_MEDIANS_SQL} "
    "SELECT feature, round(median, 4) AS example FROM m UNION ALL SELECT 'gross', 0.0",
    "dictionary_lookup": f"WITH {LINE_SQL}, c AS (" + _per_feature(
        FEATURES, "SELECT '{f}' AS feature, count({f}) AS n_values FROM f"
    ) + f""")
        SELECT c.feature, coalesce(d.description, c.feature) AS description,
               array_to_string(list_transform(string_split(replace(c.feature, '_', ' '), ' '),
                 lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label, n_values
        FROM c LEFT JOIN {DICTIONARY_SQL} ON c.feature = d.feature""",
    "skew_before_after": f"""WITH v AS (
          SELECT l_extendedprice AS x, (pow(l_extendedprice, {LAMBDA}) - 1) / {LAMBDA} AS y FROM lineitem),
        m AS (SELECT avg(x) AS mx, avg(y) AS my FROM v)
        SELECT round(avg(pow(x - mx, 3)) / pow(avg(pow(x - mx, 2)), 1.5), 6) AS before,
               round(avg(pow(y - my, 3)) / pow(avg(pow(y - my, 2)), 1.5), 6) AS after
        FROM v, m""",
    "prediction_summary": """SELECT count(*) AS n_predictions, round(avg(value), 4) AS mean,
        round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
        round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50,
        round(quantile_cont(value, 0.75), 4) AS p75, round(max(value), 4) AS max FROM events""",
}
