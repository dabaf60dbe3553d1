"""Queries on request bodies, imputation, batch scoring and the prediction log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabloom.catalogue.data import events, rounded, table
from tabloom.operators.linear import LinearModel
from tabloom.operators.profile import medians_dict, training_medians
from tabloom.operators.scoring import score_batch, score_requests, score_strict
from tabloom.session import shared_dir, small_table
from tabloom.sources.codec import decode_requests, encode_responses
from tabloom.sources.prediction_log import append_log, flatten, log_records, read_log, split_corrupt
from tabloom.sources.tables import read_csv, read_optional_csv, read_small, uri, write_csv, write_small

MODEL = LinearModel(("k", "value", "bonus"), (0.5, 2.0, -1.0), 3.0)
EXPECTED = list(MODEL.features)
BODY_SHAPES = 16
#: One body in so many has this many quoted cells.
WIDE_EVERY, WIDE_CELLS = 50_000, 20_000


def _bodies(spark, sf):
    """Every event as a request body, in turn as each accepted shape and each malformed one; a few are very wide."""
    e = events(spark, sf)
    number, user = F.col("value").cast("string"), F.col("user_id").cast("string")
    value = F.concat(F.lit('{"value": '), number, F.lit(", "), F.expr("substring(props, 2)"))
    wide = F.col("event_id") % WIDE_EVERY == 17
    cells = F.sequence(F.lit(1), F.lit(WIDE_CELLS))
    shape = F.when(wide, -1).otherwise(F.col("event_id") % BODY_SHAPES)

    def quoted(before: str) -> Column:
        return F.array_join(F.transform(cells, lambda i: F.concat(F.lit(f'"{before}'), i.cast("string"), F.lit('"'))), ",")

    body = (
        F.when(shape == -1, F.concat(quoted("c"), F.lit("\n"), quoted("")))
        .when(shape == 0, F.concat(F.lit('{"features": '), value, F.lit("}")))
        .when(shape == 1, F.concat(F.lit('{"instances": ['), F.col("props"), F.lit(", "), value, F.lit("]}")))
        .when(shape == 2, F.col("props"))
        .when(shape == 3, F.concat(F.lit("value,user\n"), number, F.lit(","), user, F.lit("\n1.5,\n")))
        .when(shape == 4, F.col("props"))
        .when(shape == 5, F.concat(F.lit('{"features": {"user": "u'), user, F.lit('"}}')))
        .when(shape == 6, F.concat(F.lit("value,user\n1.5,"), user, F.lit(",7\n")))
        .when(shape == 7, F.concat(F.lit('"value","user, of page"\n"'), number, F.lit('",'), user, F.lit("\n")))
        .when(shape == 8, F.concat(F.lit("user,user\n1,"), user, F.lit("\n")))
        .when(shape == 9, F.concat(F.lit("value,user\nlow,"), user, F.lit("\n")))
        .when(shape == 10, F.concat(F.lit("value,user\nNaN,"), user, F.lit("\n")))
        .when(shape == 11, F.concat(F.lit("value,user\n2d,"), user, F.lit("\n")))
        .when(shape == 12, F.concat(F.lit('{"features": {"user": "'), user, F.lit('"}}')))
        .when(shape == 13, F.concat(F.lit('{"user": true, "value": '), number, F.lit("}")))
        .when(shape == 14, F.concat(F.lit('"value\nof ""page""",user\r\n"1.5",'), user))
        .otherwise(F.concat(F.lit('"value,user\n1.5,'), user, F.lit("\n")))
    )
    kind = F.when(shape.isin(0, 1, 2, 5, 12, 13), "application/json").when(shape == 4, "text/plain").otherwise("text/csv")
    return e.select(F.col("event_id").alias("req_id"), kind.alias("content_type"), body.alias("body"))


def _decoded(spark, sf):
    good, _ = decode_requests(_bodies(spark, sf))
    return good.select("req_id", "pos", F.explode_outer("features").alias("name", "given"))


def _encoded(spark, sf):
    e = events(spark, sf)
    kind = F.when(F.col("event_type") == "click", "text/csv").when(F.col("event_type") == "view", "*/*").when(
        F.col("event_type") == "error", "text/html").otherwise("application/json")
    pair = F.array(F.col("value"), F.col("value") * 2)
    rows = e.select(F.col("event_id").alias("req_id"), kind.alias("accept"),
                    F.posexplode(pair).alias("pos", "prediction"))
    good, bad = encode_responses(rows)
    return good.unionByName(bad.select("req_id", F.lit("rejected").alias("content_type"), F.col("reason").alias("body")))


def _requests(spark, sf):
    """Feature maps with gaps: no value on errors, no bonus except on purchases and clicks."""
    e = events(spark, sf)
    given = F.map_filter(
        F.map_from_arrays(
            F.array(F.lit("k"), F.lit("value"), F.lit("bonus")),
            F.array(
                F.get_json_object("props", "$.k").cast("double"),
                F.when(F.col("event_type") != "error", F.col("value")),
                F.when(F.col("event_type").isin("purchase", "click", "error"), F.col("user_id").cast("double")),
            ),
        ),
        lambda _, v: v.isNotNull(),
    )
    return e.select(F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("request_id"),
                    "event_type", given.alias("features"))


def _scored(spark, sf):
    medians = medians_dict(training_medians(events(spark, sf), ["value"]))
    return score_requests(_requests(spark, sf), EXPECTED, medians, MODEL.transform, "linear")


def _imputed(spark, sf):
    scored, _ = _scored(spark, sf)
    return rounded(scored.select(
        "request_id", "prediction", "model_type", "n_features",
        F.array_join("imputed_features", ",").alias("imputed_features")))


def _rejected(spark, sf):
    _, rejects = _scored(spark, sf)
    return rejects.select("request_id", "event_type", "reason")


def _batch(spark, sf):
    scored = score_batch(_requests(spark, sf), EXPECTED, MODEL.transform, "linear")
    return rounded(scored.select("request_id", "prediction", "n_features"))


def _strict(spark, sf):
    wide = events(spark, sf).select(
        F.col("event_id").cast("string").alias("request_id"), F.get_json_object("props", "$.k").cast("double").alias("k"),
        "value", F.col("user_id").cast("double").alias("bonus"), F.lit(1).alias("unused"))
    return rounded(score_strict(wide, EXPECTED, MODEL.transform, "linear").select("request_id", "prediction"))


def _log(spark, sf):
    scored, _ = _scored(spark, sf)
    path = shared_dir(spark, "log")
    append_log(log_records(scored, EXPECTED), path, 3000)
    return read_log(spark, path)


def _log_flatten(spark, sf):
    flat = flatten(_log(spark, sf))
    return rounded(flat.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"), "request_id", "n_features", "prediction",
        "bonus", "k", "value"))


def _log_overwrite(spark, sf):
    """A feature named like a log field replaces the field."""
    e = events(spark, sf)
    features = F.map_from_arrays(F.array(F.lit("prediction"), F.lit("k")), F.array(F.col("value") + 1, F.col("value")))
    log = e.select(F.col("event_id").cast("string").alias("request_id"), F.col("value").alias("prediction"),
                   F.when(F.col("event_type") != "view", features).alias("features"))
    return rounded(flatten(log))


def _log_text(spark, sf):
    """A log with blank and broken lines, written as text."""
    e = events(spark, sf)
    line = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("timestamp"),
        F.col("event_id").cast("string").alias("request_id"), F.col("value").alias("prediction")))
    text = e.select(F.when(F.col("event_type") == "error", F.lit("{broken")).when(
        F.col("event_type") == "signup", F.lit("  ")).otherwise(line).alias("value"))
    path = shared_dir(spark, "log-text")
    text.write.text(path)
    good, bad = split_corrupt(spark, path)
    both = good.select(F.lit(True).alias("ok"), "prediction").unionByName(
        bad.select(F.lit(False).alias("ok"), F.lit(None).cast("double").alias("prediction")))
    return both.agg(F.count_if("ok").alias("n_good"), F.round(F.sum("prediction"), 4).alias("total"),
                    F.count_if(~F.col("ok")).alias("n_bad"))


def _csv_round_trip(spark, sf):
    """Line items written as CSV and read back with their schema."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_extendedprice")
    path = shared_dir(spark, "csv")
    write_csv(items, path)
    back = read_csv(spark, path, items.schema)
    return back.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


def _optional(spark, sf):
    """Nations as an optional CSV table; where none is named there is none."""
    path = shared_dir(spark, "optional")
    write_csv(table(spark, sf, "nation"), path)
    if read_optional_csv(spark, None) is not None or read_optional_csv(spark, "") is not None:
        raise AssertionError("a table that is not named was read")
    return read_optional_csv(spark, path).groupBy(F.col("n_regionkey").cast("long").alias("region")).agg(
        F.count("*").alias("n"), F.max("n_name").alias("last"))


def _locations(spark, sf):
    """Where the tables of every customer segment would lie, in an object store and in a folder."""
    segments = sorted(r[0] for r in table(spark, sf, "customer").select("c_mktsegment").distinct().collect())
    store = {"storage": {"backend": "s3", "s3_bucket": "lake", "s3_prefix": "runs/"}}
    rows = [(s, uri(store, f"/raw/{s}.csv"), uri({}, f"raw/{s}.csv")) for s in segments]
    return small_table(spark, rows, "segment string, stored string, local string")


def _small_tables(spark, sf):
    """A parameter table written as one JSON file and read back, with and without its schema."""
    per_flag = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"))
    path = shared_dir(spark, "small")
    write_small(per_flag, path)
    back = read_small(spark, path, per_flag.schema)
    return back.join(read_small(spark, path).select("l_returnflag", F.col("most").alias("again")), "l_returnflag")


QUERIES = {
    "optional_table": _optional,
    "table_locations": _locations,
    "small_tables": _small_tables,
    "decode_requests": _decoded,
    "decode_rejects": lambda s, sf: decode_requests(_bodies(s, sf))[1],
    "encode_responses": _encoded,
    "impute_score": _imputed,
    "score_rejects": _rejected,
    "score_batch": _batch,
    "score_strict": _strict,
    "log_flatten": _log_flatten,
    "log_flatten_overwrite": _log_overwrite,
    "log_corrupt_lines": _log_text,
    "csv_round_trip": _csv_round_trip,
}

_K = "CAST(json_extract(props, '$.k') AS DOUBLE)"
_BONUS = "CASE WHEN event_type IN ('purchase', 'click', 'error') THEN CAST(user_id AS DOUBLE) END"

ORACLE = {
    "optional_table": "SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS n, max(n_name) AS last FROM nation GROUP BY 1",
    "table_locations": """SELECT DISTINCT c_mktsegment AS segment, 's3a://lake/runs/raw/' || c_mktsegment || '.csv' AS stored,
        'raw/' || c_mktsegment || '.csv' AS local FROM customer""",
    "small_tables": """SELECT l_returnflag, count(*) AS n, max(l_quantity) AS most, max(l_quantity) AS again FROM lineitem GROUP BY 1""",
    "decode_requests": f"""WITH e AS (SELECT event_id AS req_id, CASE WHEN event_id % 50000 = 17 THEN -1 ELSE event_id % 16 END AS s,
                                       value, {_K} AS k, user_id FROM events)
        SELECT req_id, 0 AS pos, 'value' AS name, value AS given FROM e WHERE s = 0
        UNION ALL SELECT req_id, 0, 'k', k FROM e WHERE s IN (0, 1, 2)
        UNION ALL SELECT req_id, 1, 'value', value FROM e WHERE s = 1
        UNION ALL SELECT req_id, 1, 'k', k FROM e WHERE s = 1
        UNION ALL SELECT req_id, 0, 'value', value FROM e WHERE s IN (3, 7)
        UNION ALL SELECT req_id, 0, 'user', CAST(user_id AS DOUBLE) FROM e WHERE s IN (3, 10, 14)
        UNION ALL SELECT req_id, 0, 'user, of page', CAST(user_id AS DOUBLE) FROM e WHERE s = 7
        UNION ALL SELECT req_id, 1, 'value', 1.5 FROM e WHERE s = 3
        UNION ALL SELECT req_id, 1, 'user', NULL FROM e WHERE s = 3
        UNION ALL SELECT req_id, 0, 'value', NULL FROM e WHERE s = 10
        UNION ALL SELECT req_id, 0, 'value' || chr(10) || 'of "page"', 1.5 FROM e WHERE s = 14
        UNION ALL SELECT req_id, 0, 'c' || i, CAST(i AS DOUBLE) FROM e, (SELECT unnest(range(1, 20001)) AS i) WHERE s = -1""",
    "decode_rejects": """WITH e AS (SELECT *, CASE WHEN event_id % 50000 = 17 THEN -1 ELSE event_id % 16 END AS s FROM events)
        SELECT event_id AS req_id,
        CASE WHEN s = 4 THEN 'text/plain' WHEN s IN (5, 12, 13) THEN 'application/json' ELSE 'text/csv' END AS content_type,
        CASE s WHEN 4 THEN props WHEN 5 THEN '{"features": {"user": "u' || user_id || '"}}'
             WHEN 6 THEN 'value,user' || chr(10) || '1.5,' || user_id || ',7' || chr(10)
             WHEN 8 THEN 'user,user' || chr(10) || '1,' || user_id || chr(10)
             WHEN 9 THEN 'value,user' || chr(10) || 'low,' || user_id || chr(10)
             WHEN 11 THEN 'value,user' || chr(10) || '2d,' || user_id || chr(10)
             WHEN 12 THEN '{"features": {"user": "' || user_id || '"}}'
             WHEN 13 THEN '{"user": true, "value": ' || value || '}'
             ELSE '"value,user' || chr(10) || '1.5,' || user_id || chr(10) END AS body,
        CASE s WHEN 4 THEN 'content type not served: text/plain' WHEN 6 THEN 'a line has another number of cells than the header'
             WHEN 8 THEN 'a column name is repeated' WHEN 9 THEN 'a cell is no number' WHEN 11 THEN 'a cell is no number'
             WHEN 15 THEN 'a quote is not closed' ELSE 'features are no map of numbers' END AS reason
        FROM e WHERE s IN (4, 5, 6, 8, 9, 11, 12, 13, 15)""",
    "encode_responses": """SELECT event_id AS req_id,
        CASE event_type WHEN 'click' THEN 'text/csv' WHEN 'error' THEN 'rejected' ELSE 'application/json' END AS content_type,
        CASE event_type WHEN 'click' THEN CAST(value AS VARCHAR) || chr(10) || CAST(value * 2 AS VARCHAR)
             WHEN 'error' THEN 'accept type not served: text/html'
             ELSE '{"predictions":[' || CAST(value AS VARCHAR) || ',' || CAST(value * 2 AS VARCHAR) || ']}' END AS body
        FROM events""",
    "impute_score": f"""WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events)
        SELECT CAST(event_id AS VARCHAR) AS request_id,
               round(3.0 + {_K} * 0.5 + CASE WHEN event_type = 'error' THEN med ELSE value END * 2.0 - user_id, 6) AS prediction,
               'linear' AS model_type, 3 AS n_features,
               CASE WHEN event_type = 'error' THEN 'value' ELSE '' END AS imputed_features
        FROM events, m WHERE event_type IN ('purchase', 'click', 'error')""",
    "score_rejects": """SELECT CAST(event_id AS VARCHAR) AS request_id, event_type,
        'no value and no median for feature ''bonus''' AS reason
        FROM events WHERE event_type NOT IN ('purchase', 'click', 'error')""",
    "score_batch": f"""SELECT CAST(event_id AS VARCHAR) AS request_id, round(3.0 + {_K} * 0.5
        + CASE WHEN event_type <> 'error' THEN value END * 2.0 - {_BONUS}, 6) AS prediction, 3 AS n_features FROM events""",
    "score_strict": f"""SELECT CAST(event_id AS VARCHAR) AS request_id,
        round(3.0 + {_K} * 0.5 + value * 2.0 - user_id, 6) AS prediction FROM events""",
    "log_flatten": f"""WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events),
        v AS (SELECT *, {_K} AS k, CAST(user_id AS DOUBLE) AS bonus,
                     CASE WHEN event_type = 'error' THEN med ELSE value END AS v FROM events, m
              WHERE event_type IN ('purchase', 'click', 'error'))
        SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(event_id AS VARCHAR) AS request_id, 3 AS n_features,
               round(3.0 + k * 0.5 + v * 2.0 - bonus, 6) AS prediction, bonus, k, round(v, 6) AS value FROM v""",
    "log_flatten_overwrite": """SELECT CAST(event_id AS VARCHAR) AS request_id,
        round(CASE WHEN event_type = 'view' THEN value ELSE value + 1 END, 6) AS prediction,
        CASE WHEN event_type <> 'view' THEN value END AS k FROM events""",
    "csv_round_trip": """SELECT l_returnflag, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys,
        round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1""",
    "log_corrupt_lines": """SELECT count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS n_good,
        round(sum(value) FILTER (WHERE event_type NOT IN ('error', 'signup')), 4) AS total,
        count(*) FILTER (WHERE event_type = 'error') AS n_bad FROM events""",
}
