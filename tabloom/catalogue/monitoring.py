"""Queries on drift, streams, alarms and capture."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalogue.data import FEATURES, LINE_SQL, events, lines, rounded
from tabloom.catalogue.serving import EXPECTED, MODEL, _log, _requests
from tabloom.operators.drift import drift_summary, ks_drift, ranked
from tabloom.operators.profile import medians_dict, training_medians
from tabloom.session import materialise, rocksdb_state, shared_dir
from tabloom.sources.prediction_log import SCHEMA, flatten
from tabloom.streaming.alarms import error_alarm, latency_alarm, live_alarms
from tabloom.streaming.scorer import append_json, append_scores, captured, captured_pairs, scored_log
from tabloom.streaming.windows import (
    closed_series,
    drift_stream,
    event_counts,
    read_stream,
    run_to_table,
    sketched_ks,
    sketched_quantile,
    sketched_windows,
    timed_counts,
    value_counts,
    window_summary,
)

HALF = "2024-01-16 00:00:00"
ALPHA = 0.05


def _halves(spark, sf):
    e = events(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    e = e.select("ts", "value", "k", "user_id")
    first, second = e.where(F.col("ts") < HALF), e.where(F.col("ts") >= HALF)
    return first.drop("ts"), second.drop("ts")


def _by_flag(spark, sf):
    df = lines(spark, sf).select("l_returnflag", *FEATURES)
    # a column that has moved, next to those that have not
    moved = df.withColumn("gross", F.when(F.col("l_returnflag") == "A", F.col("gross") * 1.1).otherwise(F.col("gross")))
    return moved.where("l_returnflag <> 'A'"), moved.where("l_returnflag = 'A'")


def _flag_report(spark, sf):
    return ks_drift(*_by_flag(spark, sf))


def _few_new(spark, sf):
    """A feature with too few new values is left out of the report."""
    first, second = _halves(spark, sf)
    few = F.when(F.col("user_id") % 997 == 1, F.col("value"))
    reference = first.select("value", "user_id")
    new = second.select(F.when(few.isNotNull() & (F.col("value") < 0), few).alias("value"), "user_id")
    return ks_drift(reference, new)


def _self_check(spark, sf):
    df = events(spark, sf).select("value", "user_id")
    return ks_drift(df, df)


def _log_drift(spark, sf):
    """The prediction log against the raw events; only shared numeric columns are tested."""
    reference = events(spark, sf).select("value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return ks_drift(reference, flatten(_log(spark, sf), EXPECTED))


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return read_stream(spark, sf, schema, "parquet", "events.parquet")


def _at(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _counts_table(spark, sf, width):
    stream = value_counts(_event_stream(spark, sf), "ts", ["value"], width)
    return run_to_table(stream, shared_dir(spark, "counts"), shared_dir(spark, "counts-state"))


def _stream_summary(spark, sf):
    out = window_summary(_counts_table(spark, sf, "1 day"))
    return rounded(out.withColumn("window_start", _at("window_start")))


def _stream_drift(spark, sf):
    """Each closed day of events against all events."""
    totals = events(spark, sf).groupBy(F.lit("value").alias("feature"), "value").agg(F.count("*").alias("n"))
    reference = materialise(totals, "reference")
    counts = value_counts(_event_stream(spark, sf), "ts", ["value"], "1 day")
    path = shared_dir(spark, "drift")
    drift_stream(counts, reference, path, shared_dir(spark, "drift-state")).awaitTermination()
    schema = "window_start timestamp, feature string, n_new bigint, ks_statistic double, p_value double, drifted boolean"
    return spark.read.schema(schema).parquet(path).withColumn("window_start", _at("window_start")).drop("batch_id")


def _alarm_p99(spark, sf):
    summary = materialise(window_summary(_counts_table(spark, sf, "1 hour"), {"p99": 0.99}), "latency")
    out = latency_alarm(summary, 25.0, 3, 3600)
    return rounded(out.select(_at("window_start"), "n", "p99", "breach", "alarm"))


def _alarm_errors(spark, sf):
    stream = event_counts(_event_stream(spark, sf), "ts", F.col("event_type") == "error", "1 hour")
    counts = run_to_table(stream, shared_dir(spark, "errors"), shared_dir(spark, "errors-state"))
    return error_alarm(counts, 3, 2, 3600).withColumn("window_start", _at("window_start"))


def _stream_scorer(spark, sf):
    """Requests read as a stream, scored and appended to the log."""
    medians = medians_dict(training_medians(events(spark, sf), ["value"]))
    source = shared_dir(spark, "requests")
    _requests(spark, sf).write.json(source)
    schema = "timestamp timestamp, request_id string, event_type string, features map<string,double>"
    records, _ = scored_log(read_stream(spark, source, schema, "json"), EXPECTED, medians, MODEL.transform, "linear")
    path = shared_dir(spark, "scored-log")
    append_json(records, path, shared_dir(spark, "scored-state")).awaitTermination()
    log = spark.read.schema(SCHEMA).json(path)
    return rounded(flatten(log, EXPECTED).select("request_id", "model_type", "n_features", "prediction", *EXPECTED))


def _stream_rejects(spark, sf):
    """Requests of a stream that cannot be scored, kept with their reason."""
    medians = medians_dict(training_medians(events(spark, sf), ["value"]))
    source, bad = shared_dir(spark, "requests"), shared_dir(spark, "rejects")
    _requests(spark, sf).write.json(source)
    schema = "timestamp timestamp, request_id string, event_type string, features map<string,double>"
    append_scores(
        read_stream(spark, source, schema, "json"), EXPECTED, medians, MODEL.transform, shared_dir(spark, "scored"), bad,
        shared_dir(spark, "scored-state"), "linear",
    ).awaitTermination()
    return spark.read.schema("request_id string, event_type string, reason string").json(bad).select("request_id", "event_type", "reason")


def _capture(spark, sf):
    stream = captured(_event_stream(spark, sf), "event_id", 40.0).select("event_id", "value")
    return run_to_table(stream, shared_dir(spark, "capture"), shared_dir(spark, "capture-state"))


def _live(spark, sf, closed, limit, run):
    """The stream in several micro-batches, one file each; rows as their micro-batch wrote them."""
    stream = live_alarms(closed, limit, run, 3600)
    with rocksdb_state(spark):
        return run_to_table(stream, shared_dir(spark, "live"), shared_dir(spark, "live-state"))


def _by_day(spark, sf):
    """The events as a stream of one file per five days, in order of time; a micro-batch reads one file."""
    path = shared_dir(spark, "by-day")
    e = events(spark, sf).where("ts IS NOT NULL").withColumn("part", F.floor(F.dayofmonth("ts") / 5).cast("int"))  # no time, no window
    for part in sorted(r[0] for r in e.select("part").distinct().collect()):  # at most seven
        e.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(path)
    return read_stream(spark, path, events(spark, sf).schema, "parquet", files_per_batch=1)


def _live_errors(spark, sf):
    counts = timed_counts(_by_day(spark, sf), "ts", F.col("event_type") == "error", "1 hour")
    return _live(spark, sf, closed_series(counts, F.lit("errors"), F.col("hits")), 3.0, 2).select(
        "series", _at("window_start"), "value", "run", "alarm")


def _live_p99(spark, sf):
    """Alarms on the sketched 99th percentile: against the exact table form, only windows near the limit may differ."""
    windows = sketched_windows(_by_day(spark, sf), "ts", ["value"], "1 hour")
    live = _live(spark, sf, closed_series(windows, F.col("feature"), sketched_quantile("sketch", 0.99)), 25.0, 3)
    return live.agg(F.count("*").alias("n_windows"), F.count_if("alarm").alias("n_alarms"))


def _sketched_summary(spark, sf):
    """Days from bounded state: counts, means and ends are exact, the median is right up to a share of the ranks."""
    windows = sketched_windows(_event_stream(spark, sf), "ts", ["value"], "1 day")
    kept = run_to_table(windows, shared_dir(spark, "sketched"), shared_dir(spark, "sketched-state"))
    day = F.date_trunc("day", "ts").alias("window_start")
    median = kept.select("window_start", sketched_quantile("sketch", 0.5).alias("p50"))
    ranks = events(spark, sf).select(day, "value").join(median, "window_start").groupBy("window_start").agg(
        (F.count_if(F.col("value") <= F.col("p50")) / F.count("*")).alias("r"))
    out = kept.join(ranks, "window_start").select(
        _at("window_start"), "feature", "n", "mean", "min", "max", (F.abs(F.col("r") - 0.5) < 0.02).alias("median_close"))
    return rounded(out)


def _sketched_drift(spark, sf):
    """The largest gap between a day and all events, from sketches: within three hundredths of the exact one."""
    reference = events(spark, sf).agg(F.kll_sketch_agg_double("value", F.lit(2000)).alias("sketch")).withColumn("feature", F.lit("value"))
    windows = run_to_table(
        sketched_windows(_event_stream(spark, sf), "ts", ["value"], "1 day"), shared_dir(spark, "sketched"), shared_dir(spark, "sketched-state"))
    exact = _stream_drift(spark, sf).select("window_start", F.col("ks_statistic").alias("exact"))
    near = sketched_ks(windows, reference).withColumn("window_start", _at("window_start")).join(exact, "window_start")
    return near.select("window_start", "n", (F.abs(F.col("ks_statistic") - F.col("exact")) < 0.03).alias("close"))


def _pairs(spark, sf):
    """Requests and responses as two streams: answers in time, too late, and none."""
    e = events(spark, sf).select(F.col("event_id").alias("request_id"), F.col("ts").alias("asked_at"), "value", "user_id")
    asked, answered = shared_dir(spark, "asked"), shared_dir(spark, "answered")
    e.write.parquet(asked)
    minutes = F.when(F.col("request_id") % 11 == 0, 60).otherwise(F.col("request_id") % 10)
    late = (F.col("asked_at") + F.make_interval(mins=minutes)).alias("answered_at")
    e.where("request_id % 7 <> 3").select("request_id", late, (F.col("value") * 2).alias("prediction")).write.parquet(answered)
    inputs = read_stream(spark, asked, "request_id long, asked_at timestamp, value double, user_id long")
    outputs = read_stream(spark, answered, "request_id long, answered_at timestamp, prediction double")
    pairs = captured_pairs(inputs, outputs, "10 minutes", percentage=60.0)
    kept = run_to_table(pairs, shared_dir(spark, "pairs"), shared_dir(spark, "pairs-state"))
    return kept.select("request_id", "value", "prediction", F.date_format("answered_at", "yyyy-MM-dd HH:mm:ss").alias("answered_at"))


QUERIES = {
    "ks_drift": lambda s, sf: ks_drift(*_halves(s, sf)),
    "drift_by_flag": _flag_report,
    "drift_report": lambda s, sf: drift_summary(_flag_report(s, sf)).withColumn(
        "drifted_features", F.array_join("drifted_features", ",")),
    "drift_ranked": lambda s, sf: ranked(_flag_report(s, sf)),
    "drift_self": _self_check,
    "drift_few_new": _few_new,
    "drift_over_log": _log_drift,
    "stream_summary": _stream_summary,
    "stream_drift": _stream_drift,
    "alarm_p99": _alarm_p99,
    "alarm_errors": _alarm_errors,
    "stream_scorer": _stream_scorer,
    "stream_rejects": _stream_rejects,
    "capture_sample": _capture,
    "alarm_errors_live": _live_errors,
    "alarm_p99_live": _live_p99,
    "stream_sketch_summary": _sketched_summary,
    "stream_sketch_drift": _sketched_drift,
    "capture_pairs": _pairs,
}


def _ks(values: str, by: str = "") -> str:
    """CTE body: KS rows of `(by, feature, side, value)` with side 0 reference, 1 new."""
    part = f"{by}feature"
    x = "d * sqrt(CAST(n AS DOUBLE) * m / (n + m))"
    return f"""
      SELECT {part}, m AS n_new, round(d, 6) AS ks_statistic, round(p, 6) AS p_value, p < {ALPHA} AS drifted FROM (
        SELECT *, CASE WHEN {x} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101),
            lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * ({x}) * ({x})))))) END AS p
        FROM (SELECT {part}, max(n) AS n, max(m) AS m, max(abs(cr / n - cq / m)) AS d FROM (
          SELECT {part}, value, n, m,
                 CAST(sum(r) OVER w AS DOUBLE) AS cr, CAST(sum(q) OVER w AS DOUBLE) AS cq
          FROM (SELECT {part}, value, r, q, CAST(sum(r) OVER (PARTITION BY {part}) AS BIGINT) AS n,
                       CAST(sum(q) OVER (PARTITION BY {part}) AS BIGINT) AS m
                FROM (SELECT {part}, value, sum(1 - side) AS r, sum(side) AS q FROM {values} GROUP BY {part}, value))
          WINDOW w AS (PARTITION BY {part} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
          GROUP BY {part}))"""


_K = "CAST(json_extract(props, '$.k') AS DOUBLE)"
_HALVES_SQL = f"""v AS (
    SELECT 'value' AS feature, CAST(ts >= TIMESTAMP '{HALF}' AS INT) AS side, value FROM events
    UNION ALL SELECT 'k', CAST(ts >= TIMESTAMP '{HALF}' AS INT), {_K} FROM events
    UNION ALL SELECT 'user_id', CAST(ts >= TIMESTAMP '{HALF}' AS INT), CAST(user_id AS DOUBLE) FROM events)"""
_FLAG_SQL = "v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(l_returnflag = 'A' AS INT) AS side, "
    + (f"CASE WHEN l_returnflag = 'A' THEN {c} * 1.1 ELSE {c} END" if c == "gross" else c) + " AS value FROM f"
    for c in FEATURES
) + ")"
_REPORT = "feature, ks_statistic, p_value, drifted"
_FLAG_KS = f"WITH {LINE_SQL}, {_FLAG_SQL}, k AS ({_ks('v')})"
_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _alarm(source: str, run: int, step: str) -> str:
    """Breaching windows whose run - 1 predecessors all breach, by counting neighbours."""
    return f"""coalesce(breach AND (SELECT count(*) FROM {source} b WHERE b.breach
        AND b.w <= a.w AND b.w > a.w - INTERVAL {run} {step}) = {run}, false)"""


ORACLE = {
    "ks_drift": f"WITH {_HALVES_SQL}, k AS ({_ks('v')}) SELECT {_REPORT} FROM k",
    "drift_by_flag": f"{_FLAG_KS} SELECT {_REPORT} FROM k",
    "drift_report": f"""{_FLAG_KS} SELECT CAST({ALPHA} AS DOUBLE) AS significance_level, bool_or(drifted) AS drift_detected,
        count(*) FILTER (WHERE drifted) AS n_features_drifted, count(*) AS n_features,
        coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features FROM k""",
    "drift_ranked": f"{_FLAG_KS} SELECT {_REPORT} FROM k",
    "drift_self": """SELECT 'value' AS feature, CAST(0 AS DOUBLE) AS ks_statistic, CAST(1 AS DOUBLE) AS p_value, false AS drifted
        FROM events HAVING count(*) >= 5
        UNION ALL SELECT 'user_id', 0.0, 1.0, false FROM events HAVING count(*) >= 5""",
    "drift_few_new": f"""WITH v AS (SELECT 'user_id' AS feature, CAST(ts >= TIMESTAMP '{HALF}' AS INT) AS side,
          CAST(user_id AS DOUBLE) AS value FROM events), k AS ({_ks('v')}) SELECT {_REPORT} FROM k""",
    "drift_over_log": f"""WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events),
        v AS (SELECT 'value' AS feature, 0 AS side, value FROM events UNION ALL SELECT 'k', 0, {_K} FROM events
          UNION ALL SELECT 'value', 1, CASE WHEN event_type = 'error' THEN med ELSE value END FROM events, m
                    WHERE event_type IN ('purchase', 'click', 'error')
          UNION ALL SELECT 'k', 1, {_K} FROM events WHERE event_type IN ('purchase', 'click', 'error')),
        k AS ({_ks('v')}) SELECT {_REPORT} FROM k""",
    "stream_summary": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, 'value' AS feature,
        count(*) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
        round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
        round(quantile_cont(value, 0.75), 6) AS p75
        FROM events GROUP BY date_trunc('day', ts)
        HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {_CLOSED}""",
    "stream_drift": f"""WITH w AS (SELECT DISTINCT date_trunc('day', ts) AS window_start FROM events
          WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {_CLOSED}),
        v AS (SELECT window_start, 'value' AS feature, 0 AS side, value FROM w, events
          UNION ALL SELECT window_start, 'value', 1, value FROM w JOIN events ON date_trunc('day', ts) = window_start),
        k AS ({_ks('v', 'window_start, ')})
        SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, feature, n_new, ks_statistic, p_value, drifted
        FROM k WHERE n_new >= 5""",
    "alarm_p99": f"""WITH h AS (SELECT date_trunc('hour', ts) AS w, count(*) AS n, quantile_cont(value, 0.99) AS p99
          FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}),
        a AS (SELECT *, p99 > 25.0 AS breach FROM h)
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, round(p99, 6) AS p99, breach,
               {_alarm('a', 3, 'HOUR')} AS alarm FROM a""",
    "alarm_errors": f"""WITH h AS (SELECT date_trunc('hour', ts) AS w, count(*) AS events,
          count(*) FILTER (WHERE event_type = 'error') AS hits
          FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}),
        a AS (SELECT *, hits > 3 AS breach FROM h)
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, events, hits, breach, {_alarm('a', 2, 'HOUR')} AS alarm FROM a""",
    "stream_scorer": f"""WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events),
        v AS (SELECT event_id, {_K} AS k, CASE WHEN event_type = 'error' THEN med ELSE value END AS value,
                     CAST(user_id AS DOUBLE) AS bonus FROM events, m WHERE event_type IN ('purchase', 'click', 'error'))
        SELECT CAST(event_id AS VARCHAR) AS request_id, 'linear' AS model_type, 3 AS n_features,
               round(3.0 + k * 0.5 + value * 2.0 - bonus, 6) AS prediction, k, round(value, 6) AS value, bonus FROM v""",
    "stream_rejects": """SELECT CAST(event_id AS VARCHAR) AS request_id, event_type,
        'no value and no median for feature ''bonus''' AS reason
        FROM events WHERE event_type NOT IN ('purchase', 'click', 'error')""",
    "capture_sample": """SELECT event_id, value FROM events
        WHERE substr(md5(concat_ws(':', '0', CAST(event_id AS VARCHAR))), 1, 8) < '66666666'""",
    "alarm_errors_live": f"""WITH h AS (SELECT date_trunc('hour', ts) AS w, count(*) FILTER (WHERE event_type = 'error') AS hits
          FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}),
        a AS (SELECT *, hits > 3 AS breach FROM h),
        b AS (SELECT *, sum(CASE WHEN NOT breach OR p IS NULL OR p <> w - INTERVAL 1 HOUR THEN 1 ELSE 0 END) OVER (ORDER BY w) AS block
              FROM (SELECT *, lag(w) OVER (ORDER BY w) AS p FROM a))
        SELECT 'errors' AS series, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(hits AS DOUBLE) AS value,
               CAST(sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER (PARTITION BY block ORDER BY w) AS INT) AS run,
               sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER (PARTITION BY block ORDER BY w) >= 2 AND breach AS alarm FROM b""",
    "alarm_p99_live": f"""WITH h AS (SELECT date_trunc('hour', ts) AS w, quantile_disc(value, 0.99) AS p99
          FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_CLOSED}),
        a AS (SELECT *, p99 > 25.0 AS breach FROM h)
        SELECT count(*) AS n_windows, count(*) FILTER (WHERE {_alarm('a', 3, 'HOUR')}) AS n_alarms FROM a""",
    "stream_sketch_summary": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, 'value' AS feature,
        count(*) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max, true AS median_close
        FROM events GROUP BY date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {_CLOSED}""",
    "stream_sketch_drift": f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, true AS close
        FROM events GROUP BY date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {_CLOSED}""",
    "capture_pairs": """WITH e AS (SELECT event_id AS request_id, ts, value, CASE WHEN event_id % 11 = 0 THEN 60 ELSE event_id % 10 END AS m
          FROM events WHERE substr(md5(concat_ws(':', '0', CAST(event_id AS VARCHAR))), 1, 8) < '99999999'),
        t AS (SELECT least(max(ts), max(ts + to_minutes(m)) FILTER (WHERE request_id % 7 <> 3)) - INTERVAL 1 HOUR AS mark FROM e)
        SELECT request_id, value, CASE WHEN ok THEN value * 2 END AS prediction,
               CASE WHEN ok THEN strftime(ts + to_minutes(m), '%Y-%m-%d %H:%M:%S') END AS answered_at
        FROM (SELECT *, request_id % 7 <> 3 AND m <= 10 AS ok FROM e), t WHERE ok OR ts + INTERVAL 10 MINUTE < mark""",
}
