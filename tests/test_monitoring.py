"""Drift laws and statistics, scoring, codecs, logs, streams, alarms."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators.drift import drift_summary, ks_drift, ks_statistics, ranked
from tabloom.operators.linear import LinearModel
from tabloom.operators.scoring import score_batch, score_requests, score_strict
from tabloom.operators.windowed_drift import rank_reference, windowed_drift
from tabloom.sources.codec import decode_requests, encode_responses
from tabloom.sources.prediction_log import append_log, flatten, log_records, read_log
from tabloom.streaming import windows
from tabloom.streaming.alarms import alarm_states
from tabloom.streaming.scorer import append_json, append_scores, scored_log
from tabloom.streaming.windows import read_stream, run_to_table, value_counts, window_summary

T0 = dt.datetime(2024, 1, 1)


def distance(a, b):
    points = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max()


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def test_statistic_matches_numpy(spark):
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=4000), rng.normal(0.05, 1, size=3000)
    ties_a, ties_b = rng.integers(0, 6, 4000), rng.integers(0, 6, 3000)
    hot_a, hot_b = np.where(rng.random(4000) < 0.5, 3.0, a), np.where(rng.random(3000) < 0.4, 3.0, b)
    ref = frame(spark, x=a, t=ties_a, h=hot_a)
    new = frame(spark, x=b, t=ties_b, h=hot_b)
    got = {r["feature"]: r for r in ks_statistics(ref, new, ["x", "t", "h"]).collect()}
    for name, (u, v) in {"x": (a, b), "t": (ties_a, ties_b), "h": (hot_a, hot_b)}.items():
        assert got[name]["d"] == pytest.approx(distance(u.astype(float), v.astype(float)), abs=1e-12)
        assert (got[name]["n_ref"], got[name]["n_new"]) == (4000, 3000)


def test_drift_reports(spark):
    rng = np.random.default_rng(12)
    ref = frame(spark, mass=rng.normal(88, 10, 500), fie=rng.normal(6.5, 1.2, 500)).withColumn("text", F.lit("a"))
    same = frame(spark, fie=rng.normal(6.5, 1.2, 200), mass=rng.normal(88, 10, 200), other=np.zeros(200))
    report = ks_drift(ref, same)
    assert [r["feature"] for r in report.collect()] == ["mass", "fie"]
    shifted = frame(spark, mass=rng.normal(200, 10, 300), fie=rng.normal(6.5, 1.2, 300))
    rows = ks_drift(ref, shifted)
    assert {r["feature"]: r["drifted"] for r in rows.collect()}["mass"]
    s = drift_summary(rows).first()
    assert s["drift_detected"] and "mass" in s["drifted_features"] and s["n_features"] == 2
    assert ranked(rows).first()["feature"] == "mass"
    itself = ks_drift(ref, ref).collect()
    assert all(r["ks_statistic"] == 0 and r["p_value"] == 1 and not r["drifted"] for r in itself)


def test_drift_edge_cases(spark):
    ref = frame(spark, a=range(50), b=range(50))
    few = frame(spark, a=[1, 2, 3, 4, None], b=[1, 2, 3, 4, 5])
    assert [r["feature"] for r in ks_drift(ref, few).collect()] == ["b"]
    assert ks_drift(ref, frame(spark, zzz=[1.0])).count() == 0
    s = drift_summary(ks_drift(ref, frame(spark, zzz=[1.0]))).first()
    assert not s["drift_detected"] and s["n_features"] == 0
    with pytest.raises(ValueError, match="No reference values"):
        ks_drift(frame(spark, a=[None, None]), few, ["a"], min_new=1)


def test_windowed_drift_equals_one_test_per_window(spark):
    rng = np.random.default_rng(13)
    ref = rng.integers(0, 200, 3000).astype(float)
    windows = {0: rng.integers(0, 200, 400).astype(float), 1: rng.integers(50, 260, 300).astype(float), 2: np.array([5.0, 6.0])}

    def counts(values):
        v, n = np.unique(values, return_counts=True)
        return list(zip(v.tolist(), n.tolist()))

    ref_counts = spark.createDataFrame([("f", v, n) for v, n in counts(ref)], "feature string, value double, n bigint")
    new_counts = spark.createDataFrame(
        [(T0 + dt.timedelta(days=d), "f", v, n) for d, w in windows.items() for v, n in counts(w)],
        "window_start timestamp, feature string, value double, n bigint",
    )
    got = {r["window_start"].day: r for r in windowed_drift(ref_counts, new_counts).collect()}
    assert set(got) == {1, 2}
    for day in (1, 2):
        assert got[day]["ks_statistic"] == round(distance(ref, windows[day - 1]), 6)
    assert got[2]["drifted"]


MODEL = LinearModel(("a", "b"), (1.0, 10.0), 0.5)


def requests(spark):
    rows = [("r1", {"a": 1.0, "b": 2.0}), ("r2", {"b": 2.0}), ("r3", {"a": 1.0}), (None, {"a": 3.0, "b": 1.0, "zz": 9.0})]
    return spark.createDataFrame(rows, "request_id string, features map<string,double>")


def test_imputed_scoring(spark):
    scored, rejects = score_requests(requests(spark), ["a", "b"], {"a": 4.0}, MODEL.transform, "linear")
    rows = {r["request_id"]: r for r in scored.collect()}
    assert rows["r1"]["prediction"] == 21.5 and rows["r1"]["imputed_features"] == []
    assert rows["r2"]["prediction"] == 24.5 and rows["r2"]["imputed_features"] == ["a"]
    assert len(rows) == 3 and all(k is not None for k in rows) and rows["r2"]["n_features"] == 2
    bad = rejects.collect()
    assert [r["request_id"] for r in bad] == ["r3"] and "'b'" in bad[0]["reason"]


def test_strict_and_batch_scoring(spark):
    wide = spark.createDataFrame([(1.0, 2.0, "x")], "b double, a double, extra string")
    assert score_strict(wide, ["a", "b"], MODEL.transform).first()["prediction"] == 12.5
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        score_strict(wide.drop("a"), ["c", "a", "b"], MODEL.transform)
    rows = {r["request_id"]: r["prediction"] for r in score_batch(requests(spark), ["a", "b"], MODEL.transform).collect()}
    assert rows["r1"] == 21.5 and rows["r2"] is None
    with pytest.raises(ValueError, match=r"\['c'\]"):
        score_batch(requests(spark), ["a", "b", "c"], MODEL.transform)


def test_request_bodies(spark):
    fifteen = {f"f{i}": float(i) for i in range(1, 16)}
    rows = [
        (1, "application/json", json.dumps({"features": fifteen})),
        (2, "application/json", json.dumps({"instances": [{"a": 1}, {"a": 2, "b": 3.5}]})),
        (3, "application/json", json.dumps({"a": 7})),
        (4, "text/csv", "a,b\n1,2\n3,\n"),
        (5, "application/xml", "<a/>"),
        (6, "application/json", "{broken"),
        (7, "application/json", json.dumps({"instances": [{"a": 1}], "features": {"a": 5}})),
    ]
    good, bad = decode_requests(spark.createDataFrame(rows, "req_id int, content_type string, body string"))
    got = {(r["req_id"], r["pos"]): r["features"] for r in good.collect()}
    assert got[1, 0] == fifteen
    assert got[2, 0] == {"a": 1.0} and got[2, 1] == {"a": 2.0, "b": 3.5}
    assert got[3, 0] == {"a": 7.0} and got[4, 0] == {"a": 1.0, "b": 2.0} and got[4, 1] == {"a": 3.0, "b": None}
    assert got[7, 0] == {"a": 5.0}
    reasons = {r["req_id"]: r["reason"] for r in bad.collect()}
    assert set(reasons) == {5, 6} and "application/xml" in reasons[5]


def test_malformed_bodies_are_rejected(spark):
    rows = [
        (1, "application/json", '{"features": {"a": "x"}}'), (2, "application/json", '{"features": "x"}'), (3, "application/json", "[1, 2]"),
        (4, "application/json", '{"instances": [{"a": 1}, {"a": "no"}]}'), (5, "application/json", '{"a": 1, "a": 2}'), (6, "application/json", None),
        (11, "text/csv", "a,b\n1,2,3\n"), (12, "text/csv", "a,a\n1,2\n"), (13, "text/csv", "a,b\n1,two\n"), (14, "text/csv", "a,b\n"),
        (15, "text/csv", ""), (16, "text/csv", None), (21, "text/csv", '"a","b, c"\n"1",2\n'), (22, "application/json", '{"features": {"a": null}}'),
    ]
    good, bad = decode_requests(spark.createDataFrame(rows, "req_id int, content_type string, body string"))
    got = {r["req_id"]: r["features"] for r in good.collect()}
    assert got == {21: {"a": 1.0, "b, c": 2.0}, 22: {"a": None}}
    reasons = {r["req_id"]: r["reason"] for r in bad.collect()}
    assert set(reasons) == {1, 2, 3, 4, 5, 6, 11, 12, 13, 14, 15, 16} and all(reasons.values())
    assert reasons[11] != reasons[12] != reasons[13]


def test_bodies_that_no_parser_survives_by_luck(spark):
    """Very many cells, quotes, levels and digits; quoted line ends; words that look like numbers."""
    n, j, c = 20_000, "application/json", "text/csv"
    rows = [
        (1, c, ",".join(f'"c{i}"' for i in range(n)) + "\n" + ",".join(f'"{i}"' for i in range(n))), (2, c, '"' + '""' * n + '"\n1'),
        (3, c, '"a\nx","b""q",c\r\n"1"," -2.5 ",.5e1\r\n,NaN,nan'), (4, c, "a\n" + "5\n" * n), (5, c, '"a"\n""\n1'),
        (6, j, '{"a": 123456789012345678901234567890, "b": 1.10, "c": null}'), (7, j, "{}"),
        *[(10 + i, c, b) for i, b in enumerate([
            "a,b\n1,2d", "a,b\n1,Infinity", "a,b\n1,0x1", "a,b\n1,1e999", 'a,b\n"1,2', 'a,b\n1"2",3', 'a,b\n"1"x,3', "a\x1f\n1", "a,b\n1,1_000", "a\n1 2"])],
        *[(30 + i, j, b) for i, b in enumerate([
            '{"a": "5"}', '{"a": true}', '{"a": 1e999}', "[" * n, '{"a": ' * n, '{"a": ' + "9" * n + "}", '{"a": NaN}', '{"features": null}',
            '{"instances": [{"a": 1}, null]}', '{"instances": {"a": 1}}', '{"features": [1]}', '{"instances": [{"a": "2"}]}'])],
    ]
    good, bad = decode_requests(spark.createDataFrame(rows, "req_id int, content_type string, body string"))
    got = {}
    for r in good.collect():
        got.setdefault(r["req_id"], []).append(r["features"])
    assert got[1] == [{f"c{i}": float(i) for i in range(n)}] and got[2] == [{'"' * n: 1.0}]
    assert got[3] == [{"a\nx": 1.0, 'b"q': -2.5, "c": 5.0}, {"a\nx": None, 'b"q': None, "c": None}] and got[4] == [{"a": 5.0}] * n
    assert got[5] == [{"a": 1.0}] and got[6] == [{"a": 123456789012345678901234567890.0, "b": 1.1, "c": None}] and got[7] == [{}]
    reasons = {r["req_id"]: r["reason"] for r in bad.collect()}
    assert set(reasons) == {r[0] for r in rows if r[0] >= 10} and set(got) == {r[0] for r in rows if r[0] < 10}
    assert reasons[10] == reasons[11] == "a cell is no number" and reasons[14] == "a quote is not closed" and reasons[15] == "a quote inside a cell"


def test_nan_is_missing_when_scoring(spark):
    df = spark.createDataFrame([("r", {"a": float("nan"), "b": 2.0})], "request_id string, features map<string,double>")
    scored, rejects = score_requests(df, ["a", "b"], {"a": 4.0}, MODEL.transform)
    row = scored.first()
    assert row["a"] == 4.0 and row["imputed_features"] == ["a"] and rejects.count() == 0
    scored, rejects = score_requests(df, ["a", "b"], {}, MODEL.transform)
    assert scored.count() == 0 and "'a'" in rejects.first()["reason"]


def test_response_bodies(spark):
    rows = [(1, 1, "*/*", 2.5), (1, 0, "*/*", 1.0), (2, 0, "text/csv", 3.0), (2, 1, "text/csv", 4.25), (3, 0, "image/png", 1.0)]
    good, bad = encode_responses(spark.createDataFrame(rows, "req_id int, pos int, accept string, prediction double"))
    got = {r["req_id"]: (r["content_type"], r["body"]) for r in good.collect()}
    assert json.loads(got[1][1]) == {"predictions": [1.0, 2.5]} and got[1][0] == "application/json"
    assert got[2] == ("text/csv", "3.0\n4.25")
    assert [r["req_id"] for r in bad.collect()] == [3]


def test_log_round_trip(spark, tmp_path):
    scored, _ = score_requests(requests(spark), ["a", "b"], {"a": 4.0, "b": 0.0}, MODEL.transform, "linear")
    records = log_records(scored, ["a", "b"])
    path = str(tmp_path / "log")
    append_log(records, path, max_records=1)
    append_log(records, path)
    log = read_log(spark, path)
    assert log.count() == 8
    flat = flatten(log)
    assert {"a", "b", "prediction", "request_id"} <= set(flat.columns)
    assert flat.where("request_id = 'r2'").first()["a"] == 4.0
    assert ks_drift(frame(spark, a=[4.0] * 9, b=range(9)), flat).count() == 2


def test_broken_lines_stay_out_of_the_log(spark, tmp_path):
    good = '{"timestamp":"2024-01-01T00:00:00.000Z","request_id":"r","model_type":"m","n_features":1,"prediction":2.5,"features":{"a":1.0}}'
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part.json").write_text(f"{good}\n\n{{broken\n{good}\n")
    rows = read_log(spark, str(tmp_path / "log")).collect()
    assert [r["prediction"] for r in rows] == [2.5, 2.5]


def test_one_file_a_day_and_task(spark, tmp_path):
    scored, _ = score_requests(requests(spark), ["a", "b"], {"a": 4.0, "b": 0.0}, MODEL.transform, "linear")
    append_log(log_records(scored.repartition(4), ["a", "b"]), str(tmp_path / "log"), tasks_per_day=1)
    assert len(list((tmp_path / "log").glob("date=*/part-*"))) == 1


def events(spark, n, path, name):
    rows = [(T0 + dt.timedelta(minutes=i), float(i % 7), f"e{i}") for i in range(*n)]
    spark.createDataFrame(rows, "ts timestamp, value double, id string").coalesce(1).write.mode("append").parquet(str(path / name))


def test_closed_windows_survive_a_restart(spark, tmp_path):
    """Two runs over one growing folder give what a batch query gives for the closed windows."""
    source, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    schema = "ts timestamp, value double, id string"
    for part in ((0, 300), (300, 700)):
        events(spark, part, source, ".")
        stream = value_counts(read_stream(spark, str(source), schema), "ts", ["value"], "1 hour", "10 minutes")
        counts = run_to_table(stream, table, state)
    got = {tuple(r) for r in counts.collect()}
    batch = value_counts(spark.read.schema(schema).parquet(str(source)), "ts", ["value"], "1 hour", "10 minutes")
    last = T0 + dt.timedelta(minutes=699 - 10)
    want = {tuple(r) for r in batch.collect() if r["window_start"] + dt.timedelta(hours=1) <= last}
    assert got == want and len({w for w, *_ in got}) == 11
    s = window_summary(counts).orderBy("window_start").first()
    values = [i % 7 for i in range(60)]
    assert (s["n"], s["p50"]) == (60, np.quantile(values, 0.5))


def test_reference_is_ranked_once_for_all_batches(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", tmp_path / "out"
    for part in ((0, 240), (240, 480), (480, 720)):
        events(spark, part, source, ".")
    calls = []
    monkeypatch.setattr(windows, "rank_reference", lambda counts: calls.append(1) or rank_reference(counts))
    reference = spark.createDataFrame([("value", float(v), 10) for v in range(5)], "feature string, value double, n bigint")
    stream = read_stream(spark, str(source), "ts timestamp, value double, id string", files_per_batch=1)
    counts = value_counts(stream, "ts", ["value"], "1 hour", "10 minutes")
    windows.drift_stream(counts, reference, str(out), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(out)).collect()
    assert len(calls) == 1 and len(list(out.glob("batch_id=*"))) > 1
    assert len({r["window_start"] for r in rows}) == len(rows) == 11
    assert all(r["ks_statistic"] == round(distance(np.repeat(np.arange(5.0), 10), np.arange(60) % 7.0), 6) or r["n_new"] == 60 for r in rows)


def test_scorer_keeps_its_rejects(spark, tmp_path):
    source = str(tmp_path / "in")
    requests(spark).withColumn("timestamp", F.lit(T0)).write.json(source)
    stream = read_stream(spark, source, "timestamp timestamp, request_id string, features map<string,double>", "json")
    append_scores(
        stream, ["a", "b"], {"a": 4.0}, MODEL.transform, str(tmp_path / "log"), str(tmp_path / "bad"), str(tmp_path / "state"), "linear",
    ).awaitTermination()
    assert spark.read.json(str(tmp_path / "log")).count() == 3
    bad = spark.read.json(str(tmp_path / "bad")).collect()
    assert [r["request_id"] for r in bad] == ["r3"] and "'b'" in bad[0]["reason"]


def test_streamed_scores_reach_the_log(spark, tmp_path):
    source = str(tmp_path / "in")
    requests(spark).withColumn("timestamp", F.lit(T0)).write.json(source)
    stream = read_stream(spark, source, "timestamp timestamp, request_id string, features map<string,double>", "json")
    records, _ = scored_log(stream, ["a", "b"], {"a": 4.0}, MODEL.transform, "linear")
    append_json(records, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    rows = {r["request_id"]: r for r in read_log(spark, str(tmp_path / "log")).collect()}
    assert len(rows) == 3 and rows["r2"]["prediction"] == 24.5 and rows["r2"]["features"] == {"a": 4.0, "b": 2.0}


def test_alarm_needs_an_unbroken_run(spark):
    at = [0, 1, 2, 3, 5, 6, 7, 8]  # minute 4 has no data
    hits = [9, 9, 9, 9, 9, 9, 1, 9]
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=a), h) for a, h in zip(at, hits)], "window_start timestamp, hits int")
    rows = alarm_states(df, F.col("hits") > 5, 3).orderBy("window_start").collect()
    assert [r["alarm"] for r in rows] == [False, False, True, True, False, False, False, False]
    two = alarm_states(df, F.col("hits") > 5, 2).orderBy("window_start").collect()
    assert [r["alarm"] for r in two] == [False, True, True, True, False, True, False, False]
