"""Alarms as stream state, bounded windows, captured pairs, nearest-neighbour information, tied keys of the exact split."""

import datetime as dt
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.catalogue.monitoring import _live_errors, _live_p99
from tabloom.operators.binning import category_table, one_hot_vector
from tabloom.operators.neighbour_info import digamma, nearest, neighbour_information
from tabloom.operators.split import with_exact_split
from tabloom.session import ROCKSDB, STATE_STORE
from tabloom.streaming import windows
from tabloom.streaming.alarms import alarm_states, live_alarms
from tabloom.streaming.scorer import captured_pairs

START = dt.datetime(2024, 3, 1)


def minutes(*at):
    return [START + dt.timedelta(minutes=m) for m in at]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Files in order of time, a few minutes each, with hits per minute; some minutes have no rows at all."""
    path = str(tmp_path_factory.mktemp("feed"))
    hits = [0, 4, 5, 0, 6, 6, 6, None, 6, 6, None, None, 3, 9, 9, 9, 9, 0, 1, 7, 7, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    rows = [(t, "e" if k < n else "ok", float(k)) for m, n in enumerate(hits) if n is not None for k in range(n + 1) for t in minutes(m + k / 20)]
    schema = "ts timestamp, kind string, value double"
    for part in range(0, len(hits), 4):
        own = [r for r in rows if part <= (r[0] - START).total_seconds() / 60 < part + 4]
        if own:
            spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(path)
    return path, schema


def test_live_alarms_equal_the_table_form(spark, feed, tmp_path):
    path, schema = feed

    def counts(df):
        return windows.timed_counts(df, "ts", F.col("kind") == "e", "1 minute", "1 minute")

    stream = windows.read_stream(spark, path, schema, files_per_batch=1)
    closed = windows.closed_series(counts(stream), F.lit("s"), F.col("hits"))
    seen = []

    def note(batch, batch_id):
        seen.append({(r["window_start"], r["run"], r["alarm"]) for r in batch.collect()})

    query = live_alarms(closed, 5.0, 2, 60).writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {w: alarm for part in seen for w, _, alarm in part}
    table = alarm_states(counts(spark.read.schema(schema).parquet(path)).select("window_start", "hits"), F.col("hits") > 5, 2, 60)
    want = {r["window_start"]: r["alarm"] for r in table.collect()}
    assert len(got) >= len(want) - 4 and all(want[w] == a for w, a in got.items()) and any(got.values())
    assert len([p for p in seen if any(a for _, _, a in p)]) >= 2  # alarms leave in the micro-batches that close their runs
    # a run does not go on over minutes without rows
    by_minute = {int((w - START).total_seconds() // 60): run for part in seen for w, run, _ in part}
    assert by_minute[6] == 3 and by_minute[8] == 1 and by_minute[9] == 2 and by_minute[13] == 1


@pytest.mark.parametrize("query, column", [(_live_errors, "alarm"), (_live_p99, "n_alarms")])
def test_live_alarms_in_any_session(spark, tmp_path, query, column):
    """A session that keeps state in memory starts the stream all the same, and keeps its setting."""
    at = [START + dt.timedelta(hours=h, minutes=m) for h in range(160) for m in range(0, 60, 10)]
    rows = [(i, t, 1, "error" if t.hour < 12 else "view", 30.0 if t.hour < 12 else 1.0, "{}") for i, t in enumerate(at)]
    rows.append((len(rows), None, 1, "error", 30.0, "{}"))
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    memory = ROCKSDB.replace("RocksDBStateStoreProvider", "HDFSBackedStateStoreProvider")
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, memory)
    try:
        assert any(r[column] for r in query(spark, str(tmp_path)).collect())
        assert spark.conf.get(STATE_STORE) == memory
    finally:
        spark.conf.set(STATE_STORE, before)


def test_bounded_windows(spark, tmp_path):
    """State is a row per window and feature, whatever the rows; ranks are right up to the sketch's error."""
    rng = np.random.default_rng(4)
    values = rng.lognormal(0, 1, 30_000)
    df = spark.createDataFrame([(START + dt.timedelta(seconds=int(i % 7200)), float(v)) for i, v in enumerate(values)], "ts timestamp, value double")
    path = str(tmp_path / "in")
    df.write.parquet(path)
    stream = windows.sketched_windows(windows.read_stream(spark, path, df.schema), "ts", ["value"], "1 hour", "1 minute")
    query = windows.append_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    rows = max(o.get("numRowsTotal", 0) for p in query.recentProgress for o in p["stateOperators"])
    assert rows <= 2  # 30,000 distinct values
    out = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    first = out.orderBy("window_start").select("n", "mean", windows.sketched_quantile("sketch", 0.9).alias("q")).first()
    own = values[[i % 7200 < 3600 for i in range(len(values))]]
    assert first["n"] == len(own) and first["mean"] == pytest.approx(own.mean())
    assert abs((own <= first["q"]).mean() - 0.9) < 0.02
    shifted = df.withColumn("value", F.col("value") + 1)
    whole = windows.sketched_windows(df, "ts", ["value"], "1 day").select("feature", "sketch")
    ks = windows.sketched_ks(windows.sketched_windows(shifted, "ts", ["value"], "1 day"), whole).first()["ks_statistic"]
    grid = np.sort(np.r_[values, values + 1])
    exact = np.abs(np.searchsorted(np.sort(values), grid, side="right") - np.searchsorted(np.sort(values + 1), grid, side="right")).max() / len(values)
    assert abs(ks - exact) < 0.03


def test_captured_pairs(spark, tmp_path):
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(minutes(0, 1, 2, 3, 200))], "request_id long, asked_at timestamp")
    answered = spark.createDataFrame([(0, minutes(1)[0], 1.0), (1, minutes(11)[0], 2.0), (2, minutes(13)[0], 3.0), (9, minutes(3)[0], 9.0), (4, minutes(200)[0], 5.0)],
                                     "request_id long, answered_at timestamp, prediction double")
    for name, df in (("in", asked), ("out", answered)):
        df.write.parquet(str(tmp_path / name))
    pairs = captured_pairs(windows.read_stream(spark, str(tmp_path / "in"), asked.schema), windows.read_stream(spark, str(tmp_path / "out"), answered.schema))
    kept = windows.run_to_table(pairs, str(tmp_path / "pairs"), str(tmp_path / "state"))
    assert {r["request_id"]: r["prediction"] for r in kept.collect()} == {0: 1.0, 1: 2.0, 2: None, 3: None, 4: 5.0}


def plain_information(x, y, k=3):
    def psi(n):
        return -np.euler_gamma + sum(1 / j for j in range(1, n))

    n = len(x)
    dx, dy = np.abs(x[:, None] - x[None]), np.abs(y[:, None] - y[None])
    both = np.maximum(dx, dy)
    np.fill_diagonal(both, np.inf)
    r = np.sort(both, axis=1)[:, k - 1]
    nx, ny = (dx < r[:, None]).sum(1), (dy < r[:, None]).sum(1)
    return max(0.0, psi(n) + psi(k) - np.mean([psi(int(a)) for a in nx]) - np.mean([psi(int(a)) for a in ny]))


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbour_information_against_all_pairs(spark, parts):
    rng = np.random.default_rng(7)
    n = 500
    x = np.stack([rng.normal(0, 1, n), rng.integers(0, 6, n).astype(float), rng.normal(0, 5, n)], axis=1)
    y = x[:, 0] * 2 + (x[:, 1] > 2) + rng.normal(0, 0.2, n)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))] + [(n, None, 1.0, float("nan"), 2.0), (n + 1, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, y double").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["feature"]: r["mutual_information"] for r in neighbour_information(df, ["a", "b", "c"], "y", ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert list(got)[0] == "a" and got["c"] < got["a"]
    assert got["a"] == pytest.approx(plain_information(x[:, 0] / x[:, 0].std(), y / np.r_[y, 2.0].std()), abs=0.02)
    assert neighbour_information(df.limit(0), ["a"], "y", ["k"]).count() == 0


def test_nearest_by_walking():
    rng = np.random.default_rng(1)
    x, y = np.sort(rng.normal(0, 1, 300)), rng.normal(0, 1, 300)
    d = np.maximum(np.abs(x[:, None] - x[None]), np.abs(y[:, None] - y[None]))
    np.fill_diagonal(d, np.inf)
    assert np.allclose(nearest(x, y, 3), np.sort(d, axis=1)[:, :3])
    assert np.isinf(nearest(x[:2], y[:2], 3)[:, 1:]).all()


@pytest.mark.parametrize("n", [0, 1, 33, 700])
def test_nearest_among_ties(monkeypatch, n):
    """Many rows of one value, told apart by less than 1e-10: as all pairs give, and no pair is looked at in vain too often."""
    rng = np.random.default_rng(3)
    x, y = (rng.integers(0, c, n) + rng.uniform(-1, 1, n) * 1e-10 for c in (4, 9))
    d = np.maximum(np.abs(x[:, None] - x[None]), np.abs(y[:, None] - y[None]))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :3]
    got = nearest(x, y, 3)
    assert np.array_equal(got[:, : want.shape[1]], want) and np.isinf(got[:, want.shape[1] :]).all()


def test_nearest_grows_with_the_rows():
    """Every row has one value along x: walking along it would compare all pairs of 120,000 rows."""
    rng = np.random.default_rng(5)
    n = 120_000
    x, y = 1.0 + rng.uniform(-1, 1, n) * 1e-10, rng.permutation(n).astype(float)
    begun = time.process_time()
    got = nearest(x, y, 3)
    assert time.process_time() - begun < 60
    assert got[(y > 2) & (y < n - 3)].max() < 2.001 and got.min() > 0.999


def test_digamma(spark):
    got = [r[0] for r in spark.range(1, 60).select(digamma(F.col("id").cast("double"))).collect()]
    want = [-np.euler_gamma + math.fsum(1 / j for j in range(1, n)) for n in range(1, 60)]
    assert np.allclose(got, want, atol=1e-9)


def test_exact_split_of_repeated_keys(spark):
    """Half of all rows under one key: its rows stay together and meet as one counted row."""
    df = spark.createDataFrame([(0,)] * 500 + [(k,) for k in range(1, 501)], "k long")
    out = with_exact_split(df, ["k"], 0.3)
    sides = out.groupBy("k").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0]
    n_test = out.where("split = 'test'").count()
    assert sides == 1 and n_test >= 300 and (n_test == 300 or n_test - 500 < 300)


def test_very_many_categories(spark):
    """A hundred thousand categories fit and apply without a column each."""
    df = spark.range(100_000).select((F.col("id") * 3).alias("v"))
    table = category_table(df, "v")
    assert table.count() == 100_000 and table.where("index <> value / 3").count() == 0
    asked = spark.createDataFrame([(0,), (299_997,), (1,), (None,)], "v long")
    out = one_hot_vector(asked, "v", table, "hot").select("v", F.unwrap_udt("hot").alias("h")).collect()
    got = {r["v"]: (r["h"]["size"], list(r["h"]["indices"]), list(r["h"]["values"])) for r in out}
    assert got == {0: (100_000, [0], [1.0]), 299_997: (100_000, [99_999], [1.0]), 1: (100_000, [], []), None: (100_000, [], [])}
    assert category_table(df.limit(0), "v").count() == 0


def test_moments_merge_in_any_number_of_levels(spark, monkeypatch):
    from tabloom.operators import moments

    df = spark.range(4000).repartition(37).select(
        (F.col("id") % 3).cast("int").alias("g"), *[(F.hash("id", F.lit(k)) % 1000 + 1e6 * k).cast("double").alias(f"c{k}") for k in range(4)])
    names = [f"c{k}" for k in range(4)]
    want = sorted(tuple(r) for r in moments.pair_moments(df, names, "g").collect())
    monkeypatch.setattr(moments, "FEW_MERGES", 2)
    got = sorted(tuple(r) for r in moments.pair_moments(df, names, "g").collect())
    assert [g[:4] for g in got] == [w[:4] for w in want] and np.allclose([g[4:9] for g in got], [w[4:9] for w in want])
    exact = df.where("g = 1").agg(F.covar_pop("c1", "c2") * F.count("*")).first()[0]
    assert next(g for g in got if g[:3] == (1, 1, 2))[8] == pytest.approx(exact)
