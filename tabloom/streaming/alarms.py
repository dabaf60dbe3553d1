"""Alarms on closed windows, as a table or while the stream runs: a breach that lasts several periods in a row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The two alarms' limits, periods and run lengths.
LATENCY_P99_LIMIT, LATENCY_RUN = 500.0, 3
ERROR_LIMIT, ERROR_RUN = 5, 2
PERIOD_SECONDS = 60


def alarm_states(metrics: DataFrame, breach: Column, run: int, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """Add `breach` and `alarm` to rows with a `window_start`, best from a kept table: they are read twice.

    The alarm is on where the window and the run - 1 periods right before it all breach; a period
    without data does not. Every breach votes for the windows it can be part of the run of, so the
    run is found by counting votes, with no window over the whole table.
    """
    flagged = metrics.withColumn("breach", F.coalesce(breach, F.lit(False)))
    start = F.unix_micros("window_start")
    steps = F.sequence(F.lit(0), F.lit(run - 1))
    votes = (
        flagged.where("breach")
        .select(F.explode(F.transform(steps, lambda k: start + k * F.lit(period_seconds * 1_000_000).cast("bigint"))).alias("at"))
        .groupBy("at")
        .agg(F.count("*").alias("votes"))
        .where(F.col("votes") == run)
        .select(F.timestamp_micros("at").alias("window_start"), F.lit(True).alias("alarm"))
    )
    return flagged.join(votes, "window_start", "left").withColumn(
        "alarm", F.coalesce("alarm", F.lit(False)) & F.col("breach")
    )


def latency_alarm(summary: DataFrame, limit: float = LATENCY_P99_LIMIT, run: int = LATENCY_RUN,
                  period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """From window summaries with a `p99` column."""
    return alarm_states(summary, F.col("p99") > limit, run, period_seconds)


def error_alarm(counts: DataFrame, limit: int = ERROR_LIMIT, run: int = ERROR_RUN,
                period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """From window counts with a `hits` column."""
    return alarm_states(counts, F.col("hits") > limit, run, period_seconds)


LIVE = "series string, window_start timestamp, value double, run int, alarm boolean"


class RunOfBreaches(StatefulProcessor):
    """Per series, how many periods in a row have breached; kept across micro-batches, one row of state.

    A window continues the run if it starts a period after the one before; a missing period ends it. A timer set for the end of the
    next period clears the state of a series that falls silent, so no series stays in the state for good.
    """

    def __init__(self, limit: float, run: int, period_seconds: int) -> None:
        self.limit, self.run, self.period = limit, run, period_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "last long, run int, timer long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(list(rows)).sort_values("window_start")
        last, run, timer = self.state.get() if self.state.exists() else (None, 0, None)
        out = []
        for start, value in zip(windows["window_start"], windows["value"]):
            at = int(start.timestamp() * 1000)
            breach = bool(value > self.limit)  # a missing value is no breach
            run = (run + 1 if last is not None and at == last + self.period else 1) if breach else 0
            last = at
            out.append((key[0], start, value, run, run >= self.run))
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = last + 2 * self.period
        self.handle.registerTimer(timer)
        self.state.update((last, run, timer))
        yield pd.DataFrame(out, columns=["series", "window_start", "value", "run", "alarm"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the timer goes off when the watermark has passed the next period: that period has closed without rows, or its row has
        # come in this very micro-batch and has set a later timer
        if self.state.exists() and self.state.get()[2] == expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def live_alarms(closed: DataFrame, limit: float, run: int, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """Alarms of a stream of closed windows `(series, window_start, value)`: rows leave in the micro-batch that closes their window.

    `closed` has a watermark that its windows have passed (see `windows.closed_series`). `alarm` is that of `alarm_states`. The state
    needs RocksDB: where the session does not set it, start the stream within `session.rocksdb_state`.
    """
    return closed.groupBy("series").transformWithStateInPandas(
        RunOfBreaches(limit, run, period_seconds), LIVE, outputMode="Append", timeMode="EventTime"
    )
