"""Value counts of closed event-time windows: the one stateful step behind summaries, drift and alarms.

State is one row per open window, feature and distinct value, spread over tasks by that key, so
neither a busy window nor a frequent value gathers in one place. A window leaves the state once,
whole, when the watermark passes its end. Reports are then plain queries on the kept counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.buckets import balanced_edges, weighted_summary
from tabloom.operators.drift import ALPHA, MIN_NEW
from tabloom.operators.frames import as_double, name
from tabloom.operators.windowed_drift import drift_of_windows, rank_reference

DELAY = "1 hour"
#: Size of a window's quantile sketch: ranks are right up to about 0.7 % with k = 400.
SKETCH_K = 400
COUNTS = "window_start timestamp, feature string, value double, n bigint"


def event_time(df: DataFrame, ts: str, delay: str = DELAY) -> DataFrame:
    """A proper timestamp with a watermark; rows later than `delay` are dropped by stateful steps."""
    return df.withColumn(ts, name(ts).cast("timestamp")).withWatermark(ts, delay)


def value_counts(df: DataFrame, ts: str, features: Sequence[str], width: str, delay: str = DELAY) -> DataFrame:
    """`(window_start, feature, value, n)` per tumbling window; batch or stream."""
    timed = event_time(df, ts, delay).select(name(ts), *[as_double(f).alias(f) for f in features])
    long = timed.unpivot([name(ts)], [name(f) for f in features], "feature", "value").where("value is not null")
    return (
        long.groupBy(F.window(name(ts), width).alias("w"), "feature", "value")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "feature", "value", "n")
    )


def event_counts(df: DataFrame, ts: str, condition: Column, width: str, delay: str = DELAY) -> DataFrame:
    """`(window_start, events, hits)` per tumbling window: all rows, and those that meet the condition."""
    return (
        event_time(df, ts, delay)
        .groupBy(F.window(name(ts), width).alias("w"))
        .agg(F.count("*").alias("events"), F.count_if(condition).alias("hits"))
        .select(F.col("w.start").alias("window_start"), "events", "hits")
    )


def sketched_windows(df: DataFrame, ts: str, features: Sequence[str], width: str, delay: str = DELAY, k: int = SKETCH_K) -> DataFrame:
    """`(window_start, closed_at, feature, n, mean, min, max, sketch)` per tumbling window; batch or stream.

    State is one row per open window and feature, whatever the number of rows or of distinct values: counts, sums and a mergeable
    quantile sketch. `value_counts` is the exact form, whose state grows with the distinct values.
    """
    timed = event_time(df, ts, delay).select(name(ts), *[as_double(f).alias(f) for f in features])
    long = timed.unpivot([name(ts)], [name(f) for f in features], "feature", "value").where("value is not null")
    return (
        long.groupBy(F.window(name(ts), width).alias("w"), "feature")
        .agg(
            F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
            F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
        )
        .select(F.col("w.start").alias("window_start"), F.window_time("w").alias("closed_at"), "feature", "n", "mean", "min", "max", "sketch")
    )


def sketched_quantile(sketch: str, rank: float) -> Column:
    return F.expr(f"kll_sketch_get_quantile_double({sketch}, {rank}D)")


def sketched_ks(windows: DataFrame, reference: DataFrame, points: int = 200) -> DataFrame:
    """`(window_start, feature, n, ks_statistic)` from sketches `(feature, sketch)` of a reference.

    The two distributions are compared at `points` quantiles of the reference, which reach the driver, a few numbers per feature.
    Between two of them the reference rises by 1 / points, so the statistic is right up to that and the rank errors of both sketches.
    """
    ranks = "array(" + ", ".join(f"{(i + 0.5) / points}D" for i in range(points)) + ")"
    grids = {r["feature"]: r["q"] for r in reference.select("feature", F.expr(f"kll_sketch_get_quantile_double(sketch, {ranks})").alias("q")).collect()}

    def at_grid(sketch: str) -> Column:
        out = F.lit(None).cast("array<double>")
        for f, grid in grids.items():
            values = "array(" + ", ".join(f"{v!r}D" for v in sorted(set(grid))) + ")"
            out = F.when(F.col("feature") == f, F.expr(f"kll_sketch_get_rank_double({sketch}, {values})")).otherwise(out)
        return out

    both = windows.join(reference.select("feature", F.col("sketch").alias("ref")), "feature")
    gaps = F.zip_with(at_grid("sketch"), at_grid("ref"), lambda a, b: F.abs(a - b))
    return both.select("window_start", "feature", "n", F.array_max(gaps).alias("ks_statistic"))


def closed_series(windows: DataFrame, series: Column, value: Column) -> DataFrame:
    """Closed windows of a stream as `(series, window_start, value)`, still with their watermark."""
    return windows.select(series.cast("string").alias("series"), "window_start", value.cast("double").alias("value"), "closed_at")


def timed_counts(df: DataFrame, ts: str, condition: Column, width: str, delay: str = DELAY) -> DataFrame:
    """`event_counts` with `closed_at`, the time by which a window's watermark is known to a further step."""
    return (
        event_time(df, ts, delay)
        .groupBy(F.window(name(ts), width).alias("w"))
        .agg(F.count("*").alias("events"), F.count_if(condition).alias("hits"))
        .select(F.col("w.start").alias("window_start"), F.window_time("w").alias("closed_at"), "events", "hits")
    )


def append_table(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write all available input and stop; files and offsets are committed together."""
    return (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is available and read the table it kept."""
    append_table(stream, path, checkpoint).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def window_summary(counts: DataFrame, probs: dict[str, float] | None = None) -> DataFrame:
    """`(window_start, feature, n, mean, min, max, quantiles...)` of closed windows."""
    probs = probs or {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    edges = balanced_edges(counts.select("feature", "value"))
    return weighted_summary(counts, ["window_start", "feature"], probs, edges)


def drift_stream(
    counts: DataFrame,
    reference_counts: DataFrame,
    path: str,
    checkpoint: str,
    alpha: float = ALPHA,
    min_new: int = MIN_NEW,
) -> StreamingQuery:
    """Test every closed window against the reference as it leaves the state.

    The reference is ranked once, before the first micro-batch; a micro-batch reads the kept ranks of the buckets it touches.
    Each micro-batch writes its own folder, so a repeated batch replaces what it wrote before.
    """

    ranked = rank_reference(reference_counts)

    def test(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                rows = drift_of_windows(ranked, batch, alpha, min_new)
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return on_closed(counts, test, checkpoint)


def on_closed(counts: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of files as a stream; `pattern` picks file names, `files_per_batch` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)
