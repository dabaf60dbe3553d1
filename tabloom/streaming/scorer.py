"""Scoring of request streams into the prediction log, and payload capture."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.scoring import Score, score_requests
from tabloom.operators.split import percent_sample
from tabloom.sources.prediction_log import log_records


def scored_log(
    requests: DataFrame,
    expected: Sequence[str],
    medians: Mapping[str, float],
    score: Score,
    model_type: str = "unknown",
) -> tuple[DataFrame, DataFrame]:
    """(log records, rejects) of a batch or stream of feature maps. Stateless: one projection per row."""
    scored, rejects = score_requests(requests, expected, medians, score, model_type)
    return log_records(scored, expected), rejects


def append_json(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append log records by day as JSON lines."""
    return (
        stream.withColumn("date", F.to_date("timestamp"))
        .writeStream.outputMode("append")
        .format("json")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_scores(
    requests: DataFrame,
    expected: Sequence[str],
    medians: Mapping[str, float],
    score: Score,
    path: str,
    rejects_path: str,
    checkpoint: str,
    model_type: str = "unknown",
) -> StreamingQuery:
    """Score a request stream: records to `path`, requests that cannot be scored to `rejects_path` with their reason.

    Each micro-batch writes its own folders, so a repeated batch replaces what it wrote before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            records, rejects = scored_log(batch, expected, medians, score, model_type)
            for rows, folder in ((records, path), (rejects, rejects_path)):
                rows.write.mode("overwrite").json(f"{folder}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def captured(df: DataFrame, key: str = "request_id", percentage: float = 100.0) -> DataFrame:
    """The share of payloads to keep, chosen by request id."""
    return percent_sample(df, key, percentage)


def captured_pairs(
    inputs: DataFrame,
    outputs: DataFrame,
    wait: str = "10 minutes",
    key: str = "request_id",
    asked_at: str = "asked_at",
    answered_at: str = "answered_at",
    delay: str = "1 hour",
    percentage: float = 100.0,
) -> DataFrame:
    """Captured requests with their responses: a watermarked join of two streams by id.

    A response counts if it comes within `wait` of its request. A request without one leaves, with nulls, once the watermark has
    passed the time it could still be answered; a response without a request is left out. Both sides take the same share of ids.
    """
    asked = captured(inputs, key, percentage).withColumn(asked_at, F.col(asked_at).cast("timestamp")).withWatermark(asked_at, delay)
    answered = captured(outputs, key, percentage).withColumn(answered_at, F.col(answered_at).cast("timestamp")).withColumnRenamed(key, "answered_id")
    answered = answered.withWatermark(answered_at, delay)
    in_time = (F.col(answered_at) >= F.col(asked_at)) & (F.col(answered_at) <= F.col(asked_at) + F.expr(f"INTERVAL {wait}"))
    return asked.join(answered, (F.col(key) == F.col("answered_id")) & in_time, "left_outer").drop("answered_id")
