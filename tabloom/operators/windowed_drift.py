"""Drift of closed time windows against one reference, from value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.buckets import balanced_edges, running_totals, with_bucket
from tabloom.operators.drift import ALPHA, MIN_NEW, report
from tabloom.session import materialise, small_table


@dataclass(frozen=True)
class RankedReference:
    """Reference values with the number of values up to each, `(feature, bucket, value, n, upto)`; `starts` has a row per feature
    and bucket: `(feature, bucket, earlier, n_ref)`, `spans` one per feature: `(feature, least, most, n_ref)`.
    """

    ranks: DataFrame
    starts: DataFrame
    spans: DataFrame
    edges: Mapping[str, Sequence[float]]


def rank_reference(reference_counts: DataFrame, keep: bool = True) -> RankedReference:
    """Rank `(feature, value, n)` once, for any number of windows and micro-batches; kept as a table unless told otherwise."""
    edges = balanced_edges(reference_counts.select("feature", "value"))
    ranks = with_bucket(running_totals(reference_counts, ["feature"], "n", edges), edges).select(
        "feature", "bucket", "value", "n", "upto", "total"
    )
    ranks = materialise(ranks, "ranks") if keep else ranks
    grid = small_table(
        reference_counts.sparkSession, [(f, b) for f, e in edges.items() for b in range(len(e) + 1)], "feature string, bucket int"
    )
    ends = ranks.groupBy("feature", "bucket").agg(F.max("upto").alias("end"), F.max("total").alias("n_ref"))
    before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = grid.join(ends, ["feature", "bucket"], "left").select(
        "feature", "bucket", F.coalesce(F.max("end").over(before), F.lit(0)).alias("earlier"),
        F.max("n_ref").over(Window.partitionBy("feature")).alias("n_ref"),
    )
    spans = ranks.groupBy("feature").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.max("total").alias("n_ref"))
    if keep:
        starts, spans = materialise(starts, "starts"), materialise(spans, "spans")
    return RankedReference(ranks, starts, spans, edges)


def drift_of_windows(
    reference: RankedReference, window_counts: DataFrame, alpha: float = ALPHA, min_new: int = MIN_NEW
) -> DataFrame:
    """`(window_start, feature, n_new, ks_statistic, p_value, drifted)` of `(window_start, feature, value, n)`.

    Between two new values the new distribution is flat and the reference one only rises, so the largest gap lies at a new value or
    just before one. Each distinct new value finds its rank among the reference values of its bucket; other buckets are not read, and
    values beyond the reference's range have their rank without a search. The windows' own running totals are cut at the edges of both
    sides, so a window that lies where the reference has little is dealt to many buckets all the same.
    """
    placed = window_counts.select("feature", "value").distinct().join(reference.spans, "feature")
    above, below = F.col("value") > F.col("most"), F.col("value") < F.col("least")
    beyond = placed.where(above | below).select("feature", "value", "n_ref", *[F.when(above, F.col("n_ref")).otherwise(0).alias(c) for c in ("upto", "before")])
    marks = with_bucket(placed.where(~above & ~below).select("feature", "value"), reference.edges)
    touched = marks.select("feature", "bucket").distinct()
    held = reference.ranks.join(touched, ["feature", "bucket"], "left_semi").select(
        "feature", "bucket", "value", F.struct("value", "n", "upto").alias("known"), F.lit(False).alias("mark")
    )
    asked = marks.select("feature", "bucket", "value", F.lit(None).cast(held.schema["known"].dataType).alias("known"), F.lit(True).alias("mark"))
    upto_here = Window.partitionBy("feature", "bucket").orderBy("value", "mark").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("last")
    ranks = (
        held.unionByName(asked)
        .withColumn("last", F.last("known", ignorenulls=True).over(upto_here))
        .where("mark")
        .join(reference.starts, ["feature", "bucket"])
        .select(
            "feature", "value", "n_ref", F.coalesce(last["upto"], "earlier").alias("upto"),
            F.when(last["value"] == F.col("value"), last["upto"] - last["n"]).otherwise(F.coalesce(last["upto"], "earlier")).alias("before"),
        )
    )
    ranks = ranks.unionByName(beyond)
    own = balanced_edges(window_counts.select("feature", "value"))
    edges = {f: sorted({*reference.edges.get(f, ()), *own.get(f, ())}) for f in {*reference.edges, *own}}
    new = (
        running_totals(window_counts, ["window_start", "feature"], "n", edges)
        .withColumnRenamed("upto", "cum")
        .withColumnRenamed("total", "n_new")
    )
    at_value = F.abs(F.col("upto") / F.col("n_ref") - F.col("cum") / F.col("n_new"))
    just_before = F.abs(F.col("before") / F.col("n_ref") - (F.col("cum") - F.col("n")) / F.col("n_new"))
    stats = (
        new.where(F.col("n_new") >= min_new)
        .join(ranks.where("n_ref > 0"), ["feature", "value"])
        .groupBy("window_start", "feature", "n_ref", "n_new")
        .agg(F.max(F.greatest(at_value, just_before)).alias("d"))
    )
    return report(stats, alpha).select("window_start", "feature", "n_new", "ks_statistic", "p_value", "drifted")


def windowed_drift(
    reference_counts: DataFrame, window_counts: DataFrame, alpha: float = ALPHA, min_new: int = MIN_NEW
) -> DataFrame:
    """`drift_of_windows` against `(feature, value, n)`, ranked for this call."""
    return drift_of_windows(rank_reference(reference_counts), window_counts, alpha, min_new)
