"""Value buckets of about equal size per feature, for jobs that need values in order.

One feature may be a third of all rows or all of them, so ordering a feature in one window
partition does not scale. Bucket edges come from mergeable quantile sketches, are held by the
driver as one short array per feature, and make the bucket a plain column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.frames import name
from tabloom.operators.grids import CELL_RANKS, CELLS, MERGES, SKETCH_K
from tabloom.session import small_table

def edges_table(spark, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    return small_table(spark, [(f, list(e)) for f, e in edges.items()], "feature string, edges array<double>")


def bucket_of(value: Column, edges: Column, longest: int) -> Column:
    """Number of edges not above `value`, by binary search: a fold over at most log2(longest) steps."""
    steps, step = [], 1
    while step <= max(1, longest):
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(edges, at + s - 1) <= value, at + s).otherwise(at),
    )


def with_bucket(long: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add `bucket`; the edge table has one row per feature and a fixed number of edges."""
    longest = max((len(e) for e in edges.values()), default=0)
    table = edges_table(long.sparkSession, edges)
    return (
        long.join(F.broadcast(table), "feature")
        .withColumn("bucket", bucket_of(F.col("value"), F.col("edges"), longest))
        .drop("edges")
    )


def balanced_edges(long: DataFrame, rows_per_bucket: int = 250_000) -> dict[str, list[float]]:
    """Edges per feature of rows `(feature, value)`, as many as its number of rows asks for; none for few rows.

    Tasks sketch by feature; a feature's sketches meet in `MERGES` groups first.
    """
    first = long.select("feature", "value", (F.spark_partition_id() % MERGES).alias("salt")).groupBy(
        "feature", "salt"
    ).agg(F.kll_sketch_agg_double("value", F.lit(SKETCH_K)).alias("s"), F.count("*").alias("n"))
    merged = first.groupBy("feature").agg(F.kll_merge_agg_double("s").alias("s"), F.sum("n").alias("n"))
    out = {}
    for r in merged.selectExpr("feature", "n", f"kll_sketch_get_quantile_double(s, {CELL_RANKS}) AS q").collect():
        step = max(1, CELLS * rows_per_bucket // max(1, r["n"]))
        out[r["feature"]] = sorted(set(r["q"][step:-1:step]))
    return out


def bucket_columns(wide: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Replace each column of doubles by the number of its bucket; edges belong to the bucket above them.

    Null stays null. The search runs in the JVM on unboxed doubles.
    """
    inf = float("inf")
    columns = list(edges)
    split = {c: [-inf, *edges[c], inf] if edges[c] else [-inf, 0.0, inf] for c in columns}
    done = Bucketizer(
        inputCols=columns,
        outputCols=[f"_b_{c}" for c in columns],
        splitsArray=[split[c] for c in columns],
        handleInvalid="keep",
    ).transform(wide)
    others = [name(c) for c in wide.columns if c not in edges]
    return done.select(*[F.when(name(c).isNotNull(), name(f"_b_{c}")).alias(c) for c in columns], *others)


def running_totals(
    rows: DataFrame, keys: Sequence[str], amount: str, edges: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Add `upto`, the running sum of `amount` in value order within `keys`, and `total`.

    Values are ordered within a bucket only; sums of the buckets before it are added. `keys`
    includes "feature"; the bucket sums are one row per key and bucket.
    """
    bucketed = with_bucket(rows, edges)
    by_bucket = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*keys, "bucket")
        .agg(F.sum(amount).alias("held"))
        .withColumn("earlier", F.coalesce(F.sum("held").over(by_bucket), F.lit(0)))
        .withColumn("total", F.sum("held").over(Window.partitionBy(*keys)))
        .drop("held")
    )
    inside = Window.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bucketed.withColumn("within", F.sum(amount).over(inside))
        .join(offsets, [*keys, "bucket"])
        .withColumn("upto", F.col("earlier") + F.col("within"))
        .drop("earlier", "within", "bucket")
    )


def weighted_summary(
    counts: DataFrame, keys: Sequence[str], probs: Mapping[str, float], edges: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Count, mean, min, max and exact quantiles per `keys` from rows `(keys..., value, n)`.

    `probs` maps output names to probabilities. A rank is found at the one value whose running
    total covers it, so quantiles are sums over rows and no task holds the values of a key.
    """
    ranked = running_totals(counts, keys, "n", edges)
    start = F.col("upto") - F.col("n")

    def at(p: float) -> Column:
        pos = F.lit(p) * (F.col("total") - 1)
        low, high = F.floor(pos), F.ceil(pos)
        in_low = (low >= start) & (low < F.col("upto"))
        in_high = (high >= start) & (high < F.col("upto")) & (high > low)
        weight = F.when(in_low, low + 1 - pos).otherwise(0.0) + F.when(in_high, pos - low).otherwise(0.0)
        return F.sum(F.col("value") * weight)

    return ranked.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *[at(p).alias(c) for c, p in probs.items()],
    )
