"""Two-sample Kolmogorov-Smirnov tests of many features at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.ks_law import asymptotic_tail
from tabloom.operators.buckets import bucket_columns
from tabloom.operators.frames import as_double, name, numeric_columns
from tabloom.operators.grids import quantile_grids
from tabloom.session import small_table

ALPHA = 0.05
MIN_NEW = 5
STATS = "feature string, n_ref bigint, n_new bigint, d double"
REPORT = "feature string, ks_statistic double, p_value double, drifted boolean"


def comparable_columns(reference: DataFrame, new: DataFrame) -> list[str]:
    """Numeric columns of the reference that the new table also has, in reference order."""
    have = set(new.columns)
    return [c for c in numeric_columns(reference) if c in have]


def ks_drift(
    reference: DataFrame,
    new: DataFrame,
    columns: Sequence[str] | None = None,
    alpha: float = ALPHA,
    min_new: int = MIN_NEW,
) -> DataFrame:
    """`(feature, ks_statistic, p_value, drifted)` in reference order.

    A feature with fewer than `min_new` new values is left out. `drifted` uses the unrounded p.
    """
    spark = reference.sparkSession
    columns = comparable_columns(reference, new) if columns is None else list(columns)
    if not columns:
        return small_table(spark, [], REPORT)
    stats = ks_statistics(reference, new, columns, min_new)
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    # one row per feature: a single small partition needs no range sampling to be sorted
    rows = report(stats, alpha).repartition(1).sortWithinPartitions(order)
    return rows.select("feature", "ks_statistic", "p_value", "drifted")


def report(stats: DataFrame, alpha: float) -> DataFrame:
    """Add the p-value, the flag and the rounding to rows `(..., n_ref, n_new, d)`."""
    return (
        stats.withColumn("p", asymptotic_tail(F.col("d"), F.col("n_ref"), F.col("n_new")))
        .withColumn("ks_statistic", F.round("d", 6))
        .withColumn("p_value", F.round("p", 6))
        .withColumn("drifted", F.col("p") < alpha)
        .drop("d", "p")
    )


def two_sides(reference: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both tables under each other as doubles; `side` is 0 on reference rows, 1 on new ones."""

    def of(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.lit(side).alias("side"), *[as_double(c).alias(c) for c in columns])

    return of(reference, 0).unionByName(of(new, 1))


def ks_statistics(reference: DataFrame, new: DataFrame, columns: Sequence[str], min_new: int = MIN_NEW) -> DataFrame:
    """`(feature, n_ref, n_new, d)`, exact, with most rows only counted; the same three scans at every size.

    Sketched edges cut each feature in buckets. Counts per bucket, a bounded number of rows, give both sides' sizes, the gap at
    every bucket end and a bound that no gap inside a bucket can exceed. Only buckets whose bound beats the best end gap are looked
    into value by value, starting from the counts of the buckets before them.
    """
    spark = reference.sparkSession
    both = two_sides(reference, new, columns)
    edges = {c: g.edges() for c, g in quantile_grids(both, columns).items()}
    hist: dict[str, list[tuple[float, int, int]]] = {c: [] for c in columns}
    for r in _value_counts(bucket_columns(both, edges), columns).collect():
        hist[r["feature"]].append((r["value"], r["r"], r["q"]))
    sizes = {c: (sum(h[1] for h in rows), sum(h[2] for h in rows)) for c, rows in hist.items()}
    tested = [c for c in columns if sizes[c][1] >= min_new]
    empty = [c for c in tested if sizes[c][0] == 0]
    if empty:
        raise ValueError(f"No reference values to compare with: {empty}")
    if not tested:
        return small_table(spark, [], STATS)
    return _distance(both.select("side", *[name(c) for c in tested]), tested, sizes, edges, hist)


def _value_counts(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(feature, value, r, q)`: how often each value stands on either side."""
    long = both.unpivot(["side"], [name(c) for c in columns], "feature", "value").where("value is not null")
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("q")
    )


def _sizes_table(spark, columns: Sequence[str], sizes: dict[str, tuple[int, int]]) -> DataFrame:
    return small_table(spark, [(c, *sizes[c]) for c in columns], "feature string, n_ref bigint, n_new bigint")


def _distance(
    both: DataFrame,
    columns: Sequence[str],
    sizes: dict[str, tuple[int, int]],
    edges: dict[str, list[float]],
    hist: dict[str, list[tuple[float, int, int]]],
) -> DataFrame:
    spark = both.sparkSession
    best, starts, wanted = {}, [], {}
    for c in columns:
        best[c], open_ = _end_gaps(sorted(hist[c]), *sizes[c])
        starts += [(c, b, r, q) for b, r, q in open_]
        wanted[c] = [b for b, _, _ in open_]
    looked_into = [c for c in columns if wanted[c]]
    ends = small_table(spark, [(c, *sizes[c], best[c]) for c in columns], STATS)
    if not looked_into:
        return ends
    cells = bucket_columns(
        both.select("side", *[name(c) for c in looked_into], *[name(c).alias(f"_cell_{c}") for c in looked_into]),
        {f"_cell_{c}": edges[c] for c in looked_into},
    )
    triples = ", ".join(
        f"'{c}', IF(get({_flags(wanted[c], len(edges[c]) + 1)}, CAST(`_cell_{c}` AS int)), `{c}`, NULL), "
        f"CAST(`_cell_{c}` AS int)"
        for c in looked_into
    )
    values = (
        cells.selectExpr("side", f"stack({len(looked_into)}, {triples}) AS (feature, value, bucket)")
        .where("value is not null")
        .groupBy("feature", "bucket", "value")
        .agg(F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("q"))
    )
    offsets = small_table(spark, starts, "feature string, bucket int, br bigint, bq bigint")
    inside = Window.partitionBy("feature", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(
        (F.col("br") + F.col("cr")) / F.col("n_ref") - (F.col("bq") + F.col("cq")) / F.col("n_new")
    )
    gaps = (
        values.withColumn("cr", F.sum("r").over(inside))
        .withColumn("cq", F.sum("q").over(inside))
        .join(F.broadcast(offsets), ["feature", "bucket"])
        .join(F.broadcast(_sizes_table(spark, columns, sizes)), "feature")
        .groupBy("feature", "n_ref", "n_new")
        .agg(F.max(gap).alias("d"))
    )
    return ends.unionByName(gaps).groupBy("feature", "n_ref", "n_new").agg(F.max("d").alias("d"))


def _flags(buckets: Sequence[int], size: int) -> str:
    """SQL of a folded array of booleans, true at the given buckets."""
    chosen = set(buckets)
    return "CAST(split('" + ",".join("true" if b in chosen else "false" for b in range(size)) + "', ',') AS array<boolean>)"


def _end_gaps(rows: list[tuple[float, int, int]], n: int, m: int) -> tuple[float, list[tuple[int, int, int]]]:
    """(largest gap at a bucket end, [(bucket, r before, q before)] of the buckets that may hold a larger one)."""
    r = q = 0
    best, spans = 0.0, []
    for bucket, dr, dq in rows:
        bound = max(abs((r + dr) / n - q / m), abs(r / n - (q + dq) / m))
        spans.append((bound, int(bucket), r, q))
        r, q = r + dr, q + dq
        best = max(best, abs(r / n - q / m))
    return best, [(b, br, bq) for bound, b, br, bq in spans if bound > best]


def drift_summary(rows: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row: any drift, how many features drifted and were tested, their names in report order."""
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    return rows.agg(
        F.lit(alpha).alias("significance_level"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        F.count_if("drifted").alias("n_features_drifted"),
        F.count("*").alias("n_features"),
        names.alias("drifted_features"),
    )


def ranked(rows: DataFrame) -> DataFrame:
    """Most significant first; ties by name."""
    return rows.orderBy("p_value", "feature")
