"""Rules that merge sparse values of near-categorical columns, and one-hot columns."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import name
from tabloom.session import materialise, small_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Bins:
    """`rules` are (operator, threshold, target) with operator lte, gte or eq, applied in order."""

    column: str
    output: str
    rules: tuple[tuple[str, float, float], ...]


def _rule(value: Column, rule: tuple[str, float, float]) -> Column:
    """One rule. A null fails the keep condition of lte and gte, so it becomes the target too."""
    op, threshold, target = rule
    if op == "lte":
        return F.when(value > threshold, value).otherwise(F.lit(target))
    if op == "gte":
        return F.when(value < threshold, value).otherwise(F.lit(target))
    if op == "eq":
        return F.when(value == threshold, F.lit(target)).otherwise(value)
    raise ValueError(f"Unknown bin operator '{op}'.")


def apply_bins(df: DataFrame, bins: Sequence[Bins]) -> DataFrame:
    """Add one output column per entry; source columns stay, absent ones are skipped with a warning."""
    for b in bins:
        if b.column not in df.columns:
            log.warning("column '%s' not found, bins skipped", b.column)
            continue
        df = df.withColumn(b.output, reduce(_rule, b.rules, name(b.column)))
    return df


def fit_categories(df: DataFrame, column: str, max_columns: int = 10_000) -> list:
    """The sorted distinct values that become columns; null is none of them.

    Every value becomes a column of the plan, so a column with more than `max_columns`
    of them is refused as not categorical.
    """
    seen = df.select(name(column).alias("v")).where("v is not null").distinct().limit(max_columns + 1).collect()
    if len(seen) > max_columns:
        raise ValueError(f"column '{column}' has more than {max_columns} distinct values")
    return sorted(r["v"] for r in seen)


def one_hot_columns(column: str, categories: Sequence, prefix: str) -> dict[str, Column]:
    """0/1 columns named `<prefix>_<value>`; a null or unseen value is 0 in all of them."""
    return {
        f"{prefix}_{v}": F.coalesce((name(column) == F.lit(v)).cast("int"), F.lit(0)) for v in categories
    }


def one_hot(df: DataFrame, column: str, categories: Sequence, prefix: str) -> DataFrame:
    """Replace `column` by its 0/1 columns, placed last."""
    return df.withColumns(one_hot_columns(column, categories, prefix)).drop(column)


def category_table(df: DataFrame, column: str) -> DataFrame:
    """`(value, index)` of the distinct values in order, for columns of any number of categories; null is none of them.

    Values are dealt by range and numbered within their range; only the sizes of the ranges reach the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = df.select(name(column).alias("value")).where("value IS NOT NULL").distinct()
    own = seen.repartitionByRange(parts, "value").sortWithinPartitions("value").select(
        "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    kept = materialise(own, "categories")
    sizes = {r["part"]: (r["n"], r["first"]) for r in kept.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()}
    rows, before = [], 0
    for part in sorted(sizes):
        n, first = sizes[part]
        rows.append((part, before - first))
        before += n
    shifts = small_table(spark, rows, "part int, shift bigint")
    return kept.join(shifts, "part").select("value", (F.col("place") + F.col("shift")).alias("index"))


def one_hot_vector(df: DataFrame, column: str, categories: DataFrame, output: str) -> DataFrame:
    """Add `output`, a sparse vector with a 1 at the value's index; a null or unseen value has none. Spark picks how to join."""
    n = categories.count()
    numbered = categories.select(F.col("value").alias("_value"), F.col("index").cast("double").alias("_index"))
    joined = df.join(numbered, name(column) == F.col("_value"), "left").withColumn("_index", F.coalesce("_index", F.lit(float(n))))
    sizes = small_table(df.sparkSession, [(float(max(0, n - 1)),)], "_index double")
    encoder = OneHotEncoder(inputCol="_index", outputCol=output, handleInvalid="keep", dropLast=True).fit(sizes)
    return encoder.transform(joined).drop("_value", "_index")
