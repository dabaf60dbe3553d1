"""Splits, folds and samples from stable key digests.

A digest decides each row on its own, so splitting is a projection: no sort, no shuffle, and
the same rows on every run whatever the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.columns import below_fraction, digest_number, key_digest
from tabloom.operators.frames import name
from tabloom.operators.grids import quantile_grids
from tabloom.operators.quantiles import ORDER_ROWS, order_values


def row_digest(keys: Sequence[str], seed: int) -> Column:
    return key_digest(seed, *[name(k) for k in keys])


def with_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `split`, "test" for about `test_fraction` of the keys; rows of equal keys stay together."""
    test = below_fraction(row_digest(keys, seed), test_fraction)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def with_exact_split(
    df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42, order_rows: int = ORDER_ROWS
) -> DataFrame:
    """As `with_split`, with exactly ceil(fraction * n) test rows when keys are unique.

    The cut is the k-th smallest digest, found by counting; rows are never sorted as a whole.
    """
    # 52 bits of the digest are exact in a double
    number = F.shiftright(digest_number(row_digest(keys, seed)), 8).cast("double")
    numbered = df.select(number.alias("digest"))
    grids = quantile_grids(numbered, ["digest"])
    k = math.ceil(grids["digest"].n * test_fraction)
    if k == 0:
        return df.withColumn("split", F.lit("train"))
    cut = order_values(numbered, {("digest", k - 1)}, grids, order_rows)["digest", k - 1]
    # digests that share the cut's leading bits are few; among them the whole digest decides
    whole = row_digest(keys, seed)
    before = numbered.where(F.col("digest") < cut).count()
    tied = df.select(whole.alias("d"), number.alias("n")).where(F.col("n") == cut).groupBy("d").agg(F.count("*").alias("rows"))
    upto = tied.select("d", F.sum("rows").over(Window.orderBy("d")).alias("upto"))  # a row per digest, however often its key repeats
    last = upto.where(F.col("upto") >= k - before).agg(F.min("d")).first()[0]
    test = (number < F.lit(cut)) | ((number == F.lit(cut)) & (whole <= F.lit(last)))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def with_stratified_split(
    df: DataFrame, keys: Sequence[str], stratum: str, test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """The digest takes the stratum in, so each stratum is cut by draws of its own."""
    return with_split(df, [stratum, *keys], test_fraction, seed)


def with_fold(df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """Add `fold`, 0 to folds - 1."""
    number = digest_number(row_digest(keys, seed))
    return df.withColumn("fold", F.pmod(number, F.lit(folds)).cast("int"))


def background_sample(df: DataFrame, keys: Sequence[str], size: int = 100, seed: int = 42) -> DataFrame:
    """`size` rows with the smallest digests, numbered by `draw` in digest order; ties follow the keys.

    Spark keeps `size` rows per task and merges those; `size` is a fixed parameter of the explainer.
    """
    digest = row_digest(keys, seed)
    order = [F.col("digest"), *[name(k) for k in keys]]
    top = df.withColumn("digest", digest).orderBy(*order).limit(size)
    return top.withColumn("draw", F.row_number().over(Window.orderBy(*order)) - 1)


def percent_sample(df: DataFrame, key: str, percentage: float = 100.0, seed: int = 0) -> DataFrame:
    """Rows whose key digest falls below the percentage; works on streams."""
    return df.where(below_fraction(row_digest([key], seed), percentage / 100.0))
