"""Sampled Shapley values of any scoring function (Strumbelj and Kononenko, 2014).

Each row meets each background row once, along one feature order per background row: the
features switch from the background value to the row's own value in that order, and a change of
the prediction belongs to the feature that switched. Per row the values add up to its prediction
minus the mean prediction of the background.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import as_double, name
from tabloom.session import small_table

MAX_BACKGROUND = 1000


def feature_orders(n_draws: int, n_features: int, seed: int) -> list[list[int]]:
    """Per draw the step at which each feature switches; every second draw reverses the one before."""
    rng = random.Random(seed)
    orders: list[list[int]] = []
    for d in range(n_draws):
        if d % 2:
            orders.append([n_features - 1 - s for s in orders[-1]])
        else:
            steps = list(range(n_features))
            rng.shuffle(steps)
            orders.append(steps)
    return orders


def sampled_shapley(
    df: DataFrame,
    ids: Sequence[str],
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    background: DataFrame,
    seed: int = 42,
) -> DataFrame:
    """`(ids..., feature, value, phi)`.

    `ids` identify a row. `background` has the features and a `draw` number from 0; `score` adds a
    `prediction` column from the feature columns. The points of a row stay in one task, so the sums
    per feature are formed before the shuffle.
    """
    ids, features = list(ids), list(features)
    p = len(features)
    rows = background.select("draw", *[as_double(f).alias(f) for f in features]).collect()
    if not 0 < len(rows) <= MAX_BACKGROUND:
        raise ValueError(f"the background must have 1 to {MAX_BACKGROUND} rows, got {len(rows)}")
    m = len(rows)
    orders = feature_orders(m, p, seed)
    draws = small_table(
        df.sparkSession,
        [(i, orders[i], [r[f] for f in features]) for i, r in enumerate(sorted(rows, key=lambda r: r["draw"]))],
        "draw int, steps array<int>, base array<double>",
    )
    own = [f"own{i}" for i in range(p)]
    points = (
        df.select(*[name(c) for c in ids], *[as_double(f).alias(o) for f, o in zip(features, own)])
        .withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
        .join(F.broadcast(draws), "draw")
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(p))))
    )
    mixed = points.select(
        *[name(c) for c in ids],
        *own,
        "step",
        "steps",
        *[
            F.when(F.get("steps", F.lit(i)) < F.col("step"), name(o)).otherwise(F.get("base", F.lit(i))).alias(f)
            for i, (f, o) in enumerate(zip(features, own))
        ],
    )
    scored = score(mixed)
    # the point after a switch adds its prediction to that feature, the point before takes its away
    change = [
        F.sum(
            F.when(F.get("steps", F.lit(i)) == F.col("step") - 1, F.col("prediction"))
            .when(F.get("steps", F.lit(i)) == F.col("step"), -F.col("prediction"))
            .otherwise(F.lit(0.0))
        )
        for i in range(p)
    ]
    parts = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.first(own[i]).alias("value"), (change[i] / m).alias("phi"))
            for i, f in enumerate(features)
        ]
    )
    return scored.groupBy(*[name(c) for c in ids]).agg(parts.alias("parts")).select(*ids, F.inline("parts"))


def shap_summary(values: DataFrame) -> DataFrame:
    """`(feature, mean_abs_phi, mean_phi)`, most influential first."""
    return (
        values.groupBy("feature")
        .agg(F.avg(F.abs("phi")).alias("mean_abs_phi"), F.avg("phi").alias("mean_phi"))
        .orderBy(F.desc("mean_abs_phi"), "feature")
    )
