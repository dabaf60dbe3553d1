"""Zero mean and unit population deviation, except for skipped columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import double_sql, name
from tabloom.session import small_table


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    mean: tuple[float, ...]
    sd: tuple[float, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """One projection; columns outside the fit pass through in place."""
        of = {c: (m, s) for c, m, s in zip(self.columns, self.mean, self.sd)}
        return df.select(
            *[
                ((name(c).cast("double") - F.lit(of[c][0])) / F.lit(of[c][1])).alias(c) if c in of else name(c)
                for c in df.columns
            ]
        )

    def table(self, spark) -> DataFrame:
        rows = zip(self.columns, self.mean, self.sd)
        return small_table(spark, rows, "feature string, mean double, sd double")


def scale_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(feature, mean, sd)` from one wide aggregate; a constant column gets deviation 1, one without values is left out."""
    wide = df.selectExpr(*[f"{double_sql(c)} AS c{i}" for i, c in enumerate(columns)])
    stats = wide.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.avg(f"c{i}").alias("mean"),
            # min = max marks a constant column whatever rounding the deviation shows
            F.when(F.min(f"c{i}") == F.max(f"c{i}"), F.lit(1.0)).otherwise(F.stddev_pop(f"c{i}")).alias("sd"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    return stats.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))]))).where("mean IS NOT NULL")


def scaler_of(cells: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> Scaler:
    """The scaler from cells of `pair_moments` instead of another scan."""
    diagonal = {r["i"]: r for r in cells.where("i = j").collect()}
    fitted = []
    for i, c in enumerate(columns):
        if c in skip:
            continue
        r = diagonal[i]
        variance = max(0.0, r["cxx"]) / r["n"] if r["n"] else 0.0
        flat = r["lo"] == r["hi"] or variance == 0.0
        fitted.append((c, r["hi"] if r["n"] and flat else r["mx"] if r["n"] else 0.0, 1.0 if flat else math.sqrt(variance)))
    return Scaler(tuple(c for c, _, _ in fitted), tuple(float(m) for _, m, _ in fitted), tuple(s for _, _, s in fitted))


def fit_scaler(df: DataFrame, skip: Sequence[str] = ()) -> Scaler:
    columns = [c for c in df.columns if c not in skip]
    if not columns:
        return Scaler((), (), ())
    stats = {r["feature"]: r for r in scale_stats(df, columns).collect()}
    known = {c: (stats[c]["mean"], stats[c]["sd"]) if c in stats else (0.0, 1.0) for c in columns}
    return Scaler(tuple(columns), tuple(known[c][0] for c in columns), tuple(known[c][1] for c in columns))
