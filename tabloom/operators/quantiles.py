"""Exact order statistics and quantiles of columns of any length.

A sketch scan gives each wanted rank a narrow value range. A second scan then replaces every
value outside the ranges by one stand-in per gap, which keeps the order, and counts equal values
before the shuffle: what is left to sort is the about one percent of rows inside the ranges. While ranges
hold more than `order_rows` values, all of them are narrowed together, two scans a round whatever the number of columns and
ranks; each round leaves about a hundredth. A rank found outside its range (the sketch can be wrong) is searched again, so
results are always exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.frames import as_double, name
from tabloom.operators.grids import CELLS, RANK_ERROR, Grid, quantile_grids
from tabloom.session import small_table

ORDER_ROWS = 5_000_000
# Share of the rows a range around a rank holds: twice the rank error and the cells it ends in.
RANGE_SHARE = 2 * (RANK_ERROR + 1 / CELLS)


@dataclass(frozen=True)
class Search:
    column: str
    rank: int
    lo: float
    hi: float
    inside: float


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], order_rows: int = ORDER_ROWS
) -> dict[tuple[str, float], float]:
    """{(column, prob): value}, interpolated linearly between neighbouring ranks. Columns without values are left out."""
    grids = quantile_grids(df, columns)
    positions = {(c, p): p * (g.n - 1) for c, g in grids.items() if g.n for p in map(float, probs)}
    ranks = {(c, r) for (c, _), pos in positions.items() for r in (math.floor(pos), math.ceil(pos))}
    values = order_values(df, ranks, grids, order_rows)
    out = {}
    for (c, p), pos in positions.items():
        low, high = values[c, math.floor(pos)], values[c, math.ceil(pos)]
        share = pos - math.floor(pos)
        out[c, p] = low if share == 0 else low * (1 - share) + high * share
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], order_rows: int = ORDER_ROWS
) -> DataFrame:
    """`(feature, prob, value)`."""
    found = column_quantiles(df, columns, probs, order_rows)
    rows = [(c, p, float(v)) for (c, p), v in found.items()]
    return small_table(df.sparkSession, rows, "feature string, prob double, value double")


def order_values(
    df: DataFrame, ranks: set[tuple[str, int]], grids: Mapping[str, Grid], order_rows: int = ORDER_ROWS
) -> dict[tuple[str, int], float]:
    """{(column, rank): value} for 0-based ranks among the non-missing values."""
    found: dict[tuple[str, int], float] = {}
    open_: list[Search] = []
    for c, r in ranks:
        g = grids[c]
        if r <= 0 or g.lo == g.hi:
            found[c, r] = g.lo
        elif r >= g.n - 1:
            found[c, r] = g.hi
        else:
            lo, hi = g.around(r)
            open_.append(Search(c, r, lo, hi, RANGE_SHARE * g.n))
    while open_:
        wide = [s for s in open_ if s.inside > order_rows and s.lo < s.hi]
        if wide:
            open_ = [s for s in open_ if s not in wide] + _narrowed(df, grids, wide)
            continue
        picked = _pick(df, open_)
        missed = []
        for s in open_:
            value = picked[s.column, s.rank]
            if s.lo <= value <= s.hi:
                found[s.column, s.rank] = value
            else:
                g = grids[s.column]
                missed.append(replace(s, lo=g.lo, hi=g.hi, inside=g.n))
        open_ = missed
    return found


def _narrowed(df: DataFrame, grids: Mapping[str, Grid], searches: Sequence[Search]) -> list[Search]:
    """Two scans for all searches: a grid of the values inside each range to cut with, and exact counts below each range."""
    ranges = sorted({(s.column, s.lo, s.hi) for s in searches})
    at = {r: f"v{i}" for i, r in enumerate(ranges)}
    inside = df.select(*[F.when(as_double(c).between(lo, hi), as_double(c)).alias(v) for (c, lo, hi), v in at.items()])
    cells = quantile_grids(inside, list(at.values()))
    below = df.agg(*[F.count_if(as_double(c) < lo).alias(v) for (c, lo, _), v in at.items()]).first()
    return [_cut(s, cells[at[s.column, s.lo, s.hi]], below[at[s.column, s.lo, s.hi]], grids[s.column]) for s in searches]


def _cut(s: Search, g: Grid, below: int, whole: Grid) -> Search:
    at = s.rank - below
    if not 0 <= at < g.n:
        return replace(s, lo=whole.lo, hi=whole.hi, inside=whole.n)
    if at == 0 or at == g.n - 1 or g.lo == g.hi:
        edge = g.lo if at == 0 else g.hi
        return replace(s, lo=edge, hi=edge, inside=1)
    lo, hi = g.around(at)
    # a range of one repeated value counts as one entry once equal values are merged
    return replace(s, lo=lo, hi=hi, inside=1 if lo == hi else RANGE_SHARE * g.n)


def _merged(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _snapped(v: Column, spans: list[tuple[float, float]]) -> Column:
    """`v` inside the spans, else a stand-in of the gap it lies in; order is kept."""
    expr = F.when(v.isNull(), F.lit(None).cast("double"))
    before = None
    for lo, hi in spans:
        gap = float("-inf") if before is None else before / 2 + lo / 2
        expr = expr.when(v < lo, F.lit(gap)).when(v <= hi, v)
        before = hi
    return expr.otherwise(F.lit(float("inf")))


def _pick(df: DataFrame, searches: list[Search]) -> dict[tuple[str, int], float]:
    columns = sorted({s.column for s in searches})
    spans = {c: _merged([(s.lo, s.hi) for s in searches if s.column == c]) for c in columns}
    wide = df.select(*[_snapped(as_double(c), spans[c]).alias(c) for c in columns])
    counts = (
        wide.unpivot([], [name(c) for c in columns], "feature", "value")
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    upto = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    wanted = small_table(
        df.sparkSession, [(s.column, s.rank) for s in searches], "feature string, rank bigint"
    )
    rows = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .join(F.broadcast(wanted), "feature")
        .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        .select("feature", "rank", "value")
        .collect()
    )
    return {(r["feature"], r["rank"]): r["value"] for r in rows}
