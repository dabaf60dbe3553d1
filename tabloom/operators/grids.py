"""Counts, ranges and approximate quantiles of many columns from one scan."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import double_sql

CELLS = 1024
SKETCH_K = 1600
# Rank error allowed for, as a share of the rows; about twice what a sketch of this size shows.
RANK_ERROR = 0.005
# Groups the sketches of all tasks are merged in before the last merge.
MERGES = 32


@dataclass(frozen=True)
class Grid:
    """`inner` holds the values near ranks 1/CELLS, 2/CELLS, ... of a column with `n` values in [lo, hi]."""

    n: int
    lo: float | None
    hi: float | None
    inner: tuple[float, ...]

    def at(self, cell: int) -> float | None:
        if cell <= 0:
            return self.lo
        return self.hi if cell >= CELLS else self.inner[cell - 1]

    def around(self, rank: int) -> tuple[float, float]:
        """A value range that very likely holds the given 0-based rank."""
        p = rank / max(1, self.n - 1)
        return self.at(math.floor((p - RANK_ERROR) * CELLS)), self.at(math.ceil((p + RANK_ERROR) * CELLS))

    def edges(self, cells: int = CELLS) -> list[float]:
        """Strictly increasing inner edges of at most `cells` buckets of about equal mass."""
        step = max(1, CELLS // cells)
        return sorted(set(self.inner[step - 1 :: step]))


# The ranks of the grid values as SQL: one string to fold, not a literal per rank.
CELL_RANKS = "CAST(split('" + ",".join(str(c / CELLS) for c in range(CELLS + 1)) + "', ',') AS array<double>)"


def _exprs(at: Iterable[int], *templates: str) -> list[Column]:
    return [F.expr(t.format(i=i)) for i in at for t in templates]


def quantile_grids(df: DataFrame, columns: Sequence[str]) -> dict[str, Grid]:
    """One grid per column.

    Every task sketches all columns in one pass over its rows; the sketches are merged in two
    steps, so no task receives those of all others. CELLS numbers per column reach the driver.
    """
    columns = list(columns)
    at = range(len(columns))
    wide = df.selectExpr(
        *[f"{double_sql(c)} AS c{i}" for i, c in enumerate(columns)], f"spark_partition_id() % {MERGES} AS salt"
    )
    sketched = wide.groupBy("salt").agg(*_exprs(at, f"kll_sketch_agg_double(c{{i}}, {SKETCH_K}) AS s{{i}}"))
    merged = sketched.agg(
        *_exprs(at, "kll_merge_agg_double(IF(kll_sketch_get_n_double(s{i}) > 0, s{i}, NULL)) AS s{i}")
    ).select("*", *_exprs(at, "coalesce(kll_sketch_get_n_double(s{i}), 0) AS n{i}"))
    row = merged.select(
        *_exprs(at, f"IF(n{{i}} > 0, kll_sketch_get_quantile_double(s{{i}}, {CELL_RANKS}), NULL) AS q{{i}}", "n{i}")
    ).first()
    grids = {}
    for i, c in enumerate(columns):
        n, q = row[f"n{i}"], row[f"q{i}"]
        # the first and last quantile of a sketch are the exact extremes
        grids[c] = Grid(n, q[0], q[-1], tuple(q[1:-1])) if n else Grid(0, None, None, ())
    return grids
