"""Second moments of many columns at once.

A wide table has p * (p + 1) / 2 column pairs, too many aggregate expressions for one plan (3,403 for 82 columns). Each task
instead multiplies its Arrow batches as matrices, every batch about its own means, and merges the batches pairwise: counts, means
and co-moments combine exactly whatever the level of the data, so no shift has to be known beforehand and the input is read once.
A task emits one block per group; blocks merge in two or three levels as they arrive, so a merging task holds one block. What is shuffled is tasks * groups blocks, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.frames import as_double, double_sql, name

CELLS = ("n", "mx", "my", "cxx", "cyy", "cxy")
#: A co-moment this small against the sums it came from has lost its digits and is summed again about its own mean.
LOST = 1e-4
#: Merging tasks up to which one further task per group takes all their blocks; more meet in the root of their number first.
FEW_MERGES = 64


def centre_and_span(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """(mean, min, max) per column."""
    wide = df.selectExpr(*[f"{double_sql(c)} AS c{i}" for i, c in enumerate(columns)])
    row = wide.agg(
        *[F.expr(f"{fn}(c{i}) AS {a}{i}") for i in range(len(columns)) for fn, a in (("avg", "m"), ("min", "a"), ("max", "z"))]
    ).first()
    return {c: (row[f"m{i}"], row[f"a{i}"], row[f"z{i}"]) for i, c in enumerate(columns)}


def batch_block(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cells, ends) of one batch (rows x columns, NaN for missing), pairwise over the rows where both columns have values.

    Ends are per column the least value, the negated greatest and a centre; the cells' means are counted from the centre, so that
    a high level takes no digits from them.
    """
    known = ~np.isnan(raw)
    centre = np.where(known, raw, 0.0).sum(axis=0) / np.maximum(1, known.sum(axis=0))
    x = np.where(known, raw - centre, 0.0)
    k = known.astype(float)
    square = x * x
    n = k.T @ k
    safe = np.maximum(n, 1.0)
    sx, sxx = x.T @ k, square.T @ k
    sy, syy = sx.T, sxx.T
    cxx, cyy = sxx - sx * sx / safe, syy - sy * sy / safe
    block = np.stack([n, sx / safe, sy / safe, cxx, cyy, x.T @ x - sx * sy / safe])
    lost = np.triu((n > 0) & ((cxx < sxx * LOST) | (cyy < syy * LOST)))
    for i, j in zip(*np.nonzero(lost)):
        both = known[:, i] & known[:, j]
        a, b = x[both, i], x[both, j]
        ma, mb = a.mean(), b.mean()
        a, b = a - ma, b - mb
        cell = (n[i, j], ma, mb, a @ a, b @ b, a @ b)
        block[:, i, j] = cell
        block[:, j, i] = [cell[m] for m in (0, 2, 1, 4, 3, 5)]
    ends = np.stack([np.where(known, raw, np.inf).min(axis=0), -np.where(known, raw, -np.inf).max(axis=0), centre])
    return block, ends


def merge_blocks(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Cells and ends of two sets of rows together, about the first one's centre (the other's where it has no values)."""
    (p, pe), (q, qe) = a, b
    centre = np.where(np.diagonal(p[0]) > 0, pe[2], qe[2])
    own, other = pe[2] - centre, qe[2] - centre
    px, py, qx, qy = p[1] + own[:, None], p[2] + own[None, :], q[1] + other[:, None], q[2] + other[None, :]
    n = p[0] + q[0]
    share = q[0] / np.maximum(n, 1.0)
    dx, dy, both = qx - px, qy - py, p[0] * share
    only = p[0] == 0
    cells = np.stack([
        n, np.where(only, qx, px + dx * share), np.where(only, qy, py + dy * share),
        p[3] + q[3] + dx * dx * both, p[4] + q[4] + dy * dy * both, p[5] + q[5] + dx * dy * both,
    ])
    return cells, np.stack([*np.minimum(pe[:2], qe[:2]), centre])


def _merged(batches: Iterator[pd.DataFrame], p: int) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray], int]]:
    """(group, block, least part) of rows sorted by group and part: blocks join as they come, in the order of their tasks."""
    group, held, least = None, None, 0
    for batch in batches:
        for g, part, cells, ends in zip(batch["grp"], batch["part"], batch["cells"], batch["ends"]):
            block = np.frombuffer(cells).reshape(6, p, p), np.frombuffer(ends).reshape(3, p)
            if g == group:
                held = merge_blocks(held, block)
                continue
            if held is not None:
                yield group, held, least
            group, held, least = int(g), block, int(part)
    if held is not None:
        yield group, held, least


def _packed(blocks: dict[int, tuple[np.ndarray, np.ndarray]], part: int) -> pd.DataFrame:
    return pd.DataFrame({
        "grp": list(blocks), "part": part, "cells": [c.tobytes() for c, _ in blocks.values()], "ends": [e.tobytes() for _, e in blocks.values()],
    })


def pair_moments(df: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """`(grp, i, j, n, mx, my, cxx, cyy, cxy, lo, hi)` for i <= j over rows where both columns have values.

    n rows, means and co-moments about them; lo and hi bound column i and stand on rows i = j. `grp` is 0 without a group column,
    which must hold few distinct integers (folds, splits).
    """
    p = len(columns)
    upper = np.triu_indices(p)
    keys = F.lit(0).alias("grp") if group is None else name(group).cast("int").alias("grp")
    narrow = df.select(keys, F.spark_partition_id().alias("part"), *[as_double(c).alias(f"c{k}") for k, c in enumerate(columns)])

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        part = 0
        for batch in batches:
            groups = batch["grp"].to_numpy()
            values = batch.iloc[:, 2:].to_numpy(dtype=float)
            part = int(batch["part"].iloc[0]) if len(batch) else part
            for g in np.unique(groups).tolist():
                block = batch_block(values[groups == g])
                held[g] = merge_blocks(held[g], block) if g in held else block
        if held:
            yield _packed(held, part)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, block, part in _merged(batches, p):
            yield _packed({g: block}, part)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, (block, ends), _ in _merged(batches, p):
            out = {"grp": np.full(len(upper[0]), g, dtype=np.int32), "i": upper[0].astype(np.int32), "j": upper[1].astype(np.int32)}
            out.update({c: block[m][upper] for m, c in enumerate(CELLS)})
            out["mx"], out["my"] = out["mx"] + ends[2][upper[0]], out["my"] + ends[2][upper[1]]
            known = (upper[0] == upper[1]) & (block[0][upper] > 0)
            out["lo"] = np.where(known, ends[0][upper[0]], np.nan)
            out["hi"] = np.where(known, -ends[1][upper[0]], np.nan)
            yield pd.DataFrame(out)

    packed = "grp int, part int, cells binary, ends binary"
    merges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = narrow.mapInPandas(blocks, packed)
    # the blocks of all tasks meet in `merges` tasks, many of these in the root of that, and what is left in one per group
    for tasks in [merges, *([round(merges**0.5)] if merges > FEW_MERGES else [])]:
        sums = sums.repartitionById(tasks, F.pmod("part", F.lit(tasks))).sortWithinPartitions("grp", "part").mapInPandas(join, packed)
    last = sums.repartition("grp").sortWithinPartitions("grp", "part")
    cells = last.mapInPandas(spread, "grp int, i int, j int, " + ", ".join(f"{c} double" for c in (*CELLS, "lo", "hi")))
    return cells.withColumns({c: F.expr(f"nanvl({c}, CAST(NULL AS double))") for c in ("lo", "hi")})


def collect_cells(df: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """The cells of `pair_moments` as a small local table, p * (p + 1) / 2 rows per group, read once and used for several fits."""
    cells = pair_moments(df, columns, group)
    return df.sparkSession.createDataFrame([tuple(r) for r in cells.collect()], cells.schema)
