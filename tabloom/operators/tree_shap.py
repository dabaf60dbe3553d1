"""Exact Shapley values of tree models, along the paths of their leaves (Lundberg and others, 2020).

A feature that is not known takes both sides of a split in the shares of the training weight that went there. A leaf's value then
depends, per feature on its path, only on whether the row fits all splits on that feature; so a leaf with D features on its path has
2^D cases, whose Shapley values are worked out once, and a row only looks up its case. Rows between the same thresholds of a tree have
equal values in it, so each worker works out a row per such cell of a tree, and a data row adds up one cell per tree. Per row the values
add up to its prediction minus the weighted mean prediction of the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.boosting import MISSING, Columns, TreeModel, cell_numbers, encoded
from tabloom.operators.frames import as_double, name

#: Features on a path up to which all cases are worked out ahead; longer paths work out those of the rows.
TABLED = 8


@dataclass
class Path:
    """A leaf: its features, the interval of each, whether a gap fits, the share of weight that fits, and the leaf's value."""

    features: list[int]
    low: list[float]
    high: list[float]
    gap: list[bool]
    share: np.ndarray
    value: float
    table: np.ndarray | None = None


def leaf_paths(model: TreeModel) -> list[Path]:
    out = []
    for t in model.trees:
        waiting = [(0, {})]
        while waiting:
            v, seen = waiting.pop()
            if t.feature[v] < 0:
                f = list(seen)
                out.append(Path(f, *[[seen[x][k] for x in f] for k in range(3)], np.array([seen[x][3] for x in f]), t.value[v]))
                continue
            for u, is_left in ((t.left[v], True), (t.right[v], False)):
                low, high, gap, share = seen.get(t.feature[v], (-np.inf, np.inf, True, 1.0))
                low, high = (low, min(high, t.threshold[v])) if is_left else (max(low, t.threshold[v]), high)
                part = t.cover[u] / t.cover[v] if t.cover[v] else 0.0
                waiting.append((u, {**seen, t.feature[v]: (low, high, gap and t.missing_left[v] == is_left, share * part)}))
    for p in out:
        if 0 < len(p.features) <= TABLED:
            cases = (np.arange(1 << len(p.features))[:, None] >> np.arange(len(p.features))) & 1
            p.table = case_values(cases.astype(bool), p.share, p.value)
    return out


def case_values(fits: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley value per case and feature of a leaf that is reached by the product over features of `fits` if known, else `share`."""
    n, d = fits.shape
    out = np.empty((n, d))
    weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    for j in range(d):
        sized = np.zeros((n, d))  # summed products over sets of other known features, by their number
        sized[:, 0] = 1.0
        for k in range(d):
            if k != j:
                known = sized * fits[:, k : k + 1]
                sized *= share[k]
                sized[:, 1:] += known[:, :-1]
        out[:, j] = value * (fits[:, j] - share[j]) * (sized @ weight)
    return out


def expected_value(model: TreeModel, paths: Sequence[Path] | None = None) -> float:
    """The prediction with no feature known: the mean over the training rows, by weight."""
    return model.base + sum(p.value * float(np.prod(p.share)) for p in paths or leaf_paths(model))


def shap_matrix(paths: Sequence[Path], values: np.ndarray) -> np.ndarray:
    """Shapley values, a row per row of `values`."""
    out = np.zeros(values.shape)
    gaps = np.isnan(values)
    for p in paths:
        if not p.features:
            continue
        fits = np.empty((len(values), len(p.features)), bool)
        for k, f in enumerate(p.features):
            x = values[:, f]
            fits[:, k] = ((x > p.low[k]) & (x <= p.high[k])) | (gaps[:, f] & p.gap[k])
        if p.table is not None:
            phi = p.table[fits @ (1 << np.arange(len(p.features)))]
        else:
            phi = case_values(fits, p.share, p.value)
        out[:, p.features] += phi
    return out


class Cells:
    """The Shapley values of each tree's cells, made where they are first used; trees with too many cells keep their leaves' paths."""

    def __init__(self, model: TreeModel) -> None:
        self.model, self.trees, self.edges = model, None, []

    def __getstate__(self) -> dict:
        return {"model": self.model, "trees": None, "edges": []}

    def _work_out(self) -> None:
        model, self.trees = self.model, []
        self.edges, cut = model.recut() or ([], model.trees)
        for t in cut:
            paths, cells = leaf_paths(TreeModel(model.features, 0.0, [t], model.boosted)), t.cells() if self.edges else None
            if cells:
                used, steps, bins = cells
                values = np.zeros((len(bins), len(model.features)))
                for f in used:  # no value lies beyond an infinite threshold: that bin is a gap's
                    edges = self.edges[f]
                    values[:, f] = np.r_[edges, np.nan if np.isinf(edges[-1]) else np.inf, np.full(MISSING - len(edges), np.nan)][bins[:, f]]
                cells = used, steps, shap_matrix(paths, values)
            self.trees.append((cells, paths))

    def matrix(self, values: np.ndarray) -> np.ndarray:
        """`shap_matrix` of all leaves."""
        if self.trees is None:
            self._work_out()
        out = np.zeros(values.shape)
        columns = Columns(encoded(values, self.edges)) if self.edges else None
        for cells, paths in self.trees:
            out += cells[2][cell_numbers(cells, columns)] if cells else shap_matrix(paths, values)
        return out


def tree_shap(df: DataFrame, ids: Sequence[str], model: TreeModel) -> DataFrame:
    """`(ids..., feature, value, phi)` of every row, in one projection over batches."""
    ids, features = list(ids), list(model.features)
    shared = df.sparkSession.sparkContext.broadcast(Cells(model))
    own = df.select(F.struct(*[name(c) for c in ids]).alias("ids"), *[as_double(f).alias(f"x{i}") for i, f in enumerate(features)])
    lists = F.lit(None).cast("array<double>")
    schema = own.select("ids", lists.alias("value"), lists.alias("phi")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(features))], axis=1)
            offsets = pa.array(np.arange(len(values) + 1) * len(features), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1), from_pandas=True)) for x in (values, shared.value.matrix(values))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["ids", "value", "phi"])

    parts = [F.struct(F.lit(f).alias("feature"), F.get("value", F.lit(i)).alias("value"), F.get("phi", F.lit(i)).alias("phi")) for i, f in enumerate(features)]
    return own.mapInArrow(run, schema).select(*[F.col("ids")[c].alias(c) for c in ids], F.inline(F.array(*parts)))
