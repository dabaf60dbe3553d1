"""Regression trees on binned columns: second-order boosting with best-first growth, and random forests.

Every column is cut once at quantiles into at most MOST_BINS bins, and rows are kept as one byte a column beside target and fold, in
the shared folder; all trees, trials and folds read that table. A pass over it sums gradient and weight per open leaf, column and
bin, for all models that are being fitted; tasks sum their rows, the sums of a leaf's column meet in one task, which answers with the
best cut. So what a pass shuffles depends on leaves, columns and tasks, and what reaches the driver on leaves and columns, never on
rows.

A leaf's split depends on its rows only, so a pass opens, besides the leaf of greatest gain, those that would follow it; the tree is then
read off in the order of gains until the leaf limit, and splits that this order does not reach are dropped. The tree is that of
strict best-first growth with a few passes instead of one per leaf. Each model is a generator that asks for sums and gets cuts; one
pass answers the open questions of all of them.
"""

from __future__ import annotations

import heapq
import random
from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabloom.operators.frames import as_double, name
from tabloom.session import materialise, small_table

#: Bins per column besides the one for missing values; a bin number is one byte.
MOST_BINS, MISSING = 255, 255
#: Cells that a tree's table may have; a larger tree is walked level by level.
MOST_CELLS = 1 << 14
#: Bytes of sums that a pass may hold per task; more open leaves take further passes.
SUM_BYTES = 64 << 20
#: Trees of a model after which the kept scores are brought up to date.
REFRESH = 25
DEEPEST = 30
NODES = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, cover double, gain double"


@dataclass
class Tree:
    """Node arrays; node 0 is the root, a leaf has feature -1. Values at or below the threshold go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for column, empty in (
            (self.feature, -1), (self.cut, 0), (self.threshold, 0.0), (self.missing_left, False), (self.left, -1), (self.right, -1),
            (self.value, 0.0), (self.cover, 0.0), (self.gain, 0.0),
        ):
            column.append(empty)
        return len(self.feature) - 1

    def _walk(self, values: np.ndarray, limits: list, gaps: np.ndarray | None) -> np.ndarray:
        """The leaf of every row: all rows go down one level at a time, and stay where they are in a leaf."""
        n, p = values.shape
        node = np.zeros(n, np.int32)
        if self.feature[0] < 0 or not n:
            return node
        inner = np.array(self.feature) >= 0
        own = np.arange(len(inner), dtype=np.int32)
        feature, limit, gap = np.where(inner, self.feature, 0), np.array(limits), np.array(self.missing_left)
        left, right = (np.where(inner, side, own).astype(np.int32) for side in (self.left, self.right))
        flat, row = np.ascontiguousarray(values).reshape(-1), np.arange(n) * p
        while True:
            at = row + feature[node]
            below = flat[at] <= limit[node]
            if gaps is not None:
                below = np.where(gaps[at], gap[node], below)
            after = np.where(below, left[node], right[node])
            if (after == node).all():
                return node
            node = after

    def leaf_of_bins(self, bins: np.ndarray) -> np.ndarray:
        gaps = bins.reshape(-1) == MISSING
        return self._walk(bins, self.cut, gaps if gaps.any() else None)

    def leaf_of_values(self, values: np.ndarray) -> np.ndarray:
        gaps = np.isnan(values).reshape(-1)
        return self._walk(values, self.threshold, gaps if gaps.any() else None)

    def cells(self) -> tuple[list[int], list[np.ndarray], np.ndarray] | None:
        """The tree as a table: the features it splits, per feature what each bin adds to a cell's number, and a row of bins per cell.

        Bins of a feature that every split sends the same way are one kind, and a cell is a combination of kinds; none if there are too many.
        """
        used = sorted({f for f in self.feature if f >= 0})
        steps, kinds, number = [], [], 1
        for f in used:
            own = [v for v, g in enumerate(self.feature) if g == f]
            sides = np.arange(256)[:, None] <= np.array([self.cut[v] for v in own])
            sides[MISSING] = [self.missing_left[v] for v in own]
            _, first, kind = np.unique(sides, axis=0, return_index=True, return_inverse=True)
            steps.append(kind.reshape(-1).astype(np.intp) * number)
            kinds.append(first)
            number *= len(first)
            if number > MOST_CELLS:
                return None
        rows, left = np.zeros((number, max(used, default=0) + 1), np.uint8), np.arange(number)
        for f, first in zip(used, kinds):
            rows[:, f] = first[left % len(first)]
            left //= len(first)
        return used, steps, rows


class Columns:
    """The bins of a batch, as rows and as columns."""

    def __init__(self, bins: np.ndarray) -> None:
        self.bins, self.kept = bins, {}

    def __getitem__(self, feature: int) -> np.ndarray:
        if feature not in self.kept:
            self.kept[feature] = self.bins[:, feature].astype(np.intp)
        return self.kept[feature]


class Lookup:
    """What a tree's leaves hold, per row of bins: from the table of its cells, or by walking down a tree with too many."""

    def __init__(self, tree: Tree, held: np.ndarray) -> None:
        self.tree, self.held, self.cells = tree, held, tree.cells()
        if self.cells:
            self.held = held[tree.leaf_of_bins(self.cells[2])]

    def of(self, columns: Columns) -> np.ndarray:
        return self.held[cell_numbers(self.cells, columns) if self.cells else self.tree.leaf_of_bins(columns.bins)]


def cell_numbers(cells: tuple, columns: Columns) -> np.ndarray:
    used, steps, _ = cells
    if not used:
        return np.zeros(len(columns.bins), np.intp)
    at = steps[0][columns[used[0]]]
    for f, step in zip(used[1:], steps[1:]):
        at += step[columns[f]]
    return at


def _values(trees: Sequence[Tree]) -> list[Lookup]:
    return [Lookup(t, np.array(t.value)) for t in trees]


@dataclass(frozen=True)
class Growth:
    """What limits a tree; `leaves` 0 leaves the number to the depth."""

    leaves: int = 31
    depth: int = 6
    reg_lambda: float = 1.0
    gamma: float = 0.0
    least_leaf: float = 1.0
    least_split: float = 2.0


@dataclass
class TreeModel:
    """A sum of trees: leaf values already hold the learning rate, or the share of a forest's tree."""

    features: tuple[str, ...]
    base: float
    trees: list[Tree]
    boosted: bool = True

    def recut(self) -> tuple[list[np.ndarray], list[Tree]] | None:
        """The thresholds of each feature as edges of bins, and the trees with cuts in them; none if a feature has too many."""
        edges = [np.unique([x for t in self.trees for g, x in zip(t.feature, t.threshold) if g == f]) for f in range(len(self.features))]
        if any(len(e) >= MISSING for e in edges):
            return None
        cuts = [[int(np.searchsorted(edges[f], x)) if f >= 0 else 0 for f, x in zip(t.feature, t.threshold)] for t in self.trees]
        return edges, [replace(t, cut=c) for t, c in zip(self.trees, cuts)]

    def scores(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        if "lookups" not in self.__dict__:
            found = self.recut()
            self.lookups = found and (found[0], _values(found[1]))
        if self.lookups:
            columns = Columns(encoded(values, self.lookups[0]))
            for held in self.lookups[1]:
                out += held.of(columns)
            return out
        for t in self.trees:
            out += np.array(t.value)[t.leaf_of_values(values)]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "lookups"}  # made anew where they are used

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction`; missing values go the side that was learned for them."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.scores(np.stack([c.to_numpy(float) for c in columns], axis=1)))

        return df.withColumn("prediction", predict(*[as_double(f) for f in self.features]))

    def importances(self) -> np.ndarray:
        """Shares of the summed gains per feature; in a forest every tree counts alike."""
        out = np.zeros(len(self.features))
        for t in self.trees:
            own = np.zeros(len(self.features))
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    own[f] += g
            out += own if self.boosted or not own.sum() else own / own.sum()
        return out / out.sum() if out.sum() > 0 else out

    def node_rows(self) -> list[tuple]:
        return [
            (k, i, t.feature[i], t.threshold[i], t.missing_left[i], t.left[i], t.right[i], t.value[i], t.cover[i], t.gain[i])
            for k, t in enumerate(self.trees) for i in range(len(t.feature))
        ]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row per node: the model as a table."""
        return small_table(spark, self.node_rows(), NODES)


def encoded(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value, one byte each; gaps have their own."""
    bins = np.empty(values.shape, np.uint8)
    for i, e in enumerate(edges):
        x = values[:, i]
        bins[:, i] = np.where(np.isnan(x), MISSING, np.searchsorted(e, x, side="left"))
    return bins


def from_nodes(features: Sequence[str], base: float, rows: Sequence[Mapping], boosted: bool = True) -> TreeModel:
    """The model of a node table."""
    trees: list[Tree] = []
    for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
        if r["node"] == 0:
            trees.append(Tree())
        else:
            trees[-1].add()
        for column in ("feature", "threshold", "missing_left", "left", "right", "value", "cover", "gain"):
            getattr(trees[-1], column)[r["node"]] = r[column]
    return TreeModel(tuple(features), base, trees, boosted)


@dataclass
class Matrix:
    """A kept table (rid, y, fold, bins, scores) and the upper edges of every column's bins; scores are those of models being fitted."""

    rows: DataFrame
    features: tuple[str, ...]
    edges: list[np.ndarray]


def bin_edges(df: DataFrame, features: Sequence[str], most: int = MOST_BINS) -> list[np.ndarray]:
    """Per column the upper edges of its bins but the last: quantiles of one mergeable sketch, or all values if there are few."""
    shares = [(i + 1) / most for i in range(most)]
    sketches = [F.percentile_approx(as_double(f), shares, 20 * most).alias(f"e{i}") for i, f in enumerate(features)]
    row = df.agg(*sketches).first()
    return [np.unique(np.array(row[f"e{i}"] or [0.0]))[:-1] for i in range(len(features))]


def binned(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None, edges: list[np.ndarray] | None = None) -> Matrix:
    """Rows with a target as bins, once for all fits; missing features are kept as such."""
    features = tuple(features)
    own = df.select(
        F.monotonically_increasing_id().alias("rid"), as_double(target).alias("y"), (name(fold).cast("int") if fold else F.lit(0)).alias("fold"),
        *[as_double(f).alias(f"x{i}") for i, f in enumerate(features)],
    ).where("y IS NOT NULL")
    edges = edges if edges is not None else bin_edges(df.where(as_double(target).isNotNull()), features)
    shared = df.sparkSession.sparkContext.broadcast(edges)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(features))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _packed(encoded(values, shared.value))], names=["rid", "y", "fold", "bins"]
            )

    rows = own.mapInArrow(encode, "rid long, y double, fold int, bins binary").withColumn("scores", F.array().cast("array<double>"))
    # dealt evenly once, as every pass waits for the fullest task
    even = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return Matrix(materialise(even, "bins"), features, edges)


def _packed(bins: np.ndarray) -> pa.Array:
    n, p = bins.shape
    offsets = pa.py_buffer((np.arange(n + 1) * p).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(bins).reshape(-1))])


def _unpacked(column: pa.Array, p: int) -> np.ndarray:
    """Bins of a batch as a matrix; all rows have p bytes."""
    n = len(column)
    if not n * p:
        return np.zeros((n, p), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32, 1, 4 * column.offset)[0]
    return np.frombuffer(data, np.uint8, n * p, int(first)).reshape(n, p)


def row_share(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) per row and tree."""
    h = rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree * 7919 + 1) % 2**63)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53


# Cumulative Poisson(1) chances of 0, 1, 2, ... draws of a row.
POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


@dataclass
class Ask:
    """Open nodes of one tree, the columns to try at each, and how rows are drawn for the tree."""

    tree: Tree
    nodes: list[int]
    columns: list[list[int]]
    number: int
    subsample: float = 1.0
    bootstrap: bool = False

    def weights(self, rid: np.ndarray, seed: int) -> np.ndarray | None:
        if self.bootstrap:
            share, draws = row_share(rid, self.number, seed), np.zeros(len(rid), np.uint8)
            for chance in POISSON:
                draws += share >= chance
            return draws.astype(float)
        return None if self.subsample >= 1 else (row_share(rid, self.number, seed) < self.subsample).astype(float)


@dataclass
class Running:
    """A model being fitted: the fold it leaves out, its trees that the kept scores do not hold yet, and its questions."""

    held_out: int | None
    base: float
    steps: Generator
    trees: list[Tree] = field(default_factory=list)
    pending: list[Tree] = field(default_factory=list)
    asks: list[Ask] = field(default_factory=list)


def _raw(kept: np.ndarray | None, base: float, trees: list[Lookup], columns: Columns) -> np.ndarray:
    raw = np.full(len(columns.bins), base) if kept is None else kept.copy()
    for t in trees:
        raw += t.of(columns)
    return raw


def _kept_scores(column: pa.Array, model: int) -> np.ndarray | None:
    """Scores of one model; none before the first refresh."""
    n = len(column)
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(n, -1)[:, model] if n and len(flat) else None


def _sums(p: int, questions: list[tuple[int, int | None, float, list[Tree], list[tuple[int, Ask, int]]]], seed: int):
    """Gradient and weight per (slot, column, bin), summed over a task's rows.

    A question is (model, fold left out, base, trees beyond the kept scores, asks); an ask comes with its first slot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = {first: np.zeros((2, len(a.nodes), len(a.columns[0]), 256)) for _, _, _, _, asks in questions for first, a, _ in asks}
        slots, tried, pending = {}, {}, {model: _values(trees) for model, _, _, trees, _ in questions}
        for _, _, _, _, asks in questions:
            for first, a, _ in asks:
                places = np.full(len(a.tree.feature), -1, np.int64)
                places[a.nodes] = np.arange(len(a.nodes))
                slots[first], tried[first] = Lookup(a.tree, places), np.array(a.columns)
        for batch in batches:
            every, rid, fold = Columns(_unpacked(batch.column(3), p)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
            y, flat = batch.column(1).to_numpy(zero_copy_only=False), every.bins.reshape(-1)
            drawn: dict[tuple, np.ndarray | None] = {}
            for model, held_out, base, _, asks in questions:
                trained = fold != held_out if held_out is not None else None
                g = _raw(_kept_scores(batch.column(4), model), base, pending[model], every) - y
                for first, a, _ in asks:
                    slot, draw = slots[first].of(every), (a.number, a.subsample, a.bootstrap)
                    if draw not in drawn:
                        drawn[draw] = a.weights(rid, seed)
                    w, taken = drawn[draw], slot >= 0
                    if trained is not None:
                        taken &= trained
                    if w is not None:
                        taken &= w > 0
                    taken = np.flatnonzero(taken)
                    slot, w = slot[taken], None if w is None else w[taken]
                    gradient = g[taken] if w is None else g[taken] * w
                    columns, start, row = tried[first], slot * 256, None
                    size = 256 * len(a.nodes)
                    for j in range(columns.shape[1]):
                        if (columns[:, j] == columns[0, j]).all():
                            at = start + every[columns[0, j]][taken]
                        else:
                            row = taken * p if row is None else row
                            at = start + flat[row + columns[:, j][slot]]
                        sums[first][0, :, j] += np.bincount(at, gradient, minlength=size).reshape(-1, 256)
                        sums[first][1, :, j] += np.bincount(at, w, minlength=size).reshape(-1, 256)
        part = TaskContext.get().partitionId()
        for _, _, _, _, asks in questions:
            for first, a, _ in asks:
                s, j = np.nonzero(sums[first][1].any(-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + s, pa.int32()), pa.array(np.array(a.columns, np.int32)[s, j]), pa.array(np.full(len(s), part, np.int32)),
                        *[pa.array([x.tobytes() for x in sums[first][k, s, j]], pa.binary()) for k in (0, 1)],
                    ],
                    names=["slot", "feature", "part", "grad", "weight"],
                )
    return run


def best_cut(g: np.ndarray, n: np.ndarray, growth: Growth) -> tuple | None:
    """(gain, cut, missing goes left, left gradient and weight, right gradient and weight) of one leaf's column, the least cut of equals.

    The gain is half of G^2 / (H + lambda) of both sides less that of the whole, less gamma; H is the weight for squared errors.
    """
    lam = growth.reg_lambda
    total_g, total_n = g.sum(), n.sum()
    best = None
    for missing_left in (False, True) if n[MISSING] else (False,):
        left_g, left_n = np.cumsum(g[:MISSING]), np.cumsum(n[:MISSING])
        if missing_left:
            left_g, left_n = left_g + g[MISSING], left_n + n[MISSING]
        right_g, right_n = total_g - left_g, total_n - left_n
        fits = (np.minimum(left_n, right_n) >= growth.least_leaf) & (n[:MISSING] > 0)
        if not fits.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (left_g**2 / (left_n + lam) + right_g**2 / (right_n + lam) - total_g**2 / (total_n + lam)) - growth.gamma
        gain[~fits] = -np.inf
        k = int(np.argmax(gain))
        if best is None or gain[k] > best[0]:
            best = (float(gain[k]), k, missing_left, float(left_g[k]), float(left_n[k]), float(right_g[k]), float(right_n[k]))
    return best


def _cuts(growths: list[tuple[int, Growth]]):
    """Sorted (slot, feature, part) sums to one row per (slot, feature): the leaf's totals and its best cut there."""
    firsts = np.array([first for first, _ in growths])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, key, g, n = [], None, None, None

        def close() -> None:
            if key is not None:
                growth = growths[int(np.searchsorted(firsts, key[0], side="right")) - 1][1]
                rows.append((*key, g.sum(), n.sum(), *(best_cut(g, n, growth) or (None,) * 7)))

        for batch in batches:
            for slot, feature, _, grad, weight in zip(*[c.to_pylist() for c in batch.columns]):
                if (slot, feature) != key:
                    close()
                    key, g, n = (slot, feature), np.zeros(256), np.zeros(256)
                g, n = g + np.frombuffer(grad), n + np.frombuffer(weight)
        close()
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), *[pa.float64()] * 4]
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=CUT_NAMES)
    return run


CUT_NAMES = ["slot", "feature", "g", "n", "gain", "cut", "missing_left", "left_g", "left_n", "right_g", "right_n"]
CUT_SCHEMA = (
    "slot int, feature int, g double, n double, gain double, cut int, missing_left boolean, left_g double, left_n double, right_g double, right_n double"
)


def _pass(matrix: Matrix, rows: DataFrame, models: Mapping[int, Running], growths: Mapping[int, Growth], seed: int) -> dict[tuple[int, int], dict[int, tuple]]:
    """Answers per (model, ask): node -> (gradient, weight, best cut row or None). Asks beyond SUM_BYTES take further passes."""
    spark = rows.sparkSession
    waiting = [(m, i, a) for m, r in models.items() for i, a in enumerate(r.asks) if a.nodes]
    answers: dict[tuple[int, int], dict[int, tuple]] = {(m, i): {} for m, r in models.items() for i in range(len(r.asks))}
    while waiting:
        now, slots, used = [], 0, 0
        while waiting:
            m, i, a = waiting[0]
            each = len(a.columns[0]) * 256 * 16
            room = max(0 if now else 1, (SUM_BYTES - used) // each)
            if not room:
                break
            some = Ask(a.tree, a.nodes[:room], a.columns[:room], a.number, a.subsample, a.bootstrap)
            now.append((m, i, slots, some))
            slots, used = slots + len(some.nodes), used + len(some.nodes) * each
            if room < len(a.nodes):
                waiting[0] = (m, i, Ask(a.tree, a.nodes[room:], a.columns[room:], a.number, a.subsample, a.bootstrap))
                break
            del waiting[0]
        questions = [
            (m, models[m].held_out, models[m].base, models[m].pending, [(first, a, i) for k, i, first, a in now if k == m])
            for m in sorted({m for m, _, _, _ in now})
        ]
        sums = rows.mapInArrow(_sums(len(matrix.features), questions, seed), "slot int, feature int, part int, grad binary, weight binary")
        width = max(len(a.columns[0]) for _, _, _, a in now)
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), slots * width)
        met = sums.repartition(parts, "slot", "feature").sortWithinPartitions("slot", "feature", "part")
        found: dict[int, list] = {}
        for r in met.mapInArrow(_cuts([(first, growths[m]) for m, _, first, _ in now]), CUT_SCHEMA).collect():  # a row per open leaf and column
            found.setdefault(r["slot"], []).append(r)
        for m, i, first, a in now:
            for k, node in enumerate(a.nodes):
                own = found.get(first + k, [])
                good = [r for r in own if r["gain"] is not None and r["gain"] > 0]
                best = max(good, key=lambda r: (r["gain"], -r["feature"]), default=None)
                answers[m, i][node] = (own[0]["g"], own[0]["n"], best) if own else (0.0, 0.0, None)
    return answers


class _Growing:
    """A tree on its way: which nodes are known, and what to ask next."""

    def __init__(self, growth: Growth, edges: list[np.ndarray], ask) -> None:
        self.tree, self.growth, self.edges, self.ask = Tree(), growth, edges, ask
        self.depth, self.known, self.split = {0: 0}, {}, set()

    def _can_split(self, v: int) -> bool:
        return self.known[v][2] is not None and self.depth[v] < self.growth.depth and self.known[v][1] >= self.growth.least_split

    def wanted(self) -> tuple[list[int], bool]:
        """Leaves to split next in the order of gains, and whether the leaf limit is then reached."""
        limit, leaves, self.split = self.growth.leaves, 1, set()
        heap = [(-self.known[0][2]["gain"], 0)] if self._can_split(0) else []
        while heap and (not limit or leaves < limit):
            _, v = heapq.heappop(heap)
            self.split.add(v)
            leaves += 1
            if self.tree.feature[v] < 0:
                room = limit - leaves if limit else len(heap)
                return [v, *(u for _, u in heapq.nsmallest(max(0, room), heap) if self.tree.feature[u] < 0)], bool(limit) and leaves >= limit
            for u in (self.tree.left[v], self.tree.right[v]):
                if self._can_split(u):
                    heapq.heappush(heap, (-self.known[u][2]["gain"], u))
        return [], True

    def open(self, v: int) -> list[int]:
        """Split a leaf by its best cut; returns its children."""
        tree, best = self.tree, self.known[v][2]
        f = best["feature"]
        tree.feature[v], tree.cut[v], tree.threshold[v] = f, best["cut"], _threshold(self.edges[f], best["cut"])
        tree.missing_left[v], tree.gain[v] = best["missing_left"], best["gain"]
        tree.left[v], tree.right[v] = tree.add(), tree.add()
        for u, g, n in ((tree.left[v], best["left_g"], best["left_n"]), (tree.right[v], best["right_g"], best["right_n"])):
            self.depth[u], self.known[u] = self.depth[v] + 1, (g, n, None)
        return [tree.left[v], tree.right[v]]

    def step(self) -> Ask | None:
        """Open what is wanted until something has to be asked; none when the tree is done."""
        if not self.known:
            return self.ask(self.tree, [0])
        while True:
            wanted, last = self.wanted()
            if not wanted:
                return None
            fresh = [u for v in (wanted[:1] if last else wanted) for u in self.open(v)]
            deeper = [u for u in fresh if self.depth[u] < self.growth.depth and self.known[u][1] >= max(self.growth.least_split, 2 * self.growth.least_leaf)]
            if deeper and not last:
                return self.ask(self.tree, deeper)

    def done(self, rate: float) -> Tree:
        """The nodes that the order of gains reached, numbered parents first, with their values."""
        out, waiting, lam = Tree(), [(0, 0)], self.growth.reg_lambda
        while waiting:
            v, u = waiting.pop()
            g, n, _ = self.known[v]
            out.value[u], out.cover[u] = (-rate * g / (n + lam) if n + lam else 0.0), n
            if v in self.split and self.tree.feature[v] >= 0:
                for column in ("feature", "cut", "threshold", "missing_left", "gain"):
                    getattr(out, column)[u] = getattr(self.tree, column)[v]
                out.left[u], out.right[u] = out.add(), out.add()
                waiting += [(self.tree.right[v], out.right[u]), (self.tree.left[v], out.left[u])]
        return out


def _boosting(params: Mapping[str, object], growth: Growth, matrix: Matrix, allowed: list[int], seed: int) -> Generator:
    """Trees one after the other, each on the errors of those before."""
    share, rng = float(params.get("colsample_bytree", 1.0)), random.Random(seed)
    for k in range(int(params["n_estimators"])):
        columns = sorted(rng.sample(allowed, max(1, round(share * len(allowed))))) if share < 1 else allowed
        subsample = float(params.get("subsample", 1.0))
        growing = _Growing(growth, matrix.edges, lambda tree, nodes: Ask(tree, nodes, [columns] * len(nodes), k, subsample))
        while (ask := growing.step()) is not None:
            growing.known.update((yield [ask])[0])
        yield growing.done(float(params["learning_rate"]))


def _forest(params: Mapping[str, object], growth: Growth, matrix: Matrix, allowed: list[int], seed: int) -> Generator:
    """Trees side by side, each on its own draw of rows, with a few columns tried at every node."""
    p, n = len(allowed), int(params["n_estimators"])
    tried = {"sqrt": round(p**0.5), "log2": int(np.log2(p))}[str(params.get("max_features", "sqrt"))]
    rng = random.Random(seed)

    def asking(k: int):
        return lambda tree, nodes: Ask(tree, nodes, [sorted(rng.sample(allowed, max(1, tried))) for _ in nodes], k, bootstrap=True)

    growing = [_Growing(growth, matrix.edges, asking(k)) for k in range(n)]
    while True:
        steps = [(g, a) for g in growing if (a := g.step()) is not None]
        if not steps:
            break
        for (g, _), known in zip(steps, (yield [a for _, a in steps])):
            g.known.update(known)
    for g in growing:
        yield g.done(1.0 / n)


def _threshold(edges: np.ndarray, cut: int) -> float:
    return float(edges[cut]) if cut < len(edges) else float("inf")


def _refreshed(rows: DataFrame, p: int, models: list[tuple[float, list[Tree]]]) -> DataFrame:
    """The kept rows with the scores of all models up to now."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(base, _values(trees)) for base, trees in models]
        for batch in batches:
            bins = Columns(_unpacked(batch.column(3), p))
            raw = np.stack([_raw(_kept_scores(batch.column(4), m), base, trees, bins) for m, (base, trees) in enumerate(held)], axis=1)
            offsets = pa.array(np.arange(len(raw) + 1) * len(models), pa.int32())
            scores = pa.ListArray.from_arrays(offsets, pa.array(raw.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], scores], names=batch.schema.names)

    return materialise(rows.mapInArrow(run, rows.schema), "bins")


def growth_of(family: str, params: Mapping[str, object]) -> Growth:
    """Limits by family: a leaf limit and no regularisation for lightgbm, depth and gamma with lambda 1 for xgboost."""
    depth = int(params["max_depth"])
    if not 0 <= depth <= DEEPEST:
        raise ValueError(f"max_depth {depth} is outside 0 to {DEEPEST}")
    if family == "lightgbm":
        return Growth(int(params.get("num_leaves", 31)), depth, float(params.get("reg_lambda", 0.0)), 0.0, float(params.get("min_child_samples", 20)))
    if family == "xgboost":
        return Growth(0, depth, float(params.get("reg_lambda", 1.0)), float(params.get("gamma", 0.0)), float(params.get("min_child_weight", 1.0)))
    if family == "random_forest":
        if params.get("max_features", "sqrt") not in ("sqrt", "log2"):
            raise ValueError(f"unknown max_features '{params['max_features']}'")
        return Growth(0, depth, 0.0, 0.0, float(params.get("min_samples_leaf", 1)), float(params.get("min_samples_split", 2)))
    raise ValueError(f"unknown model family '{family}'")


@dataclass(frozen=True)
class Spec:
    """A model to fit: family, parameters, a fold to leave out, and the columns it may use (all if none are named)."""

    family: str
    params: Mapping[str, object]
    held_out: int | None = None
    features: tuple[str, ...] | None = None


def fit_models(matrix: Matrix, specs: Sequence[Spec], seed: int = 42) -> list[TreeModel]:
    """Fit all models side by side on the kept rows; they share every pass."""
    folds = {r["fold"]: (r["n"], r["s"]) for r in matrix.rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("s")).collect()}
    models: dict[int, Running] = {}
    growths: dict[int, Growth] = {}
    for m, spec in enumerate(specs):
        own = [x for f, x in folds.items() if f != spec.held_out]
        n = sum(x[0] for x in own)
        if not n:
            raise ValueError("no rows with a target")
        growths[m] = growth_of(spec.family, spec.params)
        kind = _forest if spec.family == "random_forest" else _boosting
        allowed = [matrix.features.index(f) for f in spec.features or matrix.features]
        models[m] = Running(spec.held_out, sum(x[1] for x in own) / n, kind(spec.params, growths[m], matrix, allowed, seed))
    rows, running, answers = matrix.rows.persist(StorageLevel.MEMORY_AND_DISK), set(models), {m: None for m in models}
    while running:
        for m in sorted(running):
            r = models[m]
            try:
                asked = r.steps.send(answers[m])
                while isinstance(asked, Tree):
                    r.trees.append(asked)
                    if specs[m].family != "random_forest":
                        r.pending.append(asked)
                    asked = r.steps.send(None)
                r.asks = asked
            except StopIteration:
                r.asks = []
                running.discard(m)
        if sum(len(models[m].pending) for m in running) >= REFRESH * max(1, len(running)):
            before, rows = rows, _refreshed(rows, len(matrix.features), [(r.base, r.pending) for r in models.values()])
            before.unpersist()
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            for r in models.values():
                r.pending = []
        found = _pass(matrix, rows, {m: models[m] for m in sorted(running)}, growths, seed)
        answers = {m: [found[m, i] for i in range(len(models[m].asks))] for m in running}
    rows.unpersist()
    return [_named(matrix.features, s, r) for r, s in zip(models.values(), specs)]


def _named(features: tuple[str, ...], spec: Spec, fitted: Running) -> TreeModel:
    """The model over its own features only."""
    own = tuple(spec.features or features)
    number = {features.index(f): k for k, f in enumerate(own)} | {-1: -1}
    for t in fitted.trees:
        t.feature = [number[f] for f in t.feature]
    return TreeModel(own, fitted.base, fitted.trees, spec.family != "random_forest")


def held_out_errors(matrix: Matrix, models: Sequence[TreeModel], specs: Sequence[Spec]) -> list[tuple[float, int]]:
    """(sum of squared errors, rows) of each model on the fold that it left out, all in one pass."""
    shared = matrix.rows.sparkSession.sparkContext.broadcast([(s.held_out, m.base, m.trees) for m, s in zip(models, specs)])
    p = len(matrix.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(len(shared.value)), np.zeros(len(shared.value), np.int64)
        held = [(held_out, base, _values(trees)) for held_out, base, trees in shared.value]
        for batch in batches:
            bins, fold, y = _unpacked(batch.column(3), p), batch.column(2).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for held_out in {f for f, _, _ in held}:
                own = fold == held_out
                columns, target = Columns(bins[own]), y[own]
                for k, (f, base, trees) in enumerate(held):
                    if f == held_out:
                        sums[k] += ((_raw(None, base, trees, columns) - target) ** 2).sum()
                        rows[k] += len(target)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums), pa.array(rows)], names=["model", "s", "n"])

    parts = matrix.rows.mapInArrow(run, "model int, s double, n long").groupBy("model").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    found = {r["model"]: (r["s"], r["n"]) for r in parts.collect()}
    return [found.get(k, (0.0, 0)) for k in range(len(models))]


def errors_by_round(model: TreeModel, df: DataFrame, target: str) -> DataFrame:
    """`(round, rmse)` after each tree, on the rows of `df` with a target."""
    n = len(model.trees)
    shared = df.sparkSession.sparkContext.broadcast(model)
    own = df.select(as_double(target).alias("y"), *[as_double(f).alias(f"x{i}") for i, f in enumerate(model.features)]).where("y IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(n), 0
        for batch in batches:
            values = np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(model.features))], axis=1)
            raw = np.full(len(values), shared.value.base) - batch.column(0).to_numpy(zero_copy_only=False)
            rows += len(values)
            for k, t in enumerate(shared.value.trees):
                raw += np.array(t.value)[t.leaf_of_values(values)]
                sums[k] += (raw**2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(1, n + 1), pa.int32()), pa.array(sums), pa.array([rows] * n, pa.int64())], names=["round", "s", "n"])

    parts = own.mapInArrow(run, "round int, s double, n long")
    return parts.groupBy("round").agg(F.sqrt(F.sum("s") / F.sum("n")).alias("rmse"))
