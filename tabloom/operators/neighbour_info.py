"""Mutual information of each feature with the target from nearest neighbours (Kraskov, Stoegbauer and Grassberger, 2004).

For every row the distance to its k-th neighbour in (feature, target) is found, then how many rows lie nearer along each axis alone.
Rows are dealt to strips by ranges of the feature's value. A strip halves its rows along both axes down to small leaves and looks only into
those that a row's distance reaches, so equal values along one axis cost no more than others; a row whose distance reaches over the strip's edge asks the strips it reaches into (their halo) for nearer rows. Counts along
an axis are differences of two ranks, each answered by the one strip of sorted values that the bound falls into. So no task holds more
than a strip and its questions, and all features share every pass.

Values are scaled by their standard deviations, and a digest of the keys moves each by less than 1e-10, so that no two are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.columns import digest_number, key_digest
from tabloom.operators.frames import as_double, name
from tabloom.session import materialise

JITTER = 1e-10
#: Points of a leaf at most, and questions or pairs of question and leaf looked at together.
LEAF, CHUNK = 32, 1 << 16
STRIP = "strip int, feature int, rid long, x double, y double, near array<double>"
ASK = "strip int, feature int, kind int, rid long, at double, other double, r double"


def _moved(value: Column, spread: float | None, keys: Sequence[str], salt: int) -> Column:
    """A scaled value with its digest's share of JITTER."""
    u = digest_number(key_digest(salt, *[name(k) for k in keys])) / F.lit(float(1 << 60)) - 0.5
    return value / F.lit(spread or 1.0) + u * JITTER


def long_rows(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """Rows (feature number, rid, x, y) of the pairs without a gap."""
    known = df.where(as_double(target).isNotNull())
    spreads = known.agg(*[F.stddev_pop(as_double(c)) for c in (*features, target)]).first()
    y = _moved(as_double(target), spreads[len(features)], keys, len(features))
    pairs = [F.struct(F.lit(i).alias("feature"), _moved(as_double(f), spreads[i], keys, i).alias("x")) for i, f in enumerate(features)]
    wide = known.select(F.monotonically_increasing_id().alias("rid"), y.alias("y"), F.array(*pairs).alias("pairs"))
    return wide.select("rid", "y", F.inline("pairs")).where("x IS NOT NULL").select("feature", "rid", "x", "y")


class Halves:
    """Points of a strip, halved along the wider side until a leaf has at most LEAF; the last leaves may be partly empty (NaN)."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        n, levels = len(x), 0
        while n > LEAF << levels:
            levels += 1
        groups, size = 1, -(-n >> levels) << levels
        self.at = np.arange(size).reshape(1, size)
        self.x, self.y = (np.r_[c, np.full(size - n, np.nan)].reshape(1, size) for c in (x, y))
        self.boxes = []
        for level in range(levels + 1):
            box = [f.reduce(c, axis=1) for c in (self.x, self.y) for f in (np.fmin, np.fmax)]
            self.boxes.append(box)
            if level < levels:
                wide = (box[1] - box[0] >= box[3] - box[2])[:, None]
                order = np.argpartition(np.where(wide, self.x, self.y), size // 2, axis=1)
                groups, size = groups * 2, size // 2
                self.at, self.x, self.y = (np.take_along_axis(c, order, axis=1).reshape(groups, size) for c in (self.at, self.x, self.y))

    def own_reach(self, k: int) -> np.ndarray:
        """Per point the k-th least distance to others of its leaf, no less than that to others at all."""
        reach = np.full(self.at.size, np.inf)
        if self.at.shape[1] > k:
            for a in range(0, len(self.at), CHUNK // LEAF):
                x, y = self.x[a : a + CHUNK // LEAF], self.y[a : a + CHUNK // LEAF]
                d = np.maximum(np.abs(x[:, :, None] - x[:, None]), np.abs(y[:, :, None] - y[:, None]))
                d[:, np.arange(d.shape[1]), np.arange(d.shape[1])] = np.inf
                reach[self.at[a : a + len(x)].reshape(-1)] = np.partition(np.where(np.isnan(d), np.inf, d), k - 1, axis=2)[:, :, k - 1].reshape(-1)
        return reach

    def nearer(self, x: np.ndarray, y: np.ndarray, r: np.ndarray, k: int, itself: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, distance) of up to k points nearer than r to each question, nearest first; with `itself` question i is point i."""
        for a in range(0, len(x), CHUNK):
            q, node = np.arange(a, min(len(x), a + CHUNK)), np.zeros(min(len(x), a + CHUNK) - a, np.int64)
            for level, (x0, x1, y0, y1) in enumerate(self.boxes):
                if level:
                    q, node = np.repeat(q, 2), np.stack([2 * node, 2 * node + 1], axis=1).reshape(-1)
                apart = np.maximum(np.maximum(x0[node] - x[q], x[q] - x1[node]), np.maximum(y0[node] - y[q], y[q] - y1[node]))
                q, node = q[apart < r[q]], node[apart < r[q]]
            asked, found = [], []
            for b in range(0, len(q), CHUNK):
                i, leaf = q[b : b + CHUNK], node[b : b + CHUNK]
                d = np.maximum(np.abs(self.x[leaf] - x[i][:, None]), np.abs(self.y[leaf] - y[i][:, None]))
                row, column = np.nonzero((d < r[i][:, None]) & (self.at[leaf] != i[:, None]) if itself else d < r[i][:, None])
                asked.append(i[row])
                found.append(d[row, column])
            if asked:
                i, d = np.concatenate(asked), np.concatenate(found)
                order = np.lexsort((d, i))
                i, d = i[order], d[order]
                first = np.searchsorted(i, i) if len(i) else i
                kept = np.arange(len(i)) - first < k
                yield i[kept], d[kept]


def nearest(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The k least distances (the greater of both differences) from each point to others, infinite where there are no more."""
    best = np.full((len(x), k), np.inf)
    if len(x):
        halves = Halves(x, y)
        reach = np.nextafter(halves.own_reach(k)[: len(x)], np.inf)
        for i, d in halves.nearer(x, y, reach, k, itself=True):
            best[i, np.arange(len(i)) - np.searchsorted(i, i)] = d
    return best


def _by_feature(batches: Iterator[pa.RecordBatch], feature: int = 0) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns of a partition, one feature after the other; rows come sorted by it."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in table]) for i in range(table[0].num_columns)]
    cuts = np.flatnonzero(np.r_[True, columns[feature][1:] != columns[feature][:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(columns[feature][a]), [c[a:b] for c in columns]


def _strips(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        strip = TaskContext.get().partitionId()
        for f, (_, rid, x, y) in _by_feature(batches):
            near = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(nearest(x, y, k).reshape(-1)))
            fixed = [pa.array(np.full(len(x), v, np.int32)) for v in (strip, f)]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(rid), pa.array(x), pa.array(y), near], names=["strip", "feature", "rid", "x", "y", "near"])
    return run


def _bounds(strips: DataFrame, column: str) -> dict[int, tuple[np.ndarray, ...]]:
    """Per feature (strip, least, greatest, rows before it) of its strips in order: a few numbers per partition."""
    found = strips.groupBy("feature", "strip").agg(F.min(column).alias("a"), F.max(column).alias("b"), F.count("*").alias("n")).collect()
    out = {}
    for f in {r["feature"] for r in found}:
        own = sorted((r["a"], r["b"], r["strip"], r["n"]) for r in found if r["feature"] == f)
        a, b, strip, n = (np.array(c) for c in zip(*own))
        out[f] = strip, a, b, np.r_[0, np.cumsum(n)[:-1]]
    return out


def _reach(bounds, k: int):
    """Questions of rows whose k-th distance goes over their strip's edge, to every strip they reach into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strip, feature, rid, x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            r = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)[:, -1] if batch.num_rows else np.zeros(0)
            for f in np.unique(feature).tolist():
                strips, low, high, _ = bounds.value[f]
                for s, a, b in zip(strips, low, high):
                    asks = np.flatnonzero((feature == f) & (strip != s) & (x - r < b) & (x + r > a))
                    if len(asks):
                        fixed = [pa.array(np.full(len(asks), v, np.int32)) for v in (s, f, 1)]
                        yield pa.RecordBatch.from_arrays([*fixed, *[pa.array(c[asks]) for c in (rid, x, y, r)]], names=["strip", "feature", "kind", "rid", "at", "other", "r"])
    return run


def _answered(answer: Callable, schema_names: list[str]):
    """Per (strip, feature) of sorted (strip, feature, kind, at) rows: `answer(values, questions)`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in table]) for i in range(7)]
        cuts = np.flatnonzero(np.r_[True, (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1]), True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = [c[a:b] for c in columns]
            asks = np.flatnonzero(part[2] > 0)
            if len(asks):
                values = [c[part[2] == 0] for c in part]
                out = answer(int(part[0][0]), int(part[1][0]), values, [c[asks] for c in part])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=schema_names)
    return run


def _nearer(k: int):
    def answer(_, feature, values, asks):
        x, y = values[4], values[5]
        rid, at, other, r = asks[3:]
        near = list(Halves(x, y).nearer(at, other, r, k)) if len(x) else []
        rids = np.concatenate([rid[:0], *[rid[i] for i, _ in near]])
        return np.full(len(rids), feature, np.int32), rids, np.concatenate([r[:0], *[d for _, d in near]])
    return answer


def _rank_asks(bounds, axis: int):
    """Two questions per row, one to the strip that each end of its interval falls into; `other` is 1 for the upper end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, rid, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 4))
            at = batch.column(2 + axis).to_numpy(zero_copy_only=False)
            for f in np.unique(feature).tolist():
                strips, low, _, _ = bounds.value[f]
                own = np.flatnonzero(feature == f)
                for upper in (0.0, 1.0):
                    end = at[own] + (r[own] if upper else -r[own])
                    strip = strips[np.maximum(0, np.searchsorted(low, end, side="right") - 1)].astype(np.int32)
                    fixed = [pa.array(np.full(len(own), v, np.int32)) for v in (f, 1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(strip), *fixed, pa.array(rid[own]), pa.array(at[own]), pa.array(np.full(len(own), upper)), pa.array(r[own])],
                        names=["strip", "feature", "kind", "rid", "at", "other", "r"],
                    )
    return run


def _ranks(bounds):
    def answer(strip, feature, values, asks):
        v = values[4]
        rid, at, upper, r = asks[3:]
        strips, _, _, before = bounds.value[feature]
        base = int(before[np.flatnonzero(strips == strip)[0]])
        up = upper > 0
        place = np.where(up, np.searchsorted(v, at + r), np.searchsorted(v, at - r, side="right"))
        for shift in (-1, 0):  # the ends are rounded; differences decide about the values beside them
            beside = np.clip(place + shift, 0, max(0, len(v) - 1))
            inside = np.abs(v[beside] - at) < r
            exists = (place + shift >= 0) & (place + shift < len(v))
            if shift < 0:
                place = place - (exists & np.where(up, ~inside, inside))
            else:
                place = place + (exists & np.where(up, inside, ~inside & (v[beside] < at)))
        return np.full(len(rid), feature, np.int32), rid, np.where(up, 1, -1) * (base + place)
    return answer


def _counted(values: DataFrame, column: str, rows: DataFrame, axis: int, parts: int) -> DataFrame:
    """(feature, rid, count): values nearer than r along one axis, the row itself included."""
    bounds = values.sparkSession.sparkContext.broadcast(_bounds(values, column))
    held = values.select("strip", "feature", F.lit(0).alias("kind"), "rid", F.col(column).alias("at"), F.lit(0.0).alias("other"), F.lit(0.0).alias("r"))
    asks = rows.select("feature", "rid", "x", "y", "r").mapInArrow(_rank_asks(bounds, axis), ASK)
    met = held.unionByName(asks).repartition(parts, "strip", "feature").sortWithinPartitions("strip", "feature", "kind", "at")
    found = met.mapInArrow(_answered(_ranks(bounds), ["feature", "rid", "n"]), "feature int, rid long, n long")
    return found.groupBy("feature", "rid").agg(F.sum("n").alias(f"n{axis}"))


def digamma(n: Column) -> Column:
    """Digamma of a whole number, by its series six steps on."""
    m = n + 6.0
    series = F.ln(m) - 1 / (2 * m) - 1 / (12 * m * m) + 1 / (120 * m * m * m * m) - 1 / (252 * m * m * m * m * m * m)
    return series - sum(1 / (n + float(j)) for j in range(6))


def neighbour_information(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], k: int = 3) -> DataFrame:
    """`(feature, mutual_information)`, in nats, highest first; `keys` name a row. Features with k rows or fewer are left out."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = materialise(long_rows(df, list(features), target, keys), "pairs")
    strips = materialise(long.repartitionByRange(parts, "feature", "x").sortWithinPartitions("feature", "x").mapInArrow(_strips(k), STRIP), "strips")
    bounds = spark.sparkContext.broadcast(_bounds(strips, "x"))
    held = strips.select("strip", "feature", F.lit(0).alias("kind"), "rid", F.col("x").alias("at"), F.col("y").alias("other"), F.lit(0.0).alias("r"))
    asks = strips.mapInArrow(_reach(bounds, k), ASK)
    met = held.unionByName(asks).repartition(parts, "strip", "feature").sortWithinPartitions("strip", "feature", "kind", "at")
    further = met.mapInArrow(_answered(_nearer(k), ["feature", "rid", "d"]), "feature int, rid long, d double")
    more = further.groupBy("feature", "rid").agg(F.collect_list("d").alias("more"))  # at most k per strip reached into
    every = F.array_sort(F.concat("near", F.coalesce("more", F.array().cast("array<double>"))))
    rows = materialise(
        strips.join(more, ["feature", "rid"], "left").select("feature", "rid", "x", "y", F.get(every, F.lit(k - 1)).alias("r")).where("r < double('Infinity')"), "distances",
    )

    def sorted_strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for batch in batches:
            strip = pa.array(np.full(batch.num_rows, TaskContext.get().partitionId(), np.int32))
            yield pa.RecordBatch.from_arrays([strip, *batch.columns], names=["strip", "feature", "rid", "y"])

    by_y = long.select("feature", "rid", "y").repartitionByRange(parts, "feature", "y").sortWithinPartitions("feature", "y")
    y_strips = materialise(by_y.mapInArrow(sorted_strip, "strip int, feature int, rid long, y double"), "y-strips")
    counts = _counted(strips, "x", rows, 0, parts).join(_counted(y_strips, "y", rows, 1, parts), ["feature", "rid"])
    names = F.array(*[F.lit(f) for f in features])
    mi = digamma(F.count("*").cast("double")) + digamma(F.lit(float(k))) - F.avg(digamma(F.col("n0").cast("double"))) - F.avg(digamma(F.col("n1").cast("double")))
    per = counts.groupBy("feature").agg(F.greatest(F.lit(0.0), mi).alias("mutual_information"))
    return per.select(F.get(names, F.col("feature")).alias("feature"), "mutual_information").orderBy(F.desc("mutual_information"), "feature")
