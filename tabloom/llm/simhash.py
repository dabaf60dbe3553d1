"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a bounded Hamming distance.

Candidates come from segment keys and a ring filter: of `DISTANCE` differing bits, spread over the segments of a ring, some
start has cumulative differences within its proportional budget for every chain length. Pairs that fail it are not checked
in full. Edge cases: null and wordless texts have fingerprint zero and are linked like any other; a text with fewer words
than a shingle is one shingle; rows of one id are all fingerprinted, and a component's id is the least non-null id in it;
`keep_one` passes other columns through in one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.llm.components import components
from tabloom.operators.frames import name

SEED = 42
#: Bits of each segment of the ring, from the lowest bit up.
SEGMENTS = (11, 11, 11, 11, 10, 10)
#: Beyond this size a key's fingerprints are dealt anew by further bits.
HOT = 1 << 13
#: Groups up to this size are compared by shifted arrays over the whole partition.
SMALL = 48
LOWER_TABLE = bytes(common.LOWER)


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[: len(words) - k])]
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, 1 << 14):
        pairs = zip(starts[i : i + (1 << 14)], ends[i + k - 1 : i + k - 1 + (1 << 14)])
        h = np.array([digest(line[a:b], SEED) for a, b in pairs], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """All columns of `docs` but the text, and `fp`, the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c not in (text, "fp")]
    schema = docs.select(*[name(c) for c in kept], F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words_per_shingle) for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            own = pa.array(np.array(values, np.uint64).view(np.int64))
            arrays = [batch.column(batch.schema.names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, own], names=[*kept, "fp"])

    return docs.select(*[name(c) for c in kept], name(text)).mapInArrow(run, schema)


def _pieces(values: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """Bit ranges (shift, width) of the values, side by side as one number."""
    out, at = np.zeros(len(values), np.uint64), 0
    for shift, width in cuts:
        out |= ((values >> np.uint64(shift)) & np.uint64((1 << width) - 1)) << np.uint64(at)
        at += width
    return out


def _ranges(widths: tuple[int, ...]) -> list[tuple[int, int]]:
    return list(zip(accumulate((0, *widths[:-1])), widths))


def _segments(distance: int) -> tuple[list[tuple[int, int]], int]:
    """The ring of segments, and how many of them are the same for any pair within `distance`: half of the ring."""
    if distance == 3:
        return _ranges(SEGMENTS), 3
    count = 2 * max(1, distance)
    if count > 64:
        raise ValueError("the distance must be at most 32 bits")
    return _ranges(tuple(64 // count + (i < 64 % count) for i in range(count))), count - distance


def _keys(distance: int):
    """Rows (key, sub, fp) of every choice of segments that a pair within `distance` can share."""
    ring, clean = _segments(distance)
    choices = list(combinations(ring, clean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for c, choice in enumerate(choices):
                key = common.mix(common.mix(_pieces(fps, list(choice))) + np.uint64(c))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(fps), c, np.int32)), batch.column(0)], names=["key", "choice", "fp"],
                )
    return run


def _further_keys(distance: int):
    """The members of a hot key once per choice of clean parts among the bits that the key leaves open."""
    ring, clean = _segments(distance)
    choices = list(combinations(ring, clean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, choice = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            fps = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            for c in np.unique(choice).tolist():
                mine = np.flatnonzero(choice == c)
                rest = [r for r in ring if r not in choices[c]]
                bits, parts = sum(w for _, w in rest), distance + 2
                left = _pieces(fps[mine], rest)
                cuts = _ranges(tuple(bits // parts + (i < bits % parts) for i in range(parts)))
                for s, chosen in enumerate(combinations(cuts, 2)):
                    sub = common.mix(_pieces(left, list(chosen)) * np.uint64(1024) + np.uint64(s))
                    own = common.mix(key[mine].view(np.uint64) + sub)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(fps[mine].view(np.int64))], names=["key", "fp"])
    return run


def ring_passes(difference: np.ndarray, distance: int) -> np.ndarray:
    """The ring filter on xored pairs: some start keeps every chain of consecutive segments within its budget."""
    ring, _ = _segments(distance)
    counts = [np.bitwise_count((difference >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in ring]
    m = len(ring)
    passes = np.zeros(len(difference), bool)
    for start in range(m):
        good, total = counts[start] == 0, counts[start].astype(np.int16)
        for length in range(2, m + 1):
            total = total + counts[(start + length - 1) % m]
            good &= total * m <= length * distance
        passes |= good
    return passes


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a and b; parents are roots before and after."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    difference = a ^ b
    kept = np.flatnonzero(ring_passes(difference, distance))
    return kept[np.bitwise_count(difference[kept]) <= distance]


def _group(fps: np.ndarray, distance: int) -> np.ndarray:
    """Roots within one large group of distinct fingerprints, by blocks, or by all masks where these are fewer."""
    n = len(fps)
    parent = np.arange(n)
    open_bits = [b for b in range(64) if int(np.bitwise_or.reduce(fps ^ fps[0])) >> b & 1]
    masks = sum(1 for k in range(1, distance + 1) for _ in combinations(range(len(open_bits)), k)) if n > 4096 else n
    if masks < n // 8:
        order = np.argsort(fps)
        ranked = fps[order]
        for k in range(1, distance + 1):
            for bits in combinations(open_bits, k):
                other = fps ^ np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(ranked, other), n - 1)
                found = np.flatnonzero(ranked[at] == other)
                _join(parent, found, order[at[found]])
        return parent
    rows = max(1, (1 << 20) // n)
    for first in range(0, n, rows):
        last = min(n, first + rows)
        a, b = np.divmod(np.arange((last - first) * (n - first)), n - first)
        a, b = (a + first)[b > a], (b + first)[b > a]
        near = _near(fps[a], fps[b], distance)
        _join(parent, a[near], b[near])
    return parent


def _links(distance: int):
    """Within the keys of one partition, a link from every fingerprint to the root of its set: no pairs leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        key = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in tables])
        fps = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in tables]).view(np.uint64)
        order = np.lexsort((fps, key))
        key, fps = key[order], fps[order]
        parent = np.arange(len(key))
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(edges)
        small = np.repeat(size <= SMALL, size)
        at = np.flatnonzero(small)
        k, f = key[at], fps[at]
        for lag in range(1, SMALL):
            same = np.flatnonzero(k[:-lag] == k[lag:]) if lag < len(k) else np.zeros(0, int)
            if not len(same):
                break
            near = same[_near(f[same], f[same + lag], distance)]
            _join(parent, at[near], at[near + lag])
        for g in np.flatnonzero(size > SMALL).tolist():
            low, high = int(edges[g]), int(edges[g + 1])
            parent[low:high] = _group(fps[low:high], distance) + low
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        pairs = np.unique(np.stack([fps[moved].view(np.int64), fps[parent[moved]].view(np.int64)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that span every component of pairs within `distance` bits."""
    parts = common.shuffle_partitions(prints.sparkSession)
    keyed = prints.select("fp").mapInArrow(_keys(distance), "key long, choice int, fp long")
    hot = keyed.groupBy("key", "choice").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key", "choice")
    hot = common.written(hot, "hot-keys")
    groups = keyed.select("key", "fp")
    if not hot.isEmpty():
        plain = keyed.join(hot, ["key", "choice"], "left_anti").select("key", "fp")
        further = keyed.join(hot, ["key", "choice"], "left_semi").select("key", "choice", "fp")
        groups = plain.union(further.mapInArrow(_further_keys(distance), "key long, fp long"))
    return groups.repartition(parts, "key").mapInArrow(_links(distance), "a long, b long").distinct()


def _members(docs: DataFrame, id_column: str, text: str, words_per_shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, look, fp) per document, look being a hash of the text; and rows (fp, root, component_id) per fingerprint."""
    own = docs.select(name(id_column).alias("id"), F.xxhash64(name(text)).alias("look"), name(text).alias("text"))
    prints = common.written(fingerprints(own, "text", words_per_shingle), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(least, distance))
    joined = least.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).select("fp", "least", "root")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, joined.select("fp", "root").join(ids, "root")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words_per_shingle: int = 3, distance: int = 3,
) -> DataFrame:
    """Rows (id, fp, fingerprint as 16 hex digits, component_id), one per row of `docs`."""
    prints, members = _members(docs, id_column, text, words_per_shingle, distance)
    return prints.join(members, "fp").select(
        F.col("id").alias(id_column), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words_per_shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of `docs` for each component: the least non-null id (a null id only if there is no other), then by text."""
    prints, members = _members(docs, id_column, text, words_per_shingle, distance)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "look")
    first = common.written(prints.join(members, "fp").groupBy("root").agg(F.min(order).alias("o")).select("o.no_id", "o.id", "o.look"), "kept")
    same = (F.col("own_id") == F.coalesce("id", F.lit(0))) & (F.col("own_null") == F.col("no_id")) & (F.col("own_look") == F.col("look"))
    own = docs.select(
        F.struct(*[name(c) for c in docs.columns]).alias("row"), F.coalesce(name(id_column).cast("long"), F.lit(0)).alias("own_id"),
        name(id_column).isNull().alias("own_null"), F.xxhash64(name(text)).alias("own_look"),
    )
    kept = own.join(first, same, "left_semi")
    once = Window.partitionBy("own_id", "own_null", "own_look").orderBy("own_look")
    return kept.withColumn("n", F.row_number().over(once)).where("n = 1").select(*[F.col("row")[c].alias(c) for c in docs.columns])
