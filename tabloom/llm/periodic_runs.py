"""Runs of repeated words (stretches with a period, three periods long at least) by string synchronising sets.

A stretch of words with smallest period q and length >= max(24, 3 q) that keeps its period over no neighbouring word is a run. Periods
are searched by dyadic scale: scale t = 4, 8, 16, ... proposes periods from 2 t to 4 t. A position is in the synchronising set of
scale t if the least hash of the t-word windows from there on over t + 1 starts is the first or the last of them; so it depends on 2 t words only,
and equal contexts are selected alike. Two selected positions with equal contexts of 2 t words, q apart, propose q; the words then
confirm or refuse it. Windows of period <= t / 3 are left out of the minimum: their regions are runs of smaller scales, and
periods below 8 are found by comparing the words with themselves shifted. As no two equal contexts lie closer than t / 3, a position
has a bounded number of partners.

Edge cases: null, empty and wordless texts have no words and no runs, and an empty collapsed text; short texts have no runs; a text of one word
repeated is one run of period 1; rows of equal id are worked on one by one; columns named like a result give way to it. Texts are cut to words
1 MiB at a time; the numbers of the words, some 100 bytes a word while searched, are held for a slice of 1 MiB of texts or one longer text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

#: Least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods below twice the first scale are found by shifted comparison.
FIRST_SCALE = 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RESULTS = ("n_words", "runs")
_LEFT_OUT = np.uint64(2**64 - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
Rewrite = Callable[[int | None, int], tuple[int, int] | None]


def _doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide; those over the end are of no use."""
    further = np.zeros_like(h)
    further[: max(0, len(h) - width)] = h[width:]
    return common.mix(h * _BASE + further)


def _least(values: np.ndarray, scale: int) -> np.ndarray:
    """Minimum of scale + 1 neighbours from each position on."""
    out, width = values, 1
    while width < scale:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:-1], out[1:])


def selected(h: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set of a scale from the hashes of its windows; `periodic` marks windows to leave out."""
    own = np.where(periodic, _LEFT_OUT, h)
    least = _least(own, scale)
    return np.flatnonzero((least != _LEFT_OUT) & ((least == own[: len(least)]) | (least == own[scale : scale + len(least)])))


def partners(at: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of positions with equal contexts and low <= distance < high."""
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    first, distance = [], []
    k = 1
    while k < len(at):
        d = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (d < high)
        if not near.any():
            break
        good = near & (d >= low)
        first.append(at[:-k][good])
        distance.append(d[good])
        k += 1
    return (np.concatenate(first), np.concatenate(distance)) if first else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def stretch(x: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The maximal stretch around word i that agrees with itself q words on; x ends with a word of its own."""
    a, b, step = i, i, 64
    while True:
        high = min(b + step, len(x) - q)
        unlike = np.flatnonzero(x[b:high] != x[b + q : high + q])
        if len(unlike):
            b += int(unlike[0])
            break
        b, step = high, step * 2
    step = 64
    while a > 0:
        low = max(0, a - step)
        unlike = np.flatnonzero(x[low:a] != x[low + q : a + q])
        if len(unlike):
            a = low + int(unlike[-1]) + 1
            break
        a, step = low, step * 2
    return a, b + q


def _small(x: np.ndarray, q: int) -> Iterator[tuple[int, int]]:
    """Stretches of period q and three periods at least, by comparing all words with those q on."""
    same = np.zeros(len(x) - q + 2, bool)
    np.equal(x[:-q], x[q:], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])
    a, b = edges[::2], edges[1::2]
    long = b - a >= (LEAST_PERIODS - 1) * q
    return zip(a[long].tolist(), (b[long] + q).tolist())


def find_runs(x: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in `x`: texts of the given lengths, each with a closing word that occurs nowhere else."""
    if len(x) <= LEAST_WORDS:
        return []
    runs: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()

    def take(a: int, b: int, q: int) -> None:
        if b - a >= LEAST_PERIODS * q and (a, b) not in seen:  # else it has a smaller period, found before
            seen.add((a, b))
            runs.append((a, b, q))

    for q in range(1, 2 * FIRST_SCALE):
        for a, b in _small(x, q) if len(x) > q else ():
            take(a, b, q)
    scale, own, pos, spans = FIRST_SCALE, x, np.arange(len(x)), lengths + 1
    h = common.mix((x.astype(np.int64) + 2**40).astype(np.uint64))
    width = 1
    while width < scale:
        h, width = _doubled(h, width), 2 * width
    while True:
        kept = spans > 2 * LEAST_PERIODS * scale  # a run of period 2 t takes a text of 6 t words
        if not kept.any():
            return [r for r in runs if r[1] - r[0] >= LEAST_WORDS]
        if not kept.all():
            mask = np.repeat(kept, spans)
            own, h, pos, spans = own[mask], h[mask], pos[mask], spans[kept]
        marks = np.zeros(len(x) + 1, np.int32)
        for a, b, q in runs:
            if 3 * q <= scale <= b - a:
                marks[a] += 1
                marks[b - scale + 1] -= 1
        periodic = np.cumsum(marks[:-1])[pos] > 0
        context = _doubled(h, scale)
        at = selected(h, scale, periodic)
        first, distance = partners(at, context[at], 2 * scale, 4 * scale)
        order = np.lexsort((first, distance))
        q_before, end = 0, 0
        for i, q in zip(pos[first[order]].tolist(), distance[order].tolist()):
            if q == q_before and i + q < end:
                continue  # inside the stretch that was looked at last
            a, b = stretch(x, i, q)
            q_before, end = q, b
            take(a, b, q)
        h, scale = context, 2 * scale


def repeated_from(length: int, first: int, period: int) -> np.ndarray:
    """Word numbers 0 to length - 1 with those from `first` on replaced by the first `period` of them, over and over."""
    at = np.arange(length)
    at[first:] = first + (at[first:] - first) % period
    return at


def _worker(rewrite: Rewrite | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts, ids = common.plain_text(batch.column(2)), batch.column(1)
            for a, b in common.text_slices(texts):
                words, numbers = common.numbered_words(texts.slice(a, b - a))
                parts, lengths = [], []
                for k, (own_id, own) in enumerate(zip(ids.slice(a, b - a).to_pylist(), numbers)):
                    shape = rewrite(own_id, len(own)) if rewrite else None
                    parts += [own[repeated_from(len(own), *shape)] if shape else own, np.array([-1 - k], np.int32)]
                    lengths.append(len(own))
                x, lengths = np.concatenate(parts), np.array(lengths)
                starts = np.concatenate([[0], np.cumsum(lengths + 1)])
                per_text: list[list[dict]] = [[] for _ in lengths]
                dropped = np.zeros(len(x) + 1, np.int32)
                for s, e, q in sorted(find_runs(x, lengths), key=lambda r: (r[0], r[2])):
                    k = int(np.searchsorted(starts, s, side="right")) - 1
                    per_text[k].append({"start": s - int(starts[k]), "length": e - s, "period": q})
                    dropped[s + q] += 1
                    dropped[e] -= 1
                kept = np.cumsum(dropped[:-1]) == 0
                collapsed = [
                    b" ".join(map(words.__getitem__, x[s : s + n][kept[s : s + n]].tolist()))
                    for s, n in zip(starts[:-1].tolist(), lengths.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(collapsed, pa.binary()).cast(pa.string()), pa.array(lengths, pa.int64()), pa.array(per_text, kind)],
                    names=["row", "collapsed", "n_words", "runs"],
                )
    return run


def collapse(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """All columns of `docs`, the text without the words of a run after its first period (words joined by one space), n_words and
    runs (start, length, period in words, by start, then period).

    `rewrite` may name (first, period) for an id and a number of words: the words from `first` on are then read as repetitions of
    the first `period` of them.
    """
    rest = [c for c in docs.columns if c != text]
    own = docs.select(F.struct(*[name(c) for c in rest]).alias("row"), name(id_column).cast("long").alias("own_id"), name(text).alias("own_text"))
    results = {"collapsed": F.lit(""), "n_words": F.lit(0).cast("long"), "runs": F.lit(None).cast(RUNS)}
    found = own.mapInArrow(_worker(rewrite), own.select("row").withColumns(results).schema)
    columns = [F.col("collapsed").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if c not in RESULTS]
    return found.select(*columns, *RESULTS)


def planted(own_id: int | None, n: int) -> tuple[int, int] | None:
    """Where the tenth of the texts whose crc32(id) ends in 0 are made periodic; none for a null id."""
    from zlib import crc32

    h = -1 if own_id is None else crc32(str(own_id).encode())
    g = h // 10
    return (g % n, 1 + (n - g % n) // (3 + g % 8)) if n and h % 10 == 0 else None


def _strongest(runs: Column) -> Column:
    """The run of most periods; products compare the ratios exactly, and the runs come by start and period."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_runs, the strongest run, digests of all runs and of the collapsed text) of the texts with planted repetitions."""
    own = collapse(docs.select(name(id_column).alias(id_column), name(text).alias("own_text")), id_column, "own_text", planted)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = own.withColumn("best", _strongest(F.col("runs")))
    return best.select(
        name(id_column), F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("own_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
