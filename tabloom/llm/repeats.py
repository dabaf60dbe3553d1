"""Repeated windows of bytes or words over a whole corpus, with candidates from sampled anchors.

Every window of `length` items has an anchor: the k-gram with the least hash in it, so equal windows have equal anchors. Anchors
that occur once are dropped; for the others the windows around them travel, as short fragments, to the shard of their anchor,
where an exact matcher (a family of suffix arrays, or an FM-index) compares them. Nothing is decided by a hash alone.

    1  anchors of each document, dealt by hash, equal ones of a batch as one entry    -> which documents ask about which anchors
    2  fragments of these documents, dealt by anchor, equal ones of a batch once      -> matcher per shard
    3  repeated windows as item ranges per document                                    -> texts without them

A hot anchor is split: each of its windows travels by its own hash. Documents are named
(did, copy) as in `common.numbered`, and lists of anchors and of ranges belong to one document; where ids are unique, texts are dealt
once, for steps 2 and 3 together. Rows that repeat id and text do not travel: they are asked about once and share the answer.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabloom.llm import common
from tabloom.operators.frames import name

NO_ID = -(2**63)
LOW40 = np.uint64((1 << 40) - 1)
#: Occurrences from which on an anchor may be hot, and the most hot anchors, the commonest ones: 8 MB of hashes are broadcast. An
#: anchor that is not hot has at most 1 / HOT_MOST of all occurrences, or fewer than HOT_LEAST.
HOT_LEAST, HOT_MOST = 2000, 1 << 20
BLOB = "bucket int, blob binary"
SPAN = "did long, copy long, first long, last long"


@dataclass(frozen=True)
class Unit:
    """What a window counts: bytes, or words."""

    length: int
    gram: int
    words: bool

    def items(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the items, document offsets in items, and the byte range of each item."""
        if not self.words:
            where = np.arange(len(data))
            return BYTE_HASH[data], offsets, where, where
        starts, ends = common.runs(common.NOT_WHITE[data], offsets)
        return common.word_hashes(data, starts, ends), np.searchsorted(starts, offsets), starts, ends

    def size(self, text: bytes) -> int:
        return len(text.split()) if self.words else len(text)


BYTE_HASH = common.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pack(*arrays) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, protocol=5), 1)


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(blob))


def gram_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k items, by doubling."""
    power, out, have, size = items, None, 0, 1
    factor = np.uint64(0xD6E8FEB86659FD93)
    while True:
        if k & size:
            if out is None:
                out, have = power, size
            else:
                n = len(items) - have - size + 1
                out = out[:n] * factor + power[have : have + n]
                have += size
        size <<= 1
        if size > k:
            return out[: len(items) - k + 1]
        n = len(items) - size + 1
        power = power[:n] * factor + power[size >> 1 : (size >> 1) + n]
        factor = np.uint64(int(factor) ** 2 & (1 << 64) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(items: np.ndarray, offsets: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (anchor, first window, number of windows, anchor hash), as item numbers."""
    none = np.zeros(0, np.int64)
    n = len(items) - unit.length + 1
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    h = gram_hashes(items, unit.gram)
    spread = h * np.uint64(0x9FB21C651E98DF25)
    key = (spread & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    inside = np.ones(n, bool)
    for end in offsets[1:-1].tolist():
        inside[max(0, end - unit.length + 1) : end] = False
    s = np.flatnonzero(inside)
    if not len(s):
        return none, none, none, np.zeros(0, np.uint64)
    at = (sliding_least(key, unit.length - unit.gram + 1)[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (s[1:] != s[:-1] + 1)])
    return at[new], s[new], np.diff(np.r_[new, len(s)]), common.mix(h[at[new]])


def pieces(items: np.ndarray, offsets: np.ndarray, unit: Unit) -> Iterator[tuple[np.ndarray, ...]]:
    """`anchors` over chunks of windows, so that a very long text needs no more memory than a short one."""
    for first in range(0, max(1, len(items)), common.SLICE):
        last = min(len(items), first + common.SLICE + unit.length - 1)
        cuts = offsets[(offsets > first) & (offsets < last)]
        at, start, count, h = anchors(items[first:last], np.r_[0, cuts - first, last - first], unit)
        yield at + first, start + first, count, h


def slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    texts = common.plain_text(batch.column(column))
    for a, b in common.text_slices(texts):
        offsets = common.text_offsets(texts)[a : b + 1]
        yield a, b, common.text_bytes(texts)[offsets[0] : offsets[-1]], offsets - offsets[0]


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    ranked = bucket[order]
    cuts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1], True]) if len(ranked) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(ranked[a]), *[x[order[a:b]] for x in arrays]


def of_document(did: np.ndarray, copy: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a document, for what needs no company there."""
    return (common.mix(did.astype(np.uint64) ^ common.mix(copy.astype(np.uint64))) % np.uint64(buckets)).astype(np.int32)


def rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def blobs(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["bucket", "blob"])


def _ask(unit: Unit, buckets: int, across: bool):
    """Step 1: entries (hash, did, copy, anchor, times) by bucket; an anchor already known as repeated sends one entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dids, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            copies = copies.astype(np.min_scalar_type(copies.max(initial=0)))  # mostly zeros
            hashes, owners, places = [], [], []
            for a, _, data, offsets in slices(batch, 2):
                items, cuts, _, _ = unit.items(data, offsets)
                for at, _, _, h in pieces(items, cuts, unit):
                    doc = np.searchsorted(cuts, at, side="right") - 1
                    hashes.append(h)
                    owners.append((a + doc).astype(np.int32))
                    places.append(at - cuts[doc])
            if not hashes:
                continue
            h, owner, at = np.concatenate(hashes), np.concatenate(owners), np.concatenate(places)
            del hashes, owners, places
            order = np.lexsort((dids[owner], h))
            h = h[order]
            owner = owner[order]
            at = at[order]
            del order
            did = dids[owner]
            new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, int)
            size = np.diff(np.r_[new, len(h)])
            last = new + size - 1
            known = did[new] < did[last] if across else size > 1
            member, leads = np.repeat(known, size), np.zeros(len(h), bool)
            leads[new[known]] = True
            times = np.ones(len(h), np.int64)
            times[new] = np.where(known, size, 1)
            sent = ~member | leads
            bucket = ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            asks = (h & LOW40)[sent], did[sent], copies[owner[sent]], at[sent], times[sent]
            found = [(b, pack("ask", *x)) for b, *x in by_bucket(bucket[sent], *asks)]
            del h, times, bucket, asks
            if member.any():
                did, copy, at = did[member], copies[owner[member]], at[member]
                found += [(b, pack("known", *x)) for b, *x in by_bucket(of_document(did, copy, buckets), did, copy, at)]
            yield blobs(found)
    return run


def _answer(across: bool):
    """Step 1, per bucket: rows (hot, did, copy, at): anchors that occur elsewhere too, and hash and number of those that may be hot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = []
        for batch in batches:
            for blob in batch.column(1):
                kind, *arrays = unpack(blob.as_buffer())
                if kind == "known":
                    yield rows(hot=np.zeros(len(arrays[0]), bool), did=arrays[0], copy=arrays[1].astype(np.int64), at=arrays[2])
                else:
                    asked.append(arrays)
        if not asked:
            return
        h, did, copy, at, times = (np.concatenate(x) for x in zip(*asked))
        del asked, batch, arrays
        order = np.lexsort((did, h))
        h = h[order]
        did = did[order]
        copy = copy[order]
        at = at[order]
        times = times[order]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[new, len(h)])
        total = np.add.reduceat(times, new)
        again = (did[new] < did[new + size - 1]) | (np.maximum.reduceat(times, new) > 1) if across else total > 1
        told = np.repeat(again, size) & (times == 1)
        yield rows(hot=np.zeros(int(told.sum()), bool), did=did[told], copy=copy[told].astype(np.int64), at=at[told])
        many = total >= HOT_LEAST
        often = total[many].astype(np.int64)
        yield rows(hot=np.ones(len(often), bool), did=h[new[many]].astype(np.int64), copy=np.zeros(len(often), np.int64), at=often)
    return run


def _send(unit: Unit, buckets: int, across: bool, hot):
    """Step 2: fragments of the repeated anchors by bucket, each text of a batch once; its later copies are settled here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dids, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            asked = batch.column(3)
            held: list[tuple] = []
            lists = asked.offsets.to_numpy()
            wanted = asked.values.to_numpy(zero_copy_only=False)
            for a, b, data, offsets in slices(batch, 2):
                low, high = lists[a], lists[b]
                if low == high:
                    continue
                items, cuts, left, right = unit.items(data, offsets)
                owner = np.repeat(np.arange(b - a), np.diff(lists[a : b + 1]))
                pairs = np.unique(cuts[owner] + wanted[low:high])
                for at, start, count, h in pieces(items, cuts, unit):
                    place = np.minimum(np.searchsorted(pairs, at), len(pairs) - 1)
                    kept = np.flatnonzero(pairs[place] == at)
                    at, start, count, h = at[kept], start[kept], count[kept], h[kept]
                    single = np.isin(h & LOW40, hot.value) if len(hot.value) else np.zeros(len(h), bool)
                    if single.any():
                        each = np.where(single, count, 1)
                        shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                        start, h, single = np.repeat(start, each) + shift, np.repeat(h, each), np.repeat(single, each)
                        count = np.where(single, 1, np.repeat(count, each))
                    doc = np.searchsorted(cuts, start, side="right") - 1
                    did, copy, begin = dids[a + doc], copies[a + doc], start - cuts[doc]
                    end = start + count + unit.length - 1
                    flat = data.tobytes()
                    if unit.words:
                        texts = [b" ".join(flat[x:y].split()) for x, y in zip(left[start].tolist(), right[end - 1].tolist())]
                    else:
                        texts = [flat[x:y] for x, y in zip(start.tolist(), end.tolist())]
                    keys = h.tolist()
                    for i in np.flatnonzero(single).tolist():
                        keys[i] = int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little")
                    held += zip(did.tolist(), copy.tolist(), begin.tolist(), count.tolist(), keys, texts)
            held.sort(key=lambda f: f[:3])  # the order in which documents count as earlier
            first_of: dict[bytes, int] = {}
            sent: list[tuple] = []
            done: list[tuple] = []
            for d, c, s, n, key, text in held:
                before = first_of.get(text)
                if before is None:
                    first_of[text] = d
                if before is None or (across and before == d):
                    sent.append((key, d, c, s, n, text))
                else:
                    done.append((d, c, s, s + n + unit.length - 1))
            found = []
            if sent:
                key, did, copy, start, count = (np.array([r[i] for r in sent], np.uint64 if i == 0 else np.int64) for i in range(5))
                number = np.arange(len(sent))
                for bucket, own in by_bucket(((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32), number):
                    texts = [sent[i][5] for i in own.tolist()]
                    found.append((bucket, pack("match", key[own], did[own], copy[own], start[own], count[own], [len(t) for t in texts], b"".join(texts))))
            if done:
                columns = np.array(done, np.int64)
                found += [(b, pack("done", x)) for b, x in by_bucket(of_document(columns[:, 0], columns[:, 1], buckets), columns)]
            if found:
                yield blobs(found)
    return run


def _match(unit: Unit, across: bool, matcher: Callable):
    """Step 2, per shard: ranges of repeated windows. Equal fragments are one class; an anchor with one class needs no search."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = []
        for batch in batches:
            for blob in batch.column(1):
                kind, *arrays = unpack(blob.as_buffer())
                if kind == "done":
                    x = arrays[0]
                    yield rows(did=x[:, 0], copy=x[:, 1], first=x[:, 2], last=x[:, 3])
                else:
                    sent.append(arrays)
        if not sent:
            return
        texts = []
        for *_, lengths, joined in sent:
            ends = np.cumsum(lengths).tolist()
            texts += [joined[b - n : b] for b, n in zip(ends, lengths)]
        key, did, copy, start, count = (np.concatenate([x[i] for x in sent]) for i in range(5))
        del sent
        order = np.lexsort((start, copy, did))
        number: dict[bytes, int] = {}
        group = np.array([number.setdefault(texts[i], len(number)) for i in order.tolist()], np.int64)
        key, did, copy, start, count = (x[order] for x in (key, did, copy, start, count))
        _, lead = np.unique(group, return_index=True)  # classes are numbered by first occurrence
        later = did > did[lead][group] if across else np.arange(len(group)) != lead[group]
        _, of_key, classes = np.unique(key[lead], return_inverse=True, return_counts=True)
        searched = np.flatnonzero(classes[of_key] > 1)  # class numbers, in order of first occurrence
        class_texts = list(number)
        hits = dict(zip(searched.tolist(), matcher([class_texts[c] for c in searched.tolist()], count[lead[searched]], did[lead[searched]], unit)))
        d, c, f, e = [], [], [], []
        whole = np.flatnonzero(later)
        for i in np.flatnonzero(~later).tolist():
            hit = hits.get(int(group[i]))
            if hit is not None and hit.any():
                edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
                for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    d.append(did[i])
                    c.append(copy[i])
                    f.append(start[i] + x)
                    e.append(start[i] + y - 1 + unit.length)
        yield rows(
            did=np.r_[did[whole], np.array(d, np.int64)], copy=np.r_[copy[whole], np.array(c, np.int64)],
            first=np.r_[start[whole], np.array(f, np.int64)], last=np.r_[start[whole] + count[whole] - 1 + unit.length, np.array(e, np.int64)],
        )
    return run


def spans(docs: DataFrame, unit: Unit, across: bool, matcher: Callable, id_column: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The numbered documents, and rows (did, copy if ids repeat, ranges): item ranges (first, last) covered by repeated windows.

    across: a window counts as repeated only if a smaller did has it; else any earlier place does.
    """
    spark = docs.sparkSession
    parts = common.shuffle_partitions(spark)
    shards = 2 * parts
    own, numbered, keys = common.numbered(docs, id_column, text, parts)
    answers = common.written(
        own.where("NOT again").select("did", "copy", "text").mapInArrow(_ask(unit, parts, across), BLOB).repartitionById(parts, F.col("bucket"))
        .mapInArrow(_answer(across), "hot boolean, did long, copy long, at long"), "anchors",
    )
    commonest = answers.where("hot").orderBy(F.desc("at"), "did").limit(HOT_MOST).select("did").toArrow()
    hot = spark.sparkContext.broadcast(np.sort(commonest.column("did").to_numpy().astype(np.uint64)))
    asked = answers.where("NOT hot").groupBy(*keys).agg(F.collect_list("at").alias("asked"))
    found = (
        # the id is read so that texts are dealt once, for this join and the one in `cut`
        numbered.where("NOT again").join(asked, keys).select("did", "copy", "text", "asked", "id")
        .mapInArrow(_send(unit, shards, across, hot), BLOB).repartitionById(shards, F.col("bucket"))
        .mapInArrow(_match(unit, across, matcher), SPAN)
    )
    whole = F.lit(False) if across else F.col("again")  # all windows of a text that an earlier row has
    return numbered.withColumn("whole", whole), found.groupBy(*keys).agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(numbered: DataFrame, ranges: DataFrame, unit: Unit, finish: Callable, schema: str) -> DataFrame:
    """`finish(text, merged ranges)` gives the values of `schema` after the other columns for each document."""
    joined = numbered.join(ranges, [c for c in ranges.columns if c != "ranges"], "left")
    rest = [c for c in numbered.columns if c not in ("did", "copy", "whole", "text")]
    joined = joined.select("whole", "text", "ranges", *rest)
    out = T.StructType([*joined.select(*rest).schema.fields, *T.StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for whole, text, ranges in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                size = unit.size(text) if whole else 0
                own = [(0, size)] if size >= unit.length else [] if whole else merged([(r["first"], r["last"]) for r in ranges or ()])
                values.append(finish(text, own))
            new = [pa.array(x, f.type) for x, f in zip(zip(*values), arrow)] if values else [pa.array([], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([*(batch.column(3 + i) for i in range(len(rest))), *new], names=[*rest, *(f.name for f in arrow)])

    return joined.mapInArrow(run, out)
