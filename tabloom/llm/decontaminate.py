"""Benchmark decontamination: a broadcast set of hashed test windows is looked up at every window of the documents.

A hash hit counts only after its words were compared. Edge cases: null and wordless texts have no words and no hits; an item
without words has no window, a shorter item is one window of all its words; rows of one item id are one item, a null item id
is the text `null`; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm import common
from tabloom.operators.frames import name

#: Bytes of benchmark text whose windows are broadcast at a time; a larger benchmark takes several scans.
BROADCAST_BYTES = 16 << 20
#: Bytes of one item that are dealt together; a longer item is cut into runs of words that overlap by a window less one word.
PIECE_BYTES = 1 << 20
FOUND = ("n_words", "hit_spans", "items")
SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


def words_of(text: bytes) -> list[bytes]:
    data = common.LOWER[np.frombuffer(text, np.uint8)]
    starts, ends = common.runs(common.LOWER_ALNUM[data], np.zeros(0, np.int64))
    flat = data.tobytes()
    return [flat[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class WindowSet:
    """Hashed windows of benchmark items: per window length the sorted hashes, and the words with their items."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int) -> None:
        self.names = sorted({str(i) if i is not None else "null" for i, _ in items})
        number = {n: k for k, n in enumerate(self.names)}
        self.owners: dict[bytes, set[int]] = {}
        lengths: dict[int, set[int]] = {}
        for item, text in items:
            words = words_of((text or "").encode())
            if not words:
                continue
            n = min(width, len(words))
            hashes = common.window_hashes(self._hashes(words), n)
            for i, h in enumerate(hashes.tolist()):
                self.owners.setdefault(b" ".join(words[i : i + n]), set()).add(number[str(item) if item is not None else "null"])
                lengths.setdefault(n, set()).add(h)
        self.lengths = {n: np.array(sorted(h), np.uint64) for n, h in sorted(lengths.items())}
        self.sieves = {}
        for n, h in self.lengths.items():
            sieve = np.zeros(1 << 16, bool)
            sieve[(h >> np.uint64(48)).astype(np.int64)] = True
            self.sieves[n] = sieve

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(w) for w in words])
        return common.word_hashes(np.frombuffer(b"".join(words), np.uint8), np.r_[0, ends[:-1]], ends)


def _scan(window_set: WindowSet, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Per document its number of words, the hit runs of words and the items that occur."""
    starts, ends = common.runs(common.LOWER_ALNUM[data], offsets)
    hashes = common.word_hashes(data, starts, ends)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(offsets) - 1), side="left")
    count = np.bincount(doc, minlength=len(offsets) - 1).astype(np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(count))]
    items: list[set[int]] = [set() for _ in range(len(count))]
    for n, known in window_set.lengths.items():
        here = common.window_hashes(hashes, n)
        if not len(here):
            continue
        maybe = np.flatnonzero(window_set.sieves[n][(here >> np.uint64(48)).astype(np.int64)] & (doc[: len(here)] == doc[n - 1 :]))
        place = np.minimum(np.searchsorted(known, here[maybe]), len(known) - 1)
        for i in maybe[known[place] == here[maybe]].tolist():
            words = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + n], ends[i : i + n]))
            owners = window_set.owners.get(words)
            if owners:
                d = int(doc[i])
                spans[d].append((int(i - first[d]), int(i - first[d]) + n))
                items[d] |= owners
    return count, [merged(s) for s in spans], [[window_set.names[k] for k in sorted(i)] for i in items]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching half-open runs as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 10) -> DataFrame:
    """All columns of `docs` and n_words, hit_spans (half-open runs of word numbers), items (their ids as text).

    The benchmark is broadcast in slices of a checked size: each further slice is one more scan of the documents, with the
    hits so far written to the shared folder.
    """
    spark = docs.sparkSession
    tests, slices = dealt(benchmark, item, item_text, width)
    out = common.nested(docs, text).select(
        "*", F.lit(0).cast("long").alias("n"), F.array().cast(SPAN).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    for k in range(slices):
        some = tests.where(_slice(slices) == k).select("item", "words")  # within BROADCAST_BYTES
        window_set = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in some.collect()], width))
        out = out.mapInArrow(_marker(window_set), out.schema)
        if k + 1 < slices:
            out = common.written(out, "decontaminate")
    return common.unnested(out, docs, F.col("n"), F.col("spans"), F.col("items"), names=FOUND)


def item_pieces(width: int):
    """(item, words) to pieces of about PIECE_BYTES that share width - 1 words; every window lies whole in a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                texts = [text]
                if text is not None and len(text) > PIECE_BYTES:
                    words = words_of(text)
                    step = max(width, PIECE_BYTES * len(words) // len(text)) if words else 1
                    texts = [b" ".join(words[k : k + step + width - 1]) for k in range(0, max(1, len(words) - width + 1), step)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(texts), pa.string()), pa.array(texts, pa.binary()).cast(pa.string())], names=["item", "words"])
    return run


def _slice(slices: int) -> Column:
    return F.pmod(F.xxhash64("item", "words"), F.lit(slices))


def dealt(benchmark: DataFrame, item: str, item_text: str, width: int) -> tuple[DataFrame, int]:
    """The distinct pieces of a benchmark, and a number of slices none of which exceeds BROADCAST_BYTES (or two pieces)."""
    own = benchmark.select(name(item).cast("string").alias("item"), name(item_text).alias("words")).distinct()
    pieces = own.mapInArrow(item_pieces(width), "item string, words string").distinct()
    total, longest = pieces.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)), F.coalesce(F.max(F.octet_length("words")), F.lit(0))).first()
    slices = -(-total // BROADCAST_BYTES) or 1
    while slices > 1:
        largest = pieces.groupBy(_slice(slices)).agg(F.sum(F.octet_length("words")).alias("n")).agg(F.max("n")).first()[0]
        if largest <= max(BROADCAST_BYTES, 2 * longest):
            break
        slices *= 2
    return pieces, slices


def _marker(window_set):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = common.plain_text(batch.column(1))
            numbers, spans, items = [], [], []
            for a, b in common.text_slices(column):
                offsets = common.text_offsets(column)[a : b + 1]
                data = common.LOWER[common.text_bytes(column)[offsets[0] : offsets[-1]]]
                n, s, i = _scan(window_set.value, data, offsets - offsets[0])
                numbers.append(n)
                spans += s
                items += i
            arrays = dict(zip(batch.schema.names, batch.columns))
            if batch.num_rows:
                before_s, before_i = arrays["spans"].to_pylist(), arrays["items"].to_pylist()
                spans = [merged(s + [(x["first"], x["last"]) for x in o]) if o else s for s, o in zip(spans, before_s)]
                items = [sorted({*i, *o}) if o else sorted(i) for i, o in zip(items, before_i)]
            spans_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            arrays["n"] = pa.array(np.concatenate(numbers) if numbers else [], pa.int64())
            arrays["spans"] = pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], spans_type)
            arrays["items"] = pa.array(items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
    return run


def hit_words() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda t, s: t + s["last"] - s["first"])


def drop_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without those that hold an occurrence of a benchmark window."""
    return common.unnested(_marked(docs, benchmark, **options).where(F.size("hit_spans") == 0), docs)


def _marked(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    return mark(common.nested(docs, text), benchmark, text="own_text", **options)


def without(raw: bytes, spans: list[dict]) -> bytes:
    """A text without hit runs of words, from the first to the last byte of each."""
    if not spans:
        return raw
    data = common.LOWER[np.frombuffer(raw, np.uint8)]
    starts, ends = common.runs(common.LOWER_ALNUM[data], np.zeros(0, np.int64))
    kept, at = [], 0
    for s in spans:
        kept.append(raw[at : starts[s["first"]]])
        at = int(ends[s["last"] - 1])
    return b"".join([*kept, raw[at:]])


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
        kept = [None if t is None else without(t, s) for t, s in zip(texts, spans)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string())], names=["row", "kept"])


def drop_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` with every hit run of words, from its first to its last byte, cut out of the text."""
    marked = _marked(docs, benchmark, text=text, **options).select("row", "own_text", "hit_spans")
    cut = marked.mapInArrow(_cutter, marked.select("row", F.col("own_text").alias("kept")).schema)
    return cut.select(*[F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One digest row per document of what `mark` found."""
    marked = mark(docs.select(name(id_column).alias(id_column), name(text).alias("own_text")), benchmark, text="own_text")
    return marked.select(
        name(id_column), "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
    )
