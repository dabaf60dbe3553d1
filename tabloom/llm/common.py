"""Helpers shared by the operators on text: named columns, slices of Arrow batches, words as byte runs and their hashes."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.frames import name
from tabloom.session import shared_dir

WHITE = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes of text worked on at a time; bounds the arrays of a task.
SLICE = 1 << 20
#: Characters by which texts of one id are ordered before their digests decide; the sample behind the ranges holds no more of a text.
PREFIX = 256

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_WORD = np.ones(256, dtype=bool)
_WORD[list(WHITE)] = False
NOT_WHITE = _WORD
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
LOWER_ALNUM = _ALNUM
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a wide step deals its rows to; the session setting grows with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def working_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors reach."""
    return shared_dir(spark, label)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a table in the shared folder, read back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = working_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(column: str) -> Column:
    """crc32 of the id as text modulo 3; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(name(column).cast("string"), F.lit("")).cast("binary")), F.lit(3)).cast("int")


def nested(docs: DataFrame, text: str) -> DataFrame:
    """Rows (row, own_text): all columns as one struct, whatever their names, beside the text that is worked on."""
    return docs.select(F.struct(*[name(c) for c in docs.columns]).alias("row"), name(text).alias("own_text"))


def unnested(df: DataFrame, docs: DataFrame, *results: Column, names: tuple[str, ...] = (), without: tuple[str, ...] = ()) -> DataFrame:
    """The columns of `docs` out of the struct and the results after them; a column named like a result gives way to it."""
    kept = [c for c in docs.columns if c not in names and c not in without]
    return df.select(*[F.col("row")[c].alias(c) for c in kept], *[r.alias(n) for r, n in zip(results, names)])


def numbered(docs: DataFrame, id_column: str, text: str, parts: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows (did, copy, again, id, text, row), the same rows dealt for joins, and the columns that such joins need.

    did is the id, null as the smallest long. Where ids repeat, copy tells the texts of one did apart and rises with them; `again`
    marks all rows but one of those with equal did and text. `row` is a struct of all columns, whatever their names, with the text
    left out: it is null there only if the text is. Texts are named by digest, so that rows of one id need not meet in one task;
    only texts of repeated ids are ordered, one of each, by their first PREFIX characters and then by digest, in ranges of both.
    """
    spark = docs.sparkSession
    rest = F.struct(*[
        F.when(name(c).isNotNull(), F.lit("")).alias(c) if c == text else name(c).alias(c) for c in docs.columns
    ])
    least = F.lit(-(2**63)).cast("long")
    own = docs.select(
        F.coalesce(name(id_column).cast("long"), least).alias("did"), name(id_column).cast("long").alias("id"),
        F.coalesce(name(text), F.lit("")).alias("text"), rest.alias("row"),
    )
    repeated = written(own.groupBy("did").count().where("count > 1").select("did"), "repeated")
    if repeated.isEmpty():
        single = {"copy": F.lit(0).cast("long"), "again": F.lit(False)}
        return own.withColumns(single), own.repartition(parts, "did").withColumns(single), ["did"]
    known = F.col("id").isNotNull()
    digest = F.unhex(F.sha2(F.concat(known.cast("string"), "text").cast("binary"), 256))
    own = written(own.withColumns({"digest": digest, "place": F.monotonically_increasing_id()}), "rows")
    texts = (
        own.join(repeated, "did", "left_semi").groupBy("did", known.alias("known"), "digest")
        .agg(F.min("place").alias("lead"), F.first("text").alias("text"))
        .select("did", "known", F.substring("text", 1, PREFIX).alias("start"), "digest", "lead")
        .repartitionByRange(parts, "did", "known", "start", "digest").sortWithinPartitions("did", "known", "start", "digest")
    )
    copies = written(texts.select("did", "digest", "lead", F.monotonically_increasing_id().alias("copy")), "copies")
    named = own.join(copies, ["did", "digest"], "left").select(
        "did", F.coalesce("copy", F.lit(0)).alias("copy"), F.coalesce(F.col("place") != F.col("lead"), F.lit(False)).alias("again"), "id", "text", "row",
    )
    return named, named, ["did", "copy"]


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about `limit` bytes each; a longer text stands alone."""
    offsets = text_offsets(column)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def plain_text(column: pa.Array) -> pa.Array:
    """The column as one string array with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return pa.compute.fill_null(column, "") if column.null_count else column


def text_offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + len(column) + 1)[column.offset :]


def text_bytes(column: pa.Array) -> np.ndarray:
    """All bytes of the column's data buffer; `text_offsets` index it."""
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)


def word_blocks(text: bytes | memoryview, limit: int = SLICE, lower: bool = False) -> Iterator[list[bytes]]:
    """The words of a text between white space, from about `limit` bytes of it at a time; `lower` turns A-Z to a-z."""
    first, size = 0, len(text)
    while first < size:
        last = first + limit
        if last < size:
            gap = _GAP.search(text, last)
            last = gap.start() if gap else size
        part = bytes(text[first:last])
        yield (part.lower() if lower else part).split()
        first = last


def numbered_words(texts: pa.Array, lower: bool = False) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of a slice of texts by first place, and per text the numbers of its words."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    out = []
    for text in texts.cast(pa.large_binary()):
        parts = [np.fromiter(map(numbers.__getitem__, b), np.int32, len(b)) for b in word_blocks(text.as_buffer(), lower=lower)]
        out.append(parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts]))
    return list(numbers), out


def runs(member: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true cells; none goes over a position in `cuts`."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = member.copy()
    begins[1:] &= ~member[:-1]
    inner = cuts[(cuts > 0) & (cuts < n)]
    begins[inner] = member[inner]
    closes = member.copy()
    closes[:-1] &= ~member[1:]
    closes[inner - 1] = member[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(closes) + 1


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * SLICE)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _INVERSE)], dtype=np.uint64)
        return self.up, self.down


POWERS = _Powers()


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run, the same wherever the run stands."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = POWERS.to(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=total[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def window_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every window of `length` consecutive items."""
    n = len(items) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = items[:n].copy()
    for k in range(1, length):
        total *= _BASE
        total += items[k : k + n]
    return mix(total)
