"""Checks and provenance of a training table."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions import running_sha256
from tabloom.operators.frames import is_numeric, missing, name

log = logging.getLogger(__name__)

# What a raw training table must hold.
REQUIRED_COLUMNS = ("critical_temp", "number_of_elements")
MIN_COLUMNS = 80

# Of a file, a task hashes no more than this at once: whole blocks of SHA-256. Tasks read it piece by piece.
RANGE_BYTES = 128 << 20
READ_BYTES = 4 << 20


def null_profile(df: DataFrame) -> DataFrame:
    """`(column_name, n_null)` for every column, from one aggregate."""
    counts = df.agg(*[F.count_if(missing(c, t)).alias(c) for c, t in df.dtypes])
    return counts.unpivot([], [name(c) for c in df.columns], "column_name", "n_null")


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if not is_numeric(t)]


def validate(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    min_columns: int = MIN_COLUMNS,
    null_counts: bool = True,
) -> dict[str, int]:
    """Raise `ValueError` on a broken table; return the null counts above zero, which only warn."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"the training table lacks {absent}")
    if len(df.columns) < min_columns:
        raise ValueError(f"{len(df.columns)} columns where {min_columns} are the least: is the table cut short?")
    if df.isEmpty():
        raise ValueError("the training table has no rows")
    text = non_numeric_columns(df)
    if text:
        log.warning("Non-numeric columns: %s", text)
    if not null_counts:
        return {}
    nulls = {r["column_name"]: r["n_null"] for r in null_profile(df).where("n_null > 0").collect()}
    if nulls:
        log.warning("Null values in columns: %s", nulls)
    return nulls


def manifest(df: DataFrame, source_path: str, fingerprint: str | None = None) -> DataFrame:
    """One row: path, row and column count, fingerprint of the rows and the null counts above zero."""
    counts = F.map_from_arrays(
        F.array(*[F.lit(c) for c in df.columns]),
        F.array(*[F.count_if(missing(c, t)) for c, t in df.dtypes]),
    )
    return df.agg(F.count("*").alias("row_count"), counts.alias("nulls")).select(
        F.lit(source_path).alias("source_path"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(fingerprint).cast("string").alias("fingerprint"),
        F.map_filter("nulls", lambda _, n: n > 0).alias("missing_values"),
    )


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path behind a file's URI as Spark lists it, without escapes."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, _, rest = uri.partition("://")
    host, _, path = rest.partition("/")
    system, root = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, f"{root.rstrip('/')}/{path}"


def _opens(uri: str, length: int) -> bool:
    try:
        system, path = _opened(uri)
        info = system.get_file_info(path)
        return info.is_file and info.size == length
    except (OSError, pa.ArrowException):
        return False


def _range(uri: str, length: int, start: int, size: int) -> Iterator[bytes]:
    """The bytes of a file from `start`, at most `size` of them."""
    system, path = _opened(uri)
    with system.open_input_file(path) as f:
        if f.size() != length:
            raise OSError(f"{uri} had {length} bytes when it was listed and has {f.size()} now")
        f.seek(start)
        left = min(size, length - start)
        while left:
            part = f.read(min(READ_BYTES, left))
            if not part:
                raise OSError(f"{uri} ended before its {length} bytes")
            left -= len(part)
            yield part


def _next_ranges(todo: list[tuple[str, int, int, bytes]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            states = []
            for i in ids:
                uri, length, start, state = todo[i]
                states.append(running_sha256.advance(state, start, _range(uri, length, start, size), start + size >= length))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(states, pa.binary())], ["id", "state"])

    return run


def _digests_by_range(spark: SparkSession, files: list[tuple[str, int]], size: int) -> list[tuple[str, int, str]]:
    """A round hashes the next range of every file, a task each, from the state that the round before left."""
    digests = []
    todo = [(uri, length, 0, running_sha256.START) for uri, length in files]
    while todo:
        ranges = spark.range(0, len(todo), 1, len(todo)).mapInArrow(_next_ranges(todo, size), "id long, state binary")
        met = [(*todo[r["id"]][:2], todo[r["id"]][2] + size, bytes(r["state"])) for r in ranges.collect()]  # 32 bytes a file
        digests += [(uri, length, state.hex()) for uri, length, end, state in met if end >= length]
        todo = [m for m in met if m[2] < m[1]]
    return digests


def _listed(files: DataFrame, longer_than: int) -> list[tuple]:
    large = files.where(F.col("length") > longer_than).select("path", "length", "modificationTime")
    return [tuple(r) for r in large.collect()]


def file_digests(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`(path, length, sha256)` per file.

    SHA-256 goes from block to block, so files over `range_bytes` are hashed range by range, one task after the other, when this is
    called; a file that changes meanwhile is refused. That needs OpenSSL's library and a store that `pyarrow.fs` opens by URI; without
    them such a file is one row as well, which Spark refuses beyond 2 GB.
    """
    if range_bytes < running_sha256.BLOCK or range_bytes % running_sha256.BLOCK:
        raise ValueError(f"range_bytes is a multiple of {running_sha256.BLOCK}, not {range_bytes}")
    files = spark.read.format("binaryFile").load(path)
    whole = files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = _listed(files, range_bytes)
    if not large:
        return whole
    if not (running_sha256.available() and _opens(*large[0][:2])):
        log.warning("%d files of more than %d bytes are read whole", len(large), range_bytes)
        return whole
    digests = _digests_by_range(spark, [f[:2] for f in large], range_bytes)
    changed = {*large} - {*_listed(spark.read.format("binaryFile").load(path), range_bytes)}
    if changed:
        raise OSError(f"{min(changed)[0]} changed while it was hashed")
    return whole.where(F.col("length") <= range_bytes).unionByName(
        spark.createDataFrame(digests, "path string, length long, sha256 string")
    )


def row_fingerprint(df: DataFrame) -> DataFrame:
    """`(row_count, fingerprint)`: equal for equal sets of rows, whatever their order or files.

    60 bits of each row's MD5 are added as 38-digit decimals, so equal rows do not cancel out.
    """
    cells = [F.coalesce(name(c).cast("string"), F.lit("\\N")) for c in df.columns]
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *cells).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("row_count"), F.sum(row).cast("string").alias("fingerprint"))
