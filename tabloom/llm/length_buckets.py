"""Packing into length buckets whose bounds a dynamic program sets on the histogram of all lengths.

Documents are cut into pieces of at most `most` tokens. The bounds minimise the padding of all pieces to their bucket's bound;
inside a bucket, batches of budget // bound pieces form in id order, numbered over the whole corpus by prefix sums. Edge cases: a
null or empty text is one piece, its end id; a null id comes first; rows of one id follow each other by length; an empty table has
no batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.llm.token_files import encoder
from tabloom.operators.frames import name

MOST, BUCKETS, BUDGET = 2048, 8, 16_384
#: Words whose ids a worker remembers: fewer than for token files alone, as packing shares its workers with other stages.
REMEMBERED = 300_000


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """At most `buckets` bounds, the last the greatest length, with the least total padding; ties to the smaller bounds."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    many, mass = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * lengths)]
    n = len(lengths)
    # padding[i, j]: lengths i .. j-1 padded to the greatest of them
    padding = lengths[None, :] * (many[None, 1:] - many[:-1, None]) - (mass[None, 1:] - mass[:-1, None])
    padding = np.where(np.arange(n)[:, None] <= np.arange(n)[None, :], padding, np.iinfo(np.int64).max // 4)
    best, choice = padding[0], []
    for _ in range(1, min(buckets, n)):
        total = np.vstack([padding[:1], best[:-1, None] + padding[1:]])
        choice.append(total.argmin(0))
        best = total.min(0)
    bounds, j = [], n - 1
    for pick in reversed(choice):
        bounds.append(int(lengths[j]))
        if not pick[j]:
            return bounds[::-1]
        j = int(pick[j]) - 1
    return [int(lengths[j]), *bounds[::-1]]


def token_counts(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_tokens): tokens of the whole text and an end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, REMEMBERED)
        for batch in batches:
            column, counts = common.plain_text(batch.column(1)), []
            for a, b in common.text_slices(column):
                counts += [len(x) // own.dtype.itemsize + 1 for x in own.encode(column.slice(a, b - a).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["id", "n_tokens"])

    return docs.select(name(id_column).cast("long").alias("id"), name(text)).mapInArrow(run, "id long, n_tokens long")


def pack(lengths: DataFrame, most: int = MOST, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Rows (id, piece, start, n_tokens, bound, batch, slot, padding) of a table (id, n_tokens).

    The histogram has `most` rows at most. Batch numbers run on from bucket to bucket. A column `row` of `lengths` is passed on.
    """
    spark = lengths.sparkSession
    also = ["row"] if "row" in lengths.columns else []
    parts = common.shuffle_partitions(spark)
    pieces = (
        lengths.where("n_tokens > 0").select("id", *also, F.col("n_tokens").alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_tokens - 1) div {most}"))).alias("piece"))
        .withColumn("start", F.col("piece") * most).withColumn("n_tokens", F.least(F.lit(most), F.col("whole") - F.col("start")))
    )
    histogram = {r["n_tokens"]: r["n"] for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    bounds = optimal_bounds(histogram, buckets)
    bound = F.lit(bounds[-1] if bounds else most).cast("long")
    for b in reversed(bounds[:-1]):
        bound = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bound)
    placed = common.written(
        pieces.withColumn("bound", bound).repartitionByRange(parts, F.col("id").asc_nulls_first(), "whole", "piece").withColumn("part", F.spark_partition_id()),
        "pieces",
    )
    per_batch = {b: max(1, budget // b) for b in bounds}
    first_batch, at = {}, 0
    for b in bounds:
        first_batch[b] = at
        low = max([0, *(x for x in bounds if x < b)])
        at += -(-sum(n for x, n in histogram.items() if low < x <= b) // per_batch[b])
    ahead = Window.partitionBy("bound").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # partitions, not rows
    bases = placed.groupBy("bound", "part").agg(F.count("*").alias("n")).select("bound", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bound", "part").orderBy(F.col("id").asc_nulls_first(), "whole", "piece")
    ranked = placed.withColumn("place", F.row_number().over(inside) - 1).join(bases, ["bound", "part"]).withColumn("place", F.col("place") + F.col("base"))
    if not bounds:
        return ranked.select("id", *also, "piece", "start", "n_tokens", "bound", F.col("place").alias("batch"), F.col("place").alias("slot"), F.col("place").alias("padding"))
    size = F.create_map(*[F.lit(x) for b in bounds for x in (b, per_batch[b])])[F.col("bound").cast("int")]
    start = F.create_map(*[F.lit(x) for b in bounds for x in (b, first_batch[b])])[F.col("bound").cast("int")]
    return ranked.select(
        "id", *also, "piece", "start", "n_tokens", "bound", (F.floor(F.col("place") / size) + start).cast("long").alias("batch"),
        F.pmod("place", size).cast("long").alias("slot"), (F.col("bound") - F.col("n_tokens")).alias("padding"),
    )


def report(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The batches of all documents' tokens."""
    lengths = common.written(token_counts(docs, tokenizer, id_column, text), "lengths")
    return pack(lengths).withColumnRenamed("id", id_column)


def packed_tokens(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", most: int = MOST, buckets: int = BUCKETS, budget: int = BUDGET,
) -> DataFrame:
    """The rows of `pack` with the token ids of each piece: `ids`, little-endian unsigned, `width` bytes each.

    Every text is encoded once into the shared folder, and a piece cuts its bytes out of its own row's, also where ids repeat.
    """
    own = encoder(tokenizer, REMEMBERED)
    width, closing = own.dtype.itemsize, np.zeros(1, own.dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, REMEMBERED)
        for batch in batches:
            column = common.plain_text(batch.column(2))
            for a, b in common.text_slices(column):
                ids = [x + closing for x in own.encode(column.slice(a, b - a).to_pylist())]
                n = pa.array([len(x) // width for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), n, pa.array(ids, pa.binary())], names=["row", "id", "n_tokens", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), name(id_column).cast("long").alias("id"), name(text))
    encoded = common.written(rows.mapInArrow(run, "row long, id long, n_tokens long, ids binary"), "encoded")
    placed = pack(encoded.select("row", "id", "n_tokens"), most, buckets, budget)
    cut = F.substring("ids", (F.col("start") * width + 1).cast("int"), (F.col("n_tokens") * width).cast("int"))
    joined = placed.join(encoded.select("row", "ids"), "row").withColumn("ids", cut).withColumn("width", F.lit(width))
    return joined.drop("row").withColumnRenamed("id", id_column)
