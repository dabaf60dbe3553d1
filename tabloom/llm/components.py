"""Connected components of a link table by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("hub")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), "m")
    moved = edges.join(least, F.col("a") == F.col("hub")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("hub").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of `links` (a long, b long) but the roots; a root is its component's least node.

    Minima are combined before the shuffle and joined back, so a node with very many links is no single group.
    """
    edges = common.written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links",
    )
    before = _state(edges)
    while before[0]:
        edges = common.written(_small(_large(edges)), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
