"""Table locations, CSV tables, small parameter tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabloom.operators.frames import nan_to_null


def uri(cfg: Mapping, key: str) -> str:
    """Where a key of the config lives: an object-store path under bucket and prefix, or the local path."""
    storage = cfg.get("storage", {})
    if storage.get("backend", "local") != "s3":
        return key
    prefix = storage.get("s3_prefix", "").rstrip("/")
    parts = [storage["s3_bucket"], prefix, key.lstrip("/")]
    return "s3a://" + "/".join(p for p in parts if p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV table with a header. Give a schema for large data; without one Spark reads it twice to infer types."""
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_optional_csv(spark: SparkSession, path: str | None) -> DataFrame | None:
    return read_csv(spark, path) if path else None


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, max_records: int = 0) -> None:
    writer = df.write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_small(df: DataFrame, path: str) -> None:
    """A parameter table (one row per feature or trial) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_small(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)
