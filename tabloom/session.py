"""Session settings, the shared working folder and small parameter tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: State beyond the memory of an executor, and what processors with their own state need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def get_session(app: str = "tabloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs rely on; on a cluster the submit command names the rest."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE, ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session says; a stream keeps the settings of its start."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as `spark.checkpoint.dir` names it.

    Only a local session may fall back to a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: short lineage, safe against lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A parameter table of driver-held values (per feature, per trial), never of data rows.

    Handed over as Arrow it becomes a local relation of known size, with no job behind it.
    """
    types = T.DataType.fromDDL(schema)
    fields = to_arrow_schema(types)
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), types)
