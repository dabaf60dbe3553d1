"""The prediction log: appended JSON lines, read back as a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a log record, in order.
FIELDS = ("timestamp", "request_id", "model_type", "n_features", "prediction", "features")
SCHEMA = (
    "timestamp timestamp, request_id string, model_type string, n_features int, "
    "prediction double, features map<string,double>"
)
RECORDS_PER_FILE = 400_000


def log_records(scored: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scored rows in the shape of the log; `features` becomes the vector that was scored."""
    vector = F.map_from_arrays(F.array(*[F.lit(f) for f in features]), F.array(*[F.col(f) for f in features]))
    stamp = F.col("timestamp") if "timestamp" in scored.columns else F.current_timestamp()
    return scored.select(
        stamp.alias("timestamp"),
        F.col("request_id"),
        F.col("model_type"),
        F.col("n_features"),
        F.col("prediction"),
        vector.alias("features"),
    )


def append_log(
    records: DataFrame, path: str, max_records: int = RECORDS_PER_FILE, tasks_per_day: int | None = None
) -> None:
    """Append to the log, split by day; a file rolls over after `max_records` lines.

    Adaptive execution sizes the writing tasks by what a day holds: small days share a task, a large one is dealt to many.
    `tasks_per_day` fixes the number for days whose size is known.
    """
    dated = records.select(*FIELDS, F.to_date("timestamp").alias("date"))
    if tasks_per_day:
        dated = dated.repartition("date", F.pmod(F.xxhash64("request_id", "prediction"), F.lit(tasks_per_day)))
    else:
        dated = dated.hint("rebalance", "date")
    dated.write.mode("append").partitionBy("date").option("maxRecordsPerFile", max_records).json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log rows; blank lines and lines that are no record are left out, `split_corrupt` lists the latter."""
    return split_corrupt(spark, path)[0]


def split_corrupt(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, lines that are no record), for logs from elsewhere."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select(
        "value",
        F.from_json(
            "value", SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
        ).alias("r"),
    )
    good = parsed.where("r._bad is null").select(*[F.col(f"r.{f}") for f in FIELDS])
    return good, parsed.where("r._bad is not null").select("value")


def map_keys(log: DataFrame, features: str = "features", max_columns: int = 10_000) -> list[str]:
    """The distinct feature names in a log, sorted. They become columns, so more than `max_columns` are refused."""
    names = log.select(F.explode(F.map_keys(features)).alias("k")).distinct().limit(max_columns + 1).collect()
    if len(names) > max_columns:
        raise ValueError(f"the log names more than {max_columns} features")
    return sorted(r["k"] for r in names)


def flatten(log: DataFrame, names: Sequence[str] | None = None, features: str = "features") -> DataFrame:
    """Features as top-level columns, null where absent. A feature named like a field replaces it
    in the rows that have it.
    """
    names = map_keys(log, features) if names is None else list(names)
    fields = [c for c in log.columns if c != features]
    types = dict(log.dtypes)

    def field(c: str):
        if c not in names:
            return F.col(c)
        given = F.col(features)[c]
        if types[c] in ("string", "timestamp"):
            return F.coalesce(given.cast("string"), F.col(c).cast("string")).alias(c)
        return F.coalesce(given, F.col(c).cast("double")).alias(c)

    return log.select(*[field(c) for c in fields], *[F.col(features)[n].alias(n) for n in names if n not in fields])
