"""The corpus pipeline: stages over the documents table, each written as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, repeated passages are cut out, documents that hold benchmark
passages go, and what is left is packed into batches. All stages but the last return the columns of documents.

Edge cases, for every stage: a null text counts as empty and stays null where its document stays; null and repeated ids are documents of
their own; an empty table gives an empty one; further columns pass through, whatever their names, up to the last stage. What each
stage makes of ties and repeated rows stands at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import catalogue, common, decontaminate, length_buckets, simhash, suffix_levels, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score THRESHOLD or more go; equal texts get equal scores, and empty ones a score like any other."""
    model = toxicity.fit(docs, catalogue.table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each group of near duplicates stays, of equal rows one; wordless texts are one group."""
    return simhash.keep_one(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all places but the first, in the order of ids; n_chars follows the text."""
    cut = suffix_levels.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go as a whole; texts without words stay."""
    return decontaminate.drop_documents(docs, catalogue.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every text goes; rows of one id follow each other by length."""
    return length_buckets.report(docs, catalogue.byte_bpe())


STAGES = [
    ("toxicity", toxicity_stage), ("simhash", simhash_stage), ("suffix_levels", suffix_stage), ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]
#: Fitted trees, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalogue.table(spark, sf_dir, "documents")
    for k, (label, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = common.written(docs, label) if k + 1 < len(STAGES) else docs
    return docs
