"""Toxicity by gradient-boosted trees over dense text features, calibrated by an isotonic fit.

From labelled training rows (a bounded sample, split by hash into three parts) the first part gives a lexicon of words and word
stems with their log odds, the second the trees, the third the calibration, so no part sees its own answers. Edge cases: null
and empty texts have all features 0 and get a score like any other; rows with a null label, or labelled twice with different
answers, are no training rows; without both answers in the training rows every score is 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common, token_files
from tabloom.operators.frames import name

#: Expected labelled rows that the model is fitted on; more are sampled by a hash of the id.
TRAIN_ROWS = 24_000
#: Lexicon entries at most, by weight; an entry stands in this many toxic texts at least.
LEXICON, SUPPORT = 4000, 3
STEMS = (4, 5, 6)
THRESHOLD = 0.7
SECOND_PERSON = frozenset(
    w.encode() for w in "you your yours yourself u tu te toi vous votre vos du dich dir dein deine ihr euch tú ti usted ustedes vosotros".split()
)
NEAR = 3
FEATURES = (
    "word_density", "word_weight", "word_most", "word_hits", "stem_density", "stem_weight", "stem_most", "stem_hits", "near_you", "you_density",
    "capitals", "shouted", "punctuation", "marks", "obfuscated", "log_words",
)
_TO_WORDS = bytes(
    common.LOWER[b] if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256)
)
_PLAIN = bytes.maketrans(b"@$!013457", b"asioieast")
_DISGUISED = re.compile(rb"(?<![A-Za-z])[A-Za-z]++(?:[@$!*0-9]++[A-Za-z]++)+")  # possessive: linear on any text
_SHOUTED = re.compile(rb"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
_MARKS = re.compile(rb"[!?]{2,}")
_PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
_CAPITALS = bytes(range(0x41, 0x5B))


def words_of(text: bytes) -> tuple[list[bytes], int]:
    """Lower-case words, those written with digits or signs between letters once more in plain letters, and how many these are."""
    words = text.translate(_TO_WORDS).split()
    hidden = [w.replace(b"*", b"").translate(_PLAIN).lower() for w in _DISGUISED.findall(text)]
    return words + hidden, len(hidden)


def stems_of(words: list[bytes]) -> list[bytes]:
    return [w[:n] + b"~" for n in STEMS for w in words if len(w) > n]


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and stems of each text with its label."""
    token_files.forget()
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            words, _ = words_of(text or b"")
            own = list({*words, *stems_of(words)})
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([label] * len(own), pa.int32())], names=["entry", "toxic"])


def features(text: bytes, lexicon: dict[bytes, float]) -> list[float]:
    words, hidden = words_of(text)
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    hits = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    stems = [lexicon[s] for s in stems_of(words) if s in lexicon]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if you and hits:
        at = np.array(you)
        place = np.searchsorted(at, [i for i, _ in hits])
        right, left = at[np.minimum(place, len(at) - 1)], at[np.maximum(place - 1, 0)]
        where = np.array([i for i, _ in hits])
        near = int((np.minimum(abs(right - where), abs(left - where)) <= NEAR).sum())
    weights = [w for _, w in hits]
    size = len(text)
    return [
        len(hits) / n, sum(weights) / n, max(weights, default=0.0), math.log1p(len(hits)),
        len(stems) / n, sum(stems) / n, max(stems, default=0.0), math.log1p(len(stems)),
        near / n, len(you) / n, (size - len(text.translate(None, _CAPITALS))) / size, len(_SHOUTED.findall(text)) / n,
        (size - len(text.translate(None, _PUNCTUATION))) / size, len(_MARKS.findall(text)) / n, hidden / n, math.log1p(n),
    ]


def with_features(docs: DataFrame, lexicon, text: str) -> DataFrame:
    """All columns of `docs` but the text, and the array `features`."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*[name(c) for c in kept], F.array(F.lit(0.0)).alias("features")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_files.forget()
        for batch in batches:
            texts = common.plain_text(batch.column(batch.schema.names.index(text)))
            for a, b in common.text_slices(texts):
                values = [features(t, lexicon.value) for t in texts.slice(a, b - a).cast(pa.large_binary()).to_pylist()]
                arrays = [batch.column(batch.schema.names.index(c)).slice(a, b - a) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(values, pa.list_(pa.float64()))], names=[*kept, "features"])

    return docs.select(*[name(c) for c in kept], name(text)).mapInArrow(run, schema)


class Model:
    """Lexicon, trees and calibration; None trees score 0."""

    def __init__(self, lexicon: dict[bytes, float], trees, calibration) -> None:
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """All columns of `docs` but the text, and `score`."""
        own = common.nested(docs, text)
        if self.trees is None:
            return common.unnested(own, docs, F.lit(0.0), names=("score",), without=(text,))
        lexicon = docs.sparkSession.sparkContext.broadcast(self.lexicon)
        calibrated = self.calibration.transform(_raw(self.trees, with_features(own, lexicon, "own_text")))
        score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated"))), 6)
        return common.unnested(calibrated, docs, score, names=("score",), without=(text,))


def _raw(trees, own: DataFrame) -> DataFrame:
    vectors = own.withColumn("vector", array_to_vector("features"))
    return trees.transform(vectors).withColumn("raw", vector_to_array("probability")[1])


def learn_lexicon(sample: DataFrame) -> dict[bytes, float]:
    """Entries of `sample` (toxic, text) with their smoothed log odds, the heaviest LEXICON of them."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("toxic", "text").mapInArrow(entries, "entry binary, toxic int").groupBy("entry").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    ).where(F.col("bad") >= SUPPORT)
    odds = F.log((F.col("bad") + 0.1) / (bad + 0.2)) - F.log((F.col("good") + 0.1) / (good + 0.2))
    top = counts.withColumn("weight", F.round(odds, 6)).where("weight > 1").orderBy(F.desc(F.col("weight") * F.sqrt("bad")), "entry").limit(LEXICON)
    return {bytes(r["entry"]): r["weight"] for r in top.select("entry", "weight").collect()}


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Fit on about `rows` rows of `labels` whose crc32(id) mod 3 is not 1."""
    own = (
        labels.select(name(id_column).alias("label_id"), name(label).cast("int").alias("toxic")).where("label_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("label_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
        .where(common.crc_fold("label_id") != 1)
    )
    total = own.count()
    draw = F.pmod(F.xxhash64(F.col("label_id").cast("string"), F.lit(8)), F.lit(1 << 20))
    drawn = own.where(draw < int(min(1.0, rows / max(1, total)) * (1 << 20))).withColumn("part", F.pmod(F.xxhash64(F.col("label_id").cast("string"), F.lit(9)), F.lit(20)))
    texts = docs.select(name(id_column).alias("label_id"), F.coalesce(name(text), F.lit("")).alias("text"))
    sample = common.written(texts.join(F.broadcast(drawn), "label_id").drop("label_id"), "toxicity-sample")  # about `rows` rows
    parts = {(r["part"], r["toxic"]): r["n"] for r in sample.groupBy(F.when(F.col("part") < 9, 0).when(F.col("part") < 15, 1).otherwise(2).alias("part"), "toxic").agg(F.count("*").alias("n")).collect()}
    if any((p, y) not in parts for p in (0, 1, 2) for y in (0, 1)):
        return Model({}, None, None)
    lexicon = learn_lexicon(sample.where("part < 9"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    held = common.written(with_features(sample.where("part >= 9"), shared, "text"), "toxicity-features")
    gbt = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=16, maxDepth=3, stepSize=0.3, seed=8, maxBins=32)
    trees = gbt.fit(held.where("part < 15").withColumn("vector", array_to_vector("features")).coalesce(2))
    raw = _raw(trees, held.where("part >= 15")).withColumn("toxic", F.col("toxic").cast("double"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated").fit(raw.select("raw", "toxic"))
    return Model(lexicon, trees, calibration)


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without the documents that the model rejects."""
    return common.unnested(model.score(common.nested(docs, text), "own_text").where(F.col("score") < THRESHOLD), docs)


def report(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, held_out, score, predicted)."""
    model = fit(docs, labels, id_column, text)
    own = docs.select(name(id_column).alias(id_column), (common.crc_fold(id_column) == 1).alias("held_out"), name(text).alias("own_text"))
    return model.score(own, "own_text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
