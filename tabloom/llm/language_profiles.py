"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1; a trigram's vector binds (multiplies) its letters' vectors, each permuted (rolled) by
its place; a text's vector bundles (adds) its trigrams'; a language's prototype bundles its training texts'. A text gets the
language of the nearest prototype by cosine. Everything up to the cosine is integer arithmetic, so results do not depend on
order. Edge cases: null texts and texts without a letter are `und` with score 0, and all are when there is nothing to learn from;
ties go to the language that sorts first; training rows without language or text count for nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

DIMENSIONS = 1024
SEED = 20240229
#: Expected training texts per language; languages with more are sampled by a hash of the id.
TRAIN_PER_LANGUAGE = 4000
LANGUAGES = 10_000
BOUNDARY = 0x20


@lru_cache(1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(1 << 16)
def letter_vector(code: int) -> np.ndarray:
    """The fixed random vector of a code point."""
    bits = np.unpackbits(np.frombuffer(hashlib.shake_128(f"{SEED}:{code}".encode()).digest(DIMENSIONS // 8), np.uint8))
    return (bits.astype(np.int8) << 1) - 1


def trigram_vectors(keys: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams given as three code points of 21 bits."""
    places = [(keys >> np.uint64(s) & np.uint64(0x1FFFFF)).astype(np.int64) for s in (42, 21, 0)]
    codes, where = np.unique(np.stack(places), return_inverse=True)
    vectors = np.stack([letter_vector(int(c)) for c in codes])
    where = where.reshape(3, -1)
    bound = np.roll(vectors, 2, axis=1)[where[0]]
    bound *= np.roll(vectors, 1, axis=1)[where[1]]
    bound *= vectors[where[2]]
    return bound


def text_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors of texts as float32 whole numbers, and which texts have a letter."""
    coded = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    codes = np.concatenate(coded) if coded else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(coded)), [len(c) for c in coded])
    letter = letters()[codes]
    opens = np.r_[True, owner[1:] != owner[:-1]]
    kept = np.flatnonzero(letter | opens | np.r_[False, letter[:-1]])
    symbols = np.where(letter[kept], codes[kept], BOUNDARY).astype(np.uint64)
    owner = owner[kept]
    inside = np.flatnonzero(owner[2:] == owner[:-2])
    keys = symbols[inside] << np.uint64(42) | symbols[inside + 1] << np.uint64(21) | symbols[inside + 2]
    known, which = np.unique(keys, return_inverse=True)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    owner = owner[inside]
    # Trigrams a block at a time: the count matrix stays small whatever the alphabet.
    for first in range(0, len(known), 4096):
        block = trigram_vectors(known[first : first + 4096]).astype(np.float32)
        some = (which >= first) & (which < first + len(block))
        counts = np.bincount(owner[some] * len(block) + which[some] - first, minlength=len(texts) * len(block))
        out += counts.reshape(len(texts), len(block)).astype(np.float32) @ block
    return out, np.bincount(owner, minlength=len(texts)) > 0


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, list[str]]]:
    column = common.plain_text(batch.column(text))
    for a, b in common.text_slices(column):
        yield a, b, column.slice(a, b - a).to_pylist()


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the text vectors of each language in a partition."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for a, b, texts in _slices(batch, 1):
            vectors, _ = text_vectors(texts)
            for lang in set(langs[a:b]):
                own = vectors[np.flatnonzero(langs[a:b] == lang)].sum(0, dtype=np.float64).astype(np.int64)
                total[lang] = total.get(lang, 0) + own
    for lang, vector in sorted(total.items()):
        yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector)], names=["lang", "place", "value"])


def prototypes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, from about `per_language` texts of each; the sample is by hash of the id."""
    known = docs.where(name(lang).isNotNull() & name(text).isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy(name(lang).alias("lang")).agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"column {lang} has over {LANGUAGES} values: not languages")
    if not counts:
        return [], np.zeros((0, DIMENSIONS))
    share = F.create_map(*[F.lit(x) for lang_, n in sorted(counts.items()) for x in (lang_, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64(name(id_column).cast("string"), F.lit(SEED)), F.lit(1 << 20)) < share[name(lang)] * (1 << 20)
    parts = known.where(drawn).select(name(lang).alias("lang"), name(text).alias("text")).mapInArrow(_partial, "lang string, place int, value long")
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect():  # languages x dimensions
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["value"]
    langs = sorted(out)
    return langs, np.array([out[k] for k in langs]).reshape(-1, DIMENSIONS)


def identify(docs: DataFrame, profile: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """All columns of `docs` but the text, and lang_pred, score (cosine with the prototype, at least 0)."""
    langs, vectors = profile
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = docs.sparkSession.sparkContext.broadcast((vectors / np.where(norms > 0, norms, 1)).T.copy())
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    schema = docs.select(*[name(c) for c in kept], F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text)
            predicted, scores = [], []
            for _, _, texts in _slices(batch, at):
                if not langs:
                    predicted += ["und"] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                own, lettered = text_vectors(texts)
                size = np.sqrt(np.einsum("ij,ij->i", own, own, dtype=np.float64))
                cosine = np.round(own.astype(np.float64) @ unit.value / np.where(size > 0, size, 1)[:, None], 6)
                best = cosine.argmax(1)
                predicted += [langs[b] if y else "und" for b, y in zip(best, lettered)]
                scores += np.where(lettered, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0).tolist()
            arrays = [batch.column(batch.schema.names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(predicted, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    return docs.select(*[name(c) for c in kept], name(text)).mapInArrow(run, schema)


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (id, held_out, lang_pred, score); rows with crc32(id) mod 3 = 1 are held out of the training."""
    own = docs.select(name(id_column).alias(id_column), name(text).alias("own_text"), name(lang).alias("own_lang"), (common.crc_fold(id_column) == 1).alias("held_out"))
    profile = prototypes(own.where("NOT held_out"), id_column, "own_text", "own_lang")
    return identify(own.select(id_column, "held_out", "own_text"), profile, "own_text")
