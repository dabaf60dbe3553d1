"""Language-model scores by subword lattices: the log10 probability of a text, summed over all its segmentations.

The vocabulary is the pieces of an existing tokenizer file, taken as byte strings (single bytes included, so every text has a
segmentation), and the words of the training texts. A word's lattice has an arc for each piece at each place and, if the word was
seen, one for the whole; a forward recursion in log space sums over all paths. Pieces start with the weights of the file's scores
and are re-estimated from the distinct training words by forward-backward counts; whole words have their discounted relative
frequency. Weights are learned per group of training texts (their language, say), and a text's probability is the mean over groups
by their share, so no group has to be known for the scored text. Every piece with a space starts a word, so a text's lattice is a
chain of those of its words, and each distinct word of the corpus is scored once.

The commonest words, HOT_WORDS at most, are broadcast with their scores and looked up where texts are read; the other words of a
text are joined with the word table, where none has more than 1 / HOT_WORDS of all words.

Edge cases: null and empty texts are one end token; a null id counts as the empty text for the training fold; rows of one id are scored one
by one; without training texts the base score is 0 and the pieces keep the file's weights; groups beyond the largest GROUPS, a null
one too, are one group; columns other than those named are not read. Texts are cut to words 1 MiB at a time.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

#: Words broadcast with their scores; a row of the broadcast holds a key of 33 bytes at most and a score per group.
HOT_WORDS = 1 << 17
#: Groups with weights of their own; the rest is one more group.
GROUPS = 7
ROUNDS = 3
DISCOUNT = 0.75
#: Expected pieces that the file's weights count for beside those of the corpus.
PRIOR = 10.0
#: Bytes of words laid out as one lattice; longer words are walked piece by piece, and taught in stretches of this size.
BLOCK, LONG = 1 << 15, 1024
KEY = 32
#: Bytes of a word up to which learning multiplies probabilities; scores are summed as logs throughout.
PLAIN = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_SLOT_BITS = 18


def key_of(word: bytes) -> bytes:
    """The word, or for a long one a blank (no word has one) and its digest."""
    return word if len(word) <= KEY else b" " + sha256(word).digest()


def vocabulary(path: str) -> dict[bytes, float]:
    """Pieces of a sentencepiece file as byte strings with weights that fall as the file's scores do.

    Scores of merge ranks (0, -1, -2, ...) are read as ranks of a power law; log probabilities as they are. Pieces that no lower-case
    word can hold are left out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    use = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in use if not model.is_byte(i)}
    ranked = all(s == int(s) for s in scores.values())
    least = min((1 / (2 - s) if ranked else math.exp(s) for s in scores.values() if s > -1e8), default=1.0)
    weights = {bytes([b]): least for b in range(256)}
    for i, s in scores.items():
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if s > -1e8 and b" " not in piece[1:] and piece == piece.lower():
            weights[piece] = weights.get(piece, 0.0) + (1 / (2 - s) if ranked else math.exp(s))
    total = sum(weights.values())
    return {p: w / total for p, w in weights.items()}


class Lattice:
    """Pieces laid out for look-up: all pieces at all places of many words at once."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.number = {p: k for k, p in enumerate(pieces)}
        self.by_length = {}
        for n in range(2, self.longest + 1):
            own = [k for k, p in enumerate(pieces) if len(p) == n]
            if own:
                h = np.array([self._hash(pieces[k]) for k in own], np.uint64)
                slot = ((h * _SPREAD) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
                first, further = np.full(1 << _SLOT_BITS, -1, np.int32), np.full(len(own), -1, np.int32)
                for j, s in enumerate(slot.tolist()):
                    further[j], first[s] = first[s], j
                self.by_length[n] = (first, further, h, np.array(own, np.int32))
        self.single = np.array([self.number[bytes([b])] for b in range(256)], np.int32)

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) % (1 << 64)
        return h

    def arcs(self, words: np.ndarray) -> np.ndarray:
        """(words, place, length - 1) -> the piece that ends at that place, else -1; `words` is a matrix of bytes."""
        n, m = words.shape
        widest = min(m, self.longest)
        out = np.full((n, m, widest), -1, np.int32)
        out[:, :, 0] = self.single[words]
        b = words.astype(np.uint64) + np.uint64(1)
        h = b
        for k in range(2, widest + 1):
            h = h[:, :-1] * _BASE + b[:, k - 1 :]
            if k not in self.by_length:
                continue
            first, further, hashes, own = self.by_length[k]
            maybe = first[((h * _SPREAD) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)]
            row, place = np.nonzero(maybe >= 0)
            candidate, wanted = maybe[row, place], h[row, place]
            while len(row):
                hit = hashes[candidate] == wanted
                out[row[hit], place[hit] + k - 1, k - 1] = own[candidate[hit]]
                candidate = np.where(hit, -1, further[candidate])
                left = candidate >= 0
                row, place, candidate, wanted = row[left], place[left], candidate[left], wanted[left]
        used = np.flatnonzero((out >= 0).any(axis=(0, 1)))
        return out[:, :, : int(used[-1]) + 1]


def _log_sum(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the last axis."""
    most = x.max(-1)
    base = np.where(np.isinf(most), 0.0, most)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(x - base[..., None]).sum(-1))


def forward(weights: np.ndarray) -> np.ndarray:
    """Log mass of all segmentations up to each place; `weights` (..., place, length - 1) are the arcs' logs."""
    m, widest = weights.shape[-2:]
    a = np.full((*weights.shape[:-2], m + 1), -np.inf)
    a[..., 0] = 0.0
    for i in range(m):
        k = min(i + 1, widest)
        a[..., i + 1] = _log_sum(a[..., i + 1 - k : i + 1][..., ::-1] + weights[..., i, :k])
    return a


def expected(arcs: np.ndarray, logs: np.ndarray, size: int) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words of `arcs`."""
    n, m, widest = arcs.shape
    row, place, length = np.nonzero(arcs >= 0)
    uses = arcs[row, place, length]
    if m <= PLAIN:  # masses of short words stay within the range of doubles
        weights = np.where(arcs >= 0, np.exp(logs)[arcs], 0.0)
        a, b = np.zeros((n, m + 1)), np.zeros((n, m + 1))
        a[:, 0] = b[:, m] = 1.0
        for i in range(m):
            k = min(i + 1, widest)
            a[:, i + 1] = np.einsum("nk,nk->n", a[:, i + 1 - k : i + 1][:, ::-1], weights[:, i, :k])
        for i in range(m - 1, -1, -1):
            k = min(m - i, widest)
            b[:, i] = np.einsum("nk,nk->n", b[:, i + 1 : i + 1 + k], weights[:, np.arange(i, i + k), np.arange(k)])
        return np.bincount(uses, a[row, place - length] * weights[row, place, length] * b[row, place + 1] / a[row, m], minlength=size)
    weights = np.where(arcs >= 0, logs[arcs], -np.inf)
    a = forward(weights)
    b = np.full((n, m + 1), -np.inf)
    b[:, m] = 0.0
    for i in range(m - 1, -1, -1):
        k = min(m - i, widest)
        b[:, i] = _log_sum(b[:, i + 1 : i + 1 + k] + weights[:, np.arange(i, i + k), np.arange(k)])
    mass = a[row, place - length] + weights[row, place, length] + b[row, place + 1] - a[row, m]
    return np.bincount(uses, np.exp(mass), minlength=size)


def walked(word: bytes, number: dict[bytes, int], logs: np.ndarray, longest: int) -> np.ndarray:
    """Log mass of one long word per row of `logs`, holding only as many places as the longest piece has bytes."""
    a = [np.zeros(len(logs))]
    for end in range(1, len(word) + 1):
        arcs = [(k, p) for k in range(1, min(longest, end) + 1) if (p := number.get(word[end - k : end])) is not None]
        a.append(_log_sum(np.stack([a[-k] + logs[:, p] for k, p in arcs], axis=-1)))
        if len(a) > longest:
            del a[0]
    return a[-1]


def _matrices(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Numbers and bytes of words of one length, BLOCK bytes at a time."""
    by: dict[int, list[int]] = defaultdict(list)
    for k, w in enumerate(words):
        by[len(w)].append(k)
    for size, at in sorted(by.items()):
        step = max(1, BLOCK // size)
        for first in range(0, len(at), step):
            some = at[first : first + step]
            yield some, np.frombuffer(b"".join([words[k] for k in some]), np.uint8).reshape(len(some), size)


@dataclass
class Model:
    """What scoring needs: pieces, per group the logs of their weights and of a word's end, and the corpus counts."""

    pieces: list[bytes]
    logs: np.ndarray
    groups: int
    tokens: int
    kinds: int
    ends: int
    group_tokens: list[int]
    group_kinds: list[int]
    group_ends: list[int]

    def base(self, count: np.ndarray | int):
        return np.log10((np.asarray(count) + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))

    def end_logs(self) -> list[float]:
        """Per group the log of its share of the texts times the probability that a text ends."""
        texts = sum(self.group_ends)
        return [
            math.log((e + 1) / (texts + self.groups)) + math.log((e + 1) / (n + 2)) for e, n in zip(self.group_ends, self.group_tokens)
        ]

    def word_logs(self, words: list[bytes], counts: np.ndarray, lattice: Lattice) -> np.ndarray:
        """(word, group) -> log probability: the arc of the whole word and the segmentations into pieces."""
        spelled = np.empty((len(words), self.groups))
        own = [b" " + w for w in words]
        short = [k for k, w in enumerate(own) if len(w) <= LONG]
        for some, matrix in _matrices([own[k] for k in short]):
            arcs = lattice.arcs(matrix)
            padded = np.concatenate([self.logs[:, : len(self.pieces)], np.full((self.groups, 1), -np.inf)], axis=1)
            spelled[np.array(short)[some]] = forward(padded[:, arcs])[..., -1].T
        for k, w in enumerate(own):
            if len(w) > LONG:
                spelled[k] = walked(w, lattice.number, self.logs[:, : len(self.pieces)], lattice.longest)
        spelled += self.logs[:, -1]
        total = np.array(self.group_tokens) + 2.0
        left = np.log((DISCOUNT * np.array(self.group_kinds) + 1) / total)
        anywhere = counts.sum(1) / max(1, sum(self.group_tokens) - sum(self.group_ends))
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(counts - DISCOUNT, 0.0) / total)
            shared = left + np.log(0.5 * anywhere)[:, None]
        return np.logaddexp(np.logaddexp(whole, shared), left + math.log(0.5) + spelled)


def _fold(id_column: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(name(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group or -1, text) to (word, group, n), a row per distinct word of a slice of texts; Spark adds them up before the shuffle."""
    for batch in batches:
        groups, texts = batch.column(0).to_numpy(), common.plain_text(batch.column(1))
        for a, b in common.text_slices(texts):
            words, numbers = common.numbered_words(texts.slice(a, b - a), lower=True)
            column = pa.array(words, pa.binary())
            for g in np.unique(groups[a:b]).tolist():
                n = np.bincount(np.concatenate([numbers[k] for k in np.flatnonzero(groups[a:b] == g).tolist()]), minlength=len(words))
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [column.take(pa.array(at)), pa.array(np.full(len(at), g, np.int32)), pa.array(n[at])], names=["word", "group", "n"],
                )


def _count_columns(groups: int) -> list[str]:
    return [f"c{k}" for k in range(groups)]


def word_table(docs: DataFrame, id_column: str, text: str, group: Column, groups: int, folds: int) -> DataFrame:
    """Rows (word, c0.., seen) of every distinct word of all texts: its count per group of training texts, and in all texts."""
    own = docs.select(F.when(_fold(id_column, folds) != 1, group).otherwise(-1).alias("group"), name(text).alias("text"))
    counted = own.mapInArrow(_counter, "word binary, group int, n long")
    sums = [F.sum(F.when(F.col("group") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(groups)]
    return common.written(counted.groupBy("word").agg(*sums, F.sum("n").alias("seen")), "words")


def _teach(pieces, logs, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        size = len(pieces.value)
        sums = np.zeros((groups, size))
        for batch in batches:
            words = batch.column(0).to_pylist()
            for g in range(groups):
                some = np.flatnonzero(batch.column(g + 1).to_numpy(zero_copy_only=False) > 0)
                parts = [b" " + words[k] for k in some.tolist()]
                parts = [w[a : a + LONG] for w in parts for a in range(0, len(w), LONG)]
                for _, matrix in _matrices(parts):
                    sums[g] += expected(lattice.arcs(matrix), logs.value[g], size)
        g, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[g, piece])], names=["group", "piece", "n"])
    return run


def learn(docs: DataFrame, words: DataFrame, ends: list[int], weights: dict[bytes, float]) -> Model:
    """Corpus counts and piece weights; rows that reach the driver are bounded by groups times pieces."""
    spark = docs.sparkSession
    groups = len(ends)
    cols = _count_columns(groups)
    total = sum(F.col(c) for c in cols)
    row = words.agg(
        F.coalesce(F.sum(total), F.lit(0)).alias("n"), F.count_if(total > 0).alias("v"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in cols], *[F.count_if(F.col(c) > 0).alias(f"v_{c}") for c in cols],
    ).first()
    kinds = [row[f"v_{c}"] for c in cols]
    pieces = list(weights)
    start = np.array([weights[p] for p in pieces])
    own = np.tile(start, (groups, 1))
    ended = np.full(groups, 0.2)
    shared = spark.sparkContext.broadcast(pieces)
    for _ in range(ROUNDS if row["v"] else 0):
        logs = spark.sparkContext.broadcast(np.log(own))
        uses = words.where(total > 0).select("word", *cols).mapInArrow(_teach(shared, logs, groups), "group int, piece int, n double")
        sums = PRIOR * np.tile(start, (groups, 1))
        for g, piece, n in uses.groupBy("group", "piece").agg(F.sum("n").alias("n")).toArrow().to_pandas().itertuples(index=False):
            sums[g, piece] += n
        every = sums.sum(1) + np.array(kinds) + 1
        own, ended = sums / every[:, None], (np.array(kinds) + 1) / every
    logs = np.concatenate([np.log(own * (1 if row["v"] else 0.8)), np.log(ended)[:, None]], axis=1)
    texts = sum(ends)
    return Model(
        pieces, logs, groups, row["n"] + texts, row["v"] + (texts > 0), texts, [row[f"n_{c}"] + e for c, e in zip(cols, ends)], kinds, ends,
    )


def _score_words(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        lattice = Lattice(m.pieces)
        for batch in batches:
            words = batch.column(0).to_pylist()
            counts = np.stack([batch.column(1 + g).to_numpy(zero_copy_only=False) for g in range(m.groups)], axis=1)
            logs = m.word_logs(words, counts, lattice)
            known = counts.sum(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(key_of, words)), pa.binary()), batch.column(1 + m.groups), pa.array(known > 0), pa.array(m.base(known)), *map(pa.array, logs.T.copy())],
                names=["key", "seen", "known", "base", *[f"l{g}" for g in range(m.groups)]],
            )
    return run


def _log_names(groups: int) -> list[str]:
    return [f"l{g}" for g in range(groups)]


def scored_words(words: DataFrame, model: Model) -> DataFrame:
    """Rows (key, seen, known, base, l0..) per distinct word, kept in the shared folder."""
    shared = words.sparkSession.sparkContext.broadcast(model)
    logs = ", ".join(f"{c} double" for c in _log_names(model.groups))
    out = words.select("word", *_count_columns(model.groups), "seen").mapInArrow(_score_words(shared), f"key binary, seen long, known boolean, base double, {logs}")
    return common.written(out, "scored-words")


def _score_texts(hot, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, base, logs = hot.value
        for batch in batches:
            texts = common.plain_text(batch.column(1))
            for a, b in common.text_slices(texts):
                words, numbers = common.numbered_words(texts.slice(a, b - a), lower=True)
                keys = [w if len(w) <= KEY else key_of(w) for w in words]
                hot_row = np.fromiter(map(place.get, keys, repeat(-1)), np.int64, len(keys))
                sizes = np.array([len(x) for x in numbers])
                text, word = np.repeat(np.arange(b - a), sizes), np.concatenate(numbers)
                at = hot_row[word]
                there = at >= 0
                owner, at = text[there], at[there]
                sums = [np.bincount(owner, column[at], minlength=b - a).astype(float) for column in (known, base, *logs)]
                pairs, n = np.unique(text[~there] * max(1, len(words)) + word[~there], return_counts=True)
                cuts = np.searchsorted(pairs, np.arange(b - a + 1) * max(1, len(words)))
                names = pa.array(keys, pa.binary()).take(pa.array(pairs % max(1, len(words))))
                rest = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([names, pa.array(n)], names=["key", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes + 1, pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), rest, *map(pa.array, sums[2:])],
                    names=["id", "n_tokens", "n_known", "base", "rest", *_log_names(groups)],
                )
    return run


def score(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text: str = "text", group: str | None = None, folds: int = 5, hot_words: int = HOT_WORDS,
) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Training texts are those whose crc32(id) modulo `folds` is not 1; `group` names a column by which they are grouped.
    """
    spark = docs.sparkSession
    training = _fold(id_column, folds) != 1
    label = F.coalesce(name(group).cast("string"), F.lit("")) if group else F.lit("")
    sizes = docs.where(training).groupBy(label.alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(GROUPS)
    named = [(r["label"], r["n"]) for r in sizes.collect()]
    texts = docs.where(training).count()
    ends = [n for _, n in named] + ([texts - sum(n for _, n in named)] if texts > sum(n for _, n in named) or not named else [])
    number = F.lit(len(ends) - 1)
    for k, (own, _) in enumerate(named):
        number = F.when(label == own, k).otherwise(number)
    words = word_table(docs, id_column, text, number.cast("int"), len(ends), folds)
    model = learn(docs, words, ends, vocabulary(vocabulary_path))
    scored = scored_words(words, model)
    logs = _log_names(model.groups)
    top = scored.orderBy(F.desc("seen"), "key").limit(hot_words).toArrow()  # at most hot_words rows of short keys
    place = {k: i for i, k in enumerate(top.column("key").to_pylist())}
    hot = spark.sparkContext.broadcast((place, top.column("known").to_numpy().astype(float), top.column("base").to_numpy(), [top.column(c).to_numpy() for c in logs]))
    results = ", ".join(f"{c} double" for c in logs)
    read = docs.select(name(id_column).alias("id"), name(text).alias("text")).mapInArrow(
        _score_texts(hot, model.groups), f"id {docs.schema[id_column].dataType.simpleString()}, n_tokens long, n_known long, base double, "
        f"rest array<struct<key:binary,n:bigint>>, {results}",
    )
    rows = common.written(read.withColumn("place", F.monotonically_increasing_id()), "texts")
    rest = rows.select("place", F.inline("rest")).join(scored.select("key", "known", "base", *logs), "key")
    sums = rest.groupBy("place").agg(
        F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("more_known"), F.sum(F.col("n") * F.col("base")).alias("more_base"),
        *[F.sum(F.col("n") * F.col(c)).alias(f"more_{c}") for c in logs],
    )
    both = rows.drop("rest").join(sums, "place", "left")
    per_group = [F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0)) + F.lit(e) for c, e in zip(logs, model.end_logs())]
    both = both.withColumn("per_group", F.array(*per_group)).withColumn("most", F.array_max("per_group"))
    mass = F.aggregate("per_group", F.lit(0.0), lambda t, x: t + F.exp(x - F.col("most")))
    return both.select(
        F.col("id").alias(id_column), (_fold("id", folds) == 1).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(model.ends > 0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + F.lit(float(model.base(model.ends)))).alias("base_score"),
        ((F.col("most") + F.log(mass)) / math.log(10)).alias("score"),
    )
