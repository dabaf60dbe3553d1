"""Token files: flat little-endian unsigned ids per shard, 64-bit offsets beside them, and a table of shard bases.

A shard is `shard-NNNNNN.bin` (ids) and `shard-NNNNNN.idx` (int64 pairs: document id, local offset; one closing pair with the
shard's length). `shards.parquet` lists shards with `base`, the ids of all shards before, by prefix sums; base + local offset is
a document's place in the corpus. Edge cases: a null text is empty and holds the end id only; a null document id is the smallest
long and comes first; rows of one id follow each other by the hash of their text, empty ones first; an empty table makes no shard; columns other than id
and text are not read. Shards are ranges of (id, hash, place), so rows of one id, copies too, may fill several.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

NO_ID = -(2**63)
#: Words whose ids a worker remembers, and the characters of the longest such word; others are encoded each time.
REMEMBERED, LONGEST = 1_000_000, 48
_LONG_GAP = re.compile(r"\s{3}")
_MARKS = frozenset(",.;:!?")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable, else the next free one."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(others)}}


_LETTERS = _byte_letters()
#: Below this character (Latin, Greek, Cyrillic) it has long been settled what a letter is.
_SETTLED = "\u0530"
_BLANK = _LETTERS[0x20]


def _as_letters(word: str) -> str:
    """A word, with a blank before it or not, in byte letters."""
    if word.isascii():
        return word.replace(" ", _BLANK)
    return word.encode().decode("latin-1").translate(_LETTERS)


class Encoder:
    """Ids of texts by a tokenizer file, as flat bytes.

    With a byte-level tokenizer that splits words before a space, a text is cut at single spaces and line ends and every distinct
    word is given to the tokenizer once. Texts with longer gaps are encoded as a whole.
    """

    def __init__(self, path: str, remembered: int | None = None) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_word = self.tokenizer.normalizer is None and not getattr(self.tokenizer.model, "dropout", None) and re.match(
            r"ByteLevel\(add_prefix_space=False.*use_regex=True", str(self.tokenizer.pre_tokenizer)
        ) is not None
        self.known: dict[str, bytes] = {}
        self.remembered = REMEMBERED if remembered is None else remembered

    def _encode(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.dtype.itemsize == 2 else "I"
        flat = [array(code, e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for ids in flat:
                ids.byteswap()
        return [ids.tobytes() for ids in flat]

    def _whole(self, text: str) -> bool:
        tail = text[-2:]
        return (
            not self.by_word or "\0" in text or _LONG_GAP.search(text) is not None or (len(tail) == 2 and tail.isspace())
            or any(a in text for a in self.added)
        )

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """A word of letters is one piece for the tokenizer's model; the others go through the whole tokenizer."""
        out: list = [None] * len(words)
        model, code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        for i, w in enumerate(words):
            body = w[1:] if w[:1] == " " else w
            if body.isalpha() and (body.isascii() or max(body) < _SETTLED):
                ids = array(code, [t.id for t in model.tokenize(_as_letters(w))])
                if sys.byteorder == "big":
                    ids.byteswap()
                out[i] = ids.tobytes()
        rest = [i for i, ids in enumerate(out) if ids is None]
        for first in range(0, len(rest), 4096):
            some = rest[first : first + 4096]
            for i, ids in zip(some, self._encode([words[i] for i in some])):
                out[i] = ids
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words; one sign after a letter is a token of its own, so `word,` needs `word` and `,` only."""
        known = self.known
        ended = {w: w[:-1] for w in words if len(w) > 1 and w[-1] in _MARKS and w[-2].isalpha()}
        order = [w for w in {*(w for w in words if w not in ended), *ended.values(), *_MARKS} if w not in known]
        fresh = dict(zip(order, self._encode_words(order)))
        for w, stem in ended.items():
            fresh[w] = (fresh[stem] if stem in fresh else known[stem]) + (fresh[w[-1]] if w[-1] in fresh else known[w[-1]])
        if len(known) < self.remembered:
            known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST)
        return fresh

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if self._whole(t)]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids
        split = [i for i, ids in enumerate(out) if ids is None]
        words = [texts[i].replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") for i in split]
        flat = list(chain.from_iterable(words))
        ids = list(map(self.known.get, flat))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            fresh = self._learn({flat[i] for i in new})
            for i in new:
                ids[i] = fresh[flat[i]]
        at = 0
        for i, w in zip(split, words):
            out[i] = b"".join(ids[at : at + len(w)])
            at += len(w)
        return out


@lru_cache(2)
def encoder(path: str, remembered: int | None = None) -> Encoder:
    """One encoder per worker and file, with its remembered words, for all tasks of the worker."""
    return Encoder(path, remembered)


def forget() -> None:
    """Let go of this worker's encoders and their words: called by stages that share workers with encoding ones and encode nothing."""
    encoder.cache_clear()


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all tasks reach, by its URI; a plain path is a shared mount."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard per partition, renamed into place when complete: a repeated task writes the same bytes again."""
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        own = encoder(path)
        closing = np.array([end_id], own.dtype).tobytes()
        system, root = _filesystem(folder)
        context = TaskContext.get()
        shard = context.partitionId()
        place = f"{root}/shard-{shard:06d}"
        part = f"{root}/_part-{shard:06d}-{context.taskAttemptId()}"
        ids, offsets, at = [], [], 0
        with system.open_output_stream(f"{part}.bin") as out:
            for batch in (b for group in ([first], batches) for b in group):
                column = common.plain_text(batch.column(1))
                ids.append(batch.column(0).to_numpy(zero_copy_only=False))
                for a, b in common.text_slices(column):
                    for tokens in own.encode(column.slice(a, b - a).to_pylist()):
                        out.write(tokens + closing)
                        offsets.append(at)
                        at += len(tokens) // own.dtype.itemsize + 1
        index = np.empty((len(offsets) + 1, 2), "<i8")
        index[:-1, 0], index[:-1, 1], index[-1] = np.concatenate(ids), offsets, (len(offsets), at)
        with system.open_output_stream(f"{part}.idx") as out:
            out.write(index.tobytes())
        for kind in ("bin", "idx"):
            system.move(f"{part}.{kind}", f"{place}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard]), pa.array([own.dtype.itemsize], pa.int32()), pa.array([len(offsets)]), pa.array([at])],
            names=["shard", "width", "n_docs", "n_ids"],
        )
    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the token files of `docs` in ascending id order below `folder`; returns the table of shards with bases.

    Texts are shuffled once and encoded once; the sample behind the ranges holds no text.
    """
    spark = docs.sparkSession
    parts = common.shuffle_partitions(spark)
    own_text = F.coalesce(name(text), F.lit(""))
    own = docs.select(
        F.coalesce(name(id_column).cast("long"), F.lit(NO_ID)).alias("id"), own_text.alias("text"),
        F.when(own_text == "", NO_ID).otherwise(F.xxhash64(own_text)).alias("hash"), F.monotonically_increasing_id().alias("place"),
    )
    system, root = _filesystem(folder)
    system.create_dir(root, recursive=True)
    shards = common.written(
        own.repartitionByRange(parts, "id", "hash", "place").sortWithinPartitions("id", "hash", "place").select("id", "text")
        .mapInArrow(_writer(folder, tokenizer, end_id), "shard long, width int, n_docs long, n_ids long"), "shards",
    )
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    table = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))
    table.write.mode("overwrite").parquet(f"{folder}/shards.parquet")
    return spark.read.schema(table.schema).parquet(f"{folder}/shards.parquet")


def open_shard(folder: str, shard: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the (id, local offset) rows of one shard: memory-mapped from a mounted folder, else read."""
    system, root = _filesystem(folder)
    dtype = np.dtype(f"<u{width}")
    ids, index = f"{root}/shard-{shard:06d}.bin", f"{root}/shard-{shard:06d}.idx"
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(ids, dtype, mode="r"), np.memmap(index, "<i8", mode="r").reshape(-1, 2)
    with system.open_input_file(ids) as a, system.open_input_file(index) as b:
        return np.frombuffer(a.readall(), dtype), np.frombuffer(b.readall(), "<i8").reshape(-1, 2)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) read back from the files, one task per shard."""
    shards = spark.read.parquet(f"{folder}/shards.parquet")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, index = open_shard(folder, row["shard"], row["width"])
                cuts = index[:, 1]
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                for a in range(0, len(sums), 10_000):
                    b = min(len(sums), a + 10_000)
                    doc = index[a:b, 0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, mask=doc == NO_ID), pa.array(cuts[a:b] + row["base"]), pa.array(np.diff(cuts[a : b + 1])), pa.array(sums[a:b], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    dealt = shards.repartitionById(common.shuffle_partitions(spark), F.col("shard").cast("int"))
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
