"""Substring dedup by FM-indexes: each shard indexes its fragments' words and streamed windows are found by backward search.

The index of a shard is the Burrows-Wheeler transform of its fragments (one symbol per word, a separator after each fragment) in a
wavelet matrix of packed bit planes with popcount directories. Matching statistics are taken up to the window length: a window
whose statistic reaches it has a suffix interval, and the least document of that interval decides. Edge cases: null texts have no
words; texts shorter than a window stay whole; rows of one id never make each other's windows repeated; a null id is the smallest;
other columns pass through `remove_repeats` in one struct, so their names cannot clash, and `report` reads id and text only.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import repeats
from tabloom.llm.repeats import Unit

LENGTH, GRAM = 13, 5


class Wavelet:
    """Counts of a symbol before a place, by one bit plane per symbol bit."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        self.planes, self.before, self.zeros = [], [], []
        values = sequence
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.planes.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        self.base = self._walk(np.arange(symbols), np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            word, inside = place >> 6, (place & 63).astype(np.uint64)
            ones = self.before[k][word] + np.bitwise_count(self.planes[k][word] & ((np.uint64(1) << inside) - np.uint64(1)))
            place = np.where((symbol >> level) & 1, self.zeros[k] + ones, place - ones)
        return place

    def count(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._walk(symbol, place) - self.base[symbol]


class FMIndex:
    """Backward search over texts of word numbers (1 and up)."""

    def __init__(self, texts: list[np.ndarray], symbols: int) -> None:
        ends = np.cumsum([len(t) + 1 for t in texts])
        sequence = np.zeros(int(ends[-1]), np.int64)
        for t, e in zip(texts, ends.tolist()):
            sequence[e - 1 - len(t) : e - 1] = t
        n = len(sequence)
        # Separators sort by place, before every word: all suffixes differ within a fragment's length.
        rank = sequence + len(texts)
        rank[ends - 1] = np.arange(len(texts))
        self.order, step = np.argsort(rank, kind="stable"), 1
        while True:
            ranked = rank[self.order]
            new = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
            rank = np.empty(n, np.int64)
            rank[self.order] = new
            if new[-1] == n - 1:
                break
            follow = np.zeros(n, np.int64)
            follow[: n - step] = rank[step:] + 1
            rank = rank * (n + 1) + follow
            self.order, step = np.argsort(rank, kind="stable"), 2 * step
        self.first = np.searchsorted(np.sort(sequence), np.arange(symbols + 1))
        self.wavelet = Wavelet(sequence[self.order - 1], symbols + 1)
        self.text_of = np.searchsorted(ends, self.order, side="right")

    def statistics(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length of the longest suffix of each window that occurs, and its interval of suffixes."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.order), np.int64)
        length, alive = np.zeros(len(windows), np.int64), np.arange(len(windows))
        for k in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[alive, k]
            a = self.first[symbol] + self.wavelet.count(symbol, low[alive])
            b = self.first[symbol] + self.wavelet.count(symbol, high[alive])
            on = a < b
            alive = alive[on]
            low[alive], high[alive] = a[on], b[on]
            length[alive] += 1
        return length, low, high


def match_index(texts: list[bytes], counts: np.ndarray, dids: np.ndarray, unit: Unit) -> list[np.ndarray]:
    """Per fragment, which of its windows a smaller document has too."""
    if not texts:
        return []
    number: dict[bytes, int] = {}
    words = [np.array([number.setdefault(w, len(number) + 1) for w in t.split(b" ")], np.int64) for t in texts]
    index = FMIndex(words, len(number))
    windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(w, unit.length) for w in words])
    length, low, high = index.statistics(windows)
    reached = length >= unit.length
    owner = np.repeat(dids, counts)
    intervals, of = np.unique(np.stack([low[reached], high[reached]]), axis=1, return_inverse=True)
    least = np.minimum.reduceat(np.r_[dids[index.text_of], np.iinfo(np.int64).max], intervals.ravel(order="F"))[::2]
    hit = np.zeros(len(windows), bool)
    hit[reached] = least[of.ravel()] < owner[reached]
    return np.split(hit, np.cumsum(counts)[:-1])


def kept_words(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    words = text.split()
    cuts = [0, *(x for r in ranges for x in r), len(words)]
    return len(words), sum(b - a for a, b in ranges), b" ".join(w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b])


def _digest(text: bytes, ranges: list[tuple[int, int]]) -> tuple:
    n, removed, rest = kept_words(text, ranges)
    return n, removed, hashlib.sha256(rest).hexdigest()


def _words_left(text: bytes, ranges: list[tuple[int, int]]) -> tuple:
    return (kept_words(text, ranges)[2].decode("utf-8", "replace") if ranges else text.decode("utf-8", "replace"),)


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (id, n_words, n_removed, kept_sha256) of every document."""
    unit = Unit(length, min(GRAM, length), True)
    numbered, ranges = repeats.spans(docs, unit, True, match_index, id_column, text)
    schema = "n_words long, n_removed long, kept_sha256 string"
    return repeats.cut(numbered.select("did", "copy", "whole", "text", F.col("id").alias(id_column)), ranges, unit, _digest, schema)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`docs` with the words of repeated windows taken out; such a text becomes its kept words, joined by spaces."""
    unit = Unit(length, min(GRAM, length), True)
    numbered, ranges = repeats.spans(docs, unit, True, match_index, id_column, text)
    left = repeats.cut(numbered.select("did", "copy", "whole", "text", "row"), ranges, unit, _words_left, "kept string")
    row = F.col("row")
    return left.select(*[F.when(row[c].isNotNull(), F.col("kept")).alias(c) if c == text else row[c].alias(c) for c in docs.columns])
