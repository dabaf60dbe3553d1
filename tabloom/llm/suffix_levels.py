"""Suffix-array dedup with a logarithmic index family.

Windows reach a shard in document order. Each batch of them gets its own suffix array (sorted suffixes, cut at the window length,
of the batch's fragments), is merge-scanned against every existing level, and becomes a level itself; levels of equal size class
merge, so there are logarithmically many and each suffix moves logarithmically often. Whatever a level holds is earlier than the
batch, so every match counts. Edge cases: null texts are empty; texts shorter than a window stay whole; rows of one id are
separate documents in the order of their first characters, then of digests; null ids come first; other columns pass
through `remove_repeats` in one struct, so their names cannot clash, and `report` reads id and text only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import repeats
from tabloom.llm.repeats import Unit

LENGTH, GRAM = 100, 32
#: Windows that make one batch.
BATCH = 1 << 15


@dataclass
class Levels:
    """Sorted distinct suffixes of all earlier batches, in levels of falling size class."""

    held: list[np.ndarray] = field(default_factory=list)

    def scan(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of the sorted suffixes any level holds."""
        found = np.zeros(len(suffixes), bool)
        for level in self.held:
            at = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
            found |= level[at] == suffixes
        return found

    def add(self, suffixes: np.ndarray) -> None:
        """A new level; while the two last are of one size class they merge."""
        if len(suffixes):
            self.held.append(suffixes)
        while len(self.held) > 1 and len(self.held[-2]) < 2 * len(self.held[-1]):
            last, before = self.held.pop(), self.held.pop()
            self.held.append(np.sort(np.concatenate([before, last]), kind="stable"))  # two sorted runs: a merge


def match_levels(texts: list[bytes], counts: np.ndarray, dids: np.ndarray, unit: Unit) -> list[np.ndarray]:
    """Per fragment (in document order), which of its windows an earlier window equals."""
    levels, out, i = Levels(), [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(np.cumsum(counts[i:]), BATCH, side="right")) + i)
        windows = np.concatenate([
            np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.frombuffer(t, np.uint8), unit.length))
            for t in texts[i:j]
        ]).view(f"S{unit.length}").ravel()
        order = np.argsort(windows, kind="stable")
        ranked = windows[order]
        first = np.r_[True, ranked[1:] != ranked[:-1]]
        hit = np.zeros(len(windows), bool)
        hit[order[~first]] = True
        fresh = ranked[first]
        found = levels.scan(fresh)
        hit[order[first][found]] = True
        levels.add(fresh[~found])
        out += np.split(hit, np.cumsum(counts[i:j])[:-1])
        i = j
    return out


def _digest(text: bytes, ranges: list[tuple[int, int]]) -> tuple:
    rest = without(text, ranges)
    return len(text), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(rest).hexdigest()


def without(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for r in ranges for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    unit = Unit(length, min(GRAM, length), False)
    numbered, ranges = repeats.spans(docs, unit, False, match_levels, id_column, text)
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeats.cut(numbered.select("did", "copy", "whole", "text", F.col("id").alias(id_column)), ranges, unit, _digest, schema)


def _text_left(text: bytes, ranges: list[tuple[int, int]]) -> tuple:
    return (without(text, ranges).decode("utf-8", "ignore"),)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`docs` with repeated bytes cut out of the text; a character that loses a byte goes as a whole, a null stays null."""
    unit = Unit(length, min(GRAM, length), False)
    numbered, ranges = repeats.spans(docs, unit, False, match_levels, id_column, text)
    left = repeats.cut(numbered.select("did", "copy", "whole", "text", "row"), ranges, unit, _text_left, "kept string")
    columns = [F.when(F.col("row")[c].isNotNull(), F.col("kept")).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns]
    return left.select(*columns)
