"""Periodic runs against a plain version: made-up texts, planted repetitions, edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import words
from pyspark.sql import functions as F

from tabloom.llm import periodic_runs as periodic

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


#: Two ids whose texts are left as they are.
BIG = [d for d in range(300, 400) if zlib.crc32(str(d).encode()) % 10][:2]


def plain_runs(w):
    """(start, length, period) of every run, by trying every period."""
    out, taken = [], set()
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            a, b = i, j + q
            if b - a >= 3 * q and (a, b) not in taken:  # a stretch with a smaller period was met with that one
                taken.add((a, b))
                if b - a >= 24:
                    out.append((a, b - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text, plant=True):
    w = words(text)
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = plain_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def tricky(rng):
    """A word list with nested, neighbouring and broken repetitions over few letters."""
    def some(n, letters):
        return [rng.choice(letters) for _ in range(n)]

    unit = some(rng.choice([1, 2, 3, 5, 8, 13, 30, 70]), "abc" if rng.random() < 0.5 else "ab")
    inner = unit * rng.randint(2, 9)
    kind = rng.randint(0, 4)
    if kind == 0:
        return some(rng.randint(0, 30), "abcd") + inner + some(rng.randint(0, 30), "abcd")
    if kind == 1:  # a period that holds a long run of a smaller period
        return (["a"] * rng.randint(1, 60) + ["b"] + unit) * rng.randint(2, 5)
    if kind == 2:  # the same context twice in a period
        return (unit + ["x"] + unit + unit) * rng.randint(2, 6) + unit
    if kind == 3:
        out = inner + inner[: rng.randint(0, len(inner))] + inner
        out[rng.randrange(len(out))] = "z"
        return out
    a, b = ["a"], ["a", "b"]  # Fibonacci words: very many squares
    for _ in range(rng.randint(3, 11)):
        a, b = b, b + a
    return b


def found(texts):
    x, numbers = [], {}
    for k, w in enumerate(texts):
        x += [numbers.setdefault(v, len(numbers)) for v in w] + [-1 - k]
    lengths = np.array([len(w) for w in texts])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = [[] for _ in texts]
    for s, e, q in periodic.find_runs(np.array(x, np.int32), lengths):
        k = int(np.searchsorted(starts, s, side="right")) - 1
        out[k].append((s - int(starts[k]), e - s, q))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    texts = [tricky(rng) for _ in range(60)] + [[], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 500, list("abc") * 8]
    assert found(texts) == [plain_runs(w) for w in texts]


def test_selection_depends_on_the_context_only():
    """Equal contexts of two scales are selected alike, and stretches without a selected position are highly periodic."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, 4000).astype(np.int32)
    x[2000:3000] = x[:1000]
    scale = 8
    h = periodic.common.mix((x.astype(np.int64) + 1).astype(np.uint64))
    width = 1
    while width < scale:
        h, width = periodic._doubled(h, width), 2 * width
    at = set(periodic.selected(h, scale, np.zeros(len(x), bool)).tolist())
    inner = range(1000 - 2 * scale)
    assert [i in at for i in inner] == [i + 2000 in at for i in inner]
    assert all(any(j in at for j in range(i, i + scale)) for i in range(0, 900))


def table(spark):
    rng = random.Random(9)
    rows = [(d, " ".join(tricky(rng))) for d in range(150)]
    stock = ["".join(rng.choice("abcdefé") for _ in range(5)) for _ in range(300)]
    rows += [(d, "\n".join(" ".join(rng.choice(stock) for _ in range(12)) for _ in range(rng.randint(1, 30)))) for d in range(150, 260)]
    long = " ".join(rng.choice(stock) for _ in range(40_000))
    rows += [(BIG[0], long), (BIG[1], " ".join(["x"] * 3000)), (262, None), (263, ""), (264, " \n\t "), (265, "a b\x0bc"), (None, "a b " * 40), (None, None)]
    return rows + rows[:5]


def test_report_against_plain(spark):
    rows = table(spark)
    extra = [F.lit(1).alias(c) for c in ("row", "runs", "n_words", "own_id", "best", "collapsed", "start")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("*", *extra)
    got = sorted([tuple(r) for r in periodic.report(df).select(*COLUMNS).collect()], key=str)
    want = sorted([plain(d, t) for d, t in rows if d not in BIG], key=str)
    assert [g for g in got if g[0] not in BIG] == want
    assert {g[0]: g[1:6] for g in got if g[0] in BIG} == {BIG[0]: (0, None, None, None, None), BIG[1]: (1, 0, 3000, 1, 3_000_000)}


def test_collapse_keeps_the_other_columns(spark):
    df = spark.createDataFrame([(1, "p q r " * 10 + "z", 5), (2, None, None)], "doc_id long, text string, row int").select("*", F.lit("x").alias("runs"))
    out = {r["doc_id"]: r for r in periodic.collapse(df).collect()}
    assert out[1]["text"] == "p q r z" and out[1]["row"] == 5 and [tuple(r) for r in out[1]["runs"]] == [(0, 30, 3)] and out[1]["n_words"] == 31
    assert out[2]["text"] == "" and out[2]["runs"] == [] and out[2]["n_words"] == 0
    assert periodic.collapse(df.where("doc_id > 5")).count() == 0 and periodic.report(df.where("doc_id > 5")).count() == 0


def test_words_are_cut_in_blocks():
    text = ("ab cdé\n" * 50 + "x" * 100 + "\t" + " y z").encode()
    for limit in (1, 7, 64, 10_000):
        assert [w for b in periodic.common.word_blocks(text, limit) for w in b] == text.split()
