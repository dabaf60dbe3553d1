"""Lattice scores against a plain version that sums over segmentations word by word."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import lowered, words
from pyspark.sql import functions as F

from tabloom.llm import catalogue
from tabloom.llm import lattice_lm as lm

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def masses(word, weights):
    """Forward and backward masses of a byte string over all cuts into pieces."""
    n, longest = len(word), max(map(len, weights))
    a, b = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for i in range(1, n + 1):
        a[i] = sum(a[i - k] * weights.get(word[i - k : i], 0.0) for k in range(1, min(i, longest) + 1))
    for i in range(n - 1, -1, -1):
        b[i] = sum(b[i + k] * weights.get(word[i : i + k], 0.0) for k in range(1, min(n - i, longest) + 1))
    return a, b


def taught(kinds, start, rounds=3):
    weights, end = dict(start), 0.2
    for _ in range(rounds):
        sums = Counter({p: 10.0 * w for p, w in start.items()})
        for w in kinds:
            w = b" " + w
            a, b = masses(w, weights)
            for i in range(len(w)):
                for k in range(1, len(w) - i + 1):
                    p = weights.get(w[i : i + k])
                    if p:
                        sums[w[i : i + k]] += a[i] * p * b[i + k] / a[-1]
        every = sum(sums.values()) + len(kinds) + 1
        weights, end = {p: x / every for p, x in sums.items()}, (len(kinds) + 1) / every
    return weights, end


def plain(rows, start):
    """(id, text, group) to the contract's columns."""
    def fold(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 5

    tokens = [[w.encode() for w in words(lowered(t))] for _, t, _ in rows]
    train = [k for k, r in enumerate(rows) if fold(r[0]) != 1]
    groups = sorted({rows[k][2] or "" for k in train})
    all_words = Counter(w for k in train for w in tokens[k])
    total, kinds = sum(all_words.values()) + len(train), len(all_words) + bool(train)
    counts = {g: Counter(w for k in train if (rows[k][2] or "") == g for w in tokens[k]) for g in groups}
    texts = {g: sum((rows[k][2] or "") == g for k in train) for g in groups}
    model = {g: taught(list(counts[g]), start) for g in groups}
    n_words = sum(all_words.values())

    def probability(g, w):
        n = sum(counts[g].values()) + texts[g] + 2
        left = (0.75 * len(counts[g]) + 1) / n
        weights, end = model[g]
        return max(counts[g][w] - 0.75, 0) / n + left * (0.5 * all_words[w] / n_words + 0.5 * masses(b" " + w, weights)[0][-1] * end)

    seen = {(g, w): math.log(probability(g, w)) for g in groups for own in tokens for w in own}
    out = []
    for (d, _, _), own in zip(rows, tokens):
        base = sum(math.log10((c + 0.5) / (total + 0.5 * (kinds + 1))) for c in [*(all_words[w] for w in own), len(train)])
        per = []
        for g in groups:
            n = sum(counts[g].values()) + texts[g] + 2
            share = (texts[g] + 1) / (len(train) + len(groups))
            per.append(math.log(share) + math.log((texts[g] + 1) / n) + sum(seen[g, w] for w in own))
        most = max(per)
        score = (most + math.log(sum(math.exp(x - most) for x in per))) / math.log(10)
        out.append((d, fold(d) == 1, len(own) + 1, sum(w in all_words for w in own) + 1, total, base, score))
    return out


def table():
    rng = random.Random(4)
    stock = ["".join(rng.choice(["in", "er", "he", "ß", "x", "7", "tion"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = [(d, " ".join(rng.choice(stock) for _ in range(rng.randint(1, 40))), rng.choice(["de", "en", None])) for d in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, " \t\n", "de"), (103, "The THE the\x0bthe", "en"), (104, "z" * 40, "en"), (None, "one two", "de"), (None, None, None)]
    rows += [(105, "unheard of words 你好 \U0001f44d", "fr"), *rows[:3]]
    return rows


def close(got, want):
    return got[:5] == want[:5] and math.isclose(got[5], want[5], abs_tol=1e-6) and math.isclose(got[6], want[6], abs_tol=1e-6)


@pytest.mark.parametrize("hot", [0, 7, 1 << 17])
def test_scores_against_plain(spark, hot):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    df = df.select("*", *[F.lit("q").alias(c) for c in ("id", "rest", "place", "key", "l0", "c0", "word", "score", "group", "label")])
    got = sorted((tuple(r) for r in lm.score(df, catalogue.piece_bpe(), group="lang", hot_words=hot).select(*COLUMNS).collect()), key=str)
    want = sorted(plain(rows, lm.vocabulary(catalogue.piece_bpe())), key=str)
    assert len(got) == len(want)
    assert all(close(g, w) for g, w in zip(got, want)), [(g, w) for g, w in zip(got, want) if not close(g, w)][:2]


def test_base_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    tokens = {d: words(lowered(t)) for d, t in rows}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for d in train for w in tokens[d])
    n, v = sum(c.values()) + len(train), len(c) + 1
    got = {r["doc_id"]: r for r in catalogue.op11_lattice_lm(spark, sf).collect()}
    for d, own in tokens.items():
        r = got[d]
        base = sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in [*(c[w] for w in own), len(train)])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own) + 1, sum(w in c for w in own) + 1, n)
        assert math.isclose(r["base_score"], base, abs_tol=1e-6) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert len(held) == len(rows) - len(train)


def test_held_out_texts_score_above_the_base(spark):
    """Texts of known kind are likelier under the lattice than under counts, and shuffled letters are not."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    out = lm.score(docs, catalogue.piece_bpe(), group="lang").where(held).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert out["s"] > 1.1 * out["b"]  # a few hundred texts: most words are new, and the base gives each of them the same
    turned = docs.withColumn("text", F.when(held, F.reverse(F.translate("text", "eaionst", "qxzjkwv"))).otherwise(F.col("text")))
    worse = lm.score(turned, catalogue.piece_bpe(), group="lang").where(held).agg(F.sum("score")).first()[0]
    assert worse < 1.3 * out["s"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert lm.score(none, catalogue.piece_bpe(), group="lang").count() == 0
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 5 == 1)
    only = lm.score(spark.createDataFrame([(held, "no training texts")], "doc_id long, text string"), catalogue.piece_bpe()).first()
    assert only["held_out"] and only["train_tokens"] == 0 and only["n_known"] == 0 and only["base_score"] == 0 and -1000 < only["score"] < 0


def test_long_words_are_walked_like_short_ones():
    start = lm.vocabulary(catalogue.piece_bpe())
    lattice = lm.Lattice(list(start))
    logs = np.log(np.array([list(start.values())]))
    rng = random.Random(1)
    word = b" " + "".join(rng.choice(["the", "re", "ß", "q", "0", "ation"]) for _ in range(200)).encode()
    arcs = lattice.arcs(np.frombuffer(word, np.uint8)[None])
    whole = lm.forward(np.where(arcs >= 0, logs[0][arcs], -np.inf))[0, -1]
    assert math.isclose(lm.walked(word, lattice.number, logs, lattice.longest)[0], whole, rel_tol=1e-12)
    got = {(i + 1 - k, i + 1) for i, k in zip(*[x + d for x, d in zip(np.nonzero(arcs[0] >= 0), (0, 1))])}
    assert got == {(a, b) for a in range(len(word)) for b in range(a + 1, min(len(word), a + lattice.longest) + 1) if word[a:b] in start}


def test_weights_are_a_distribution():
    start = lm.vocabulary(catalogue.piece_bpe())
    assert math.isclose(sum(start.values()), 1) and all(bytes([b]) in start for b in range(256)) and all(b" " not in p[1:] for p in start)
    assert start[b" t"] > start[b"in"] > start[b"er"]
