"""Ratio and verdict of the quality rules against a plain version; rows of one id."""

import math
import random
import struct

import numpy as np
import pytest
import xxhash
from brute import op4_base, words

from tabloom.llm import quality_ratio, token_files
from tabloom.llm.catalogue import byte_bpe


def long_hash(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v), seed)
    return seed


def cells(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    pairs = [long_hash(*h[i : i + 2]) for i in range(len(h))]
    return [x % quality_ratio.BUCKETS for x in h + pairs]


def held_back(d):
    signed = xxhash.xxh64_intdigest(struct.pack("<i", 5), xxhash.xxh64_intdigest(str(d).encode(), 42))
    return (signed - (1 << 64) if signed >= 1 << 63 else signed) % 5 == 0


def plain(rows, good):
    """(ratio, kept) per row."""
    raw, target, held = {}, {}, []
    split = {held_back(d) for d, t in rows if d in good and cells(t)} == {True, False}
    for d, t in rows:
        for c in cells(t):
            raw[c] = raw.get(c, 0) + 1
            if d in good and not (split and held_back(d)):
                target[c] = target.get(c, 0) + 1
    all_raw, all_target = sum(raw.values()) + quality_ratio.BUCKETS, sum(target.values()) + quality_ratio.BUCKETS

    def ratio(t):
        own = cells(t)
        total = sum(math.log((target.get(c, 0) + 1) / all_target) - math.log((raw.get(c, 0) + 1) / all_raw) for c in own)
        return total / len(own) if own else 0.0

    for held in ([(d, t) for d, t in rows if d in good and held_back(d)] if split else [], [(d, t) for d, t in rows if d in good]):
        judges = sorted(ratio(t) for _, t in held if len(words(t)) >= 50)
        if judges:
            break
    low = judges[max(0, math.ceil(quality_ratio.LOW * len(judges)) - 1)] if judges else None
    out = []
    for _, t in rows:
        failed = op4_base(t)[-1]
        out.append((ratio(t) if target else 0.0, not failed and (low is None or ratio(t) >= low - 1e-9)))
    return out


@pytest.mark.parametrize("share", [0.5, 0.02, 0.0])
def test_ratio_and_verdict_against_plain(spark, share):
    rng = random.Random(11)
    good_words, other = [["".join(rng.choice(a) for _ in range(rng.randint(1, 5))) for _ in range(80)] for a in ("abcdé", "wxyz#")]
    rows = []
    for d in range(200):
        mix = rng.random() if d % 2 else 0.02
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(rng.choice(other if rng.random() < mix else good_words) for _ in range(rng.choice([20, 80, 160])))))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "x " * 90), (7, rows[7][1])]
    good = {d for d, _ in rows if d % 2 == 0 and rng.random() < 2 * share}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(d, 1) for d in good] + [(d, 0) for d in range(205) if d not in good] + [(None, 1)], "doc_id long, quality int")
    got = sorted((r["doc_id"], round(r["ratio"], 6), r["kept"]) for r in quality_ratio.report(docs, labels).collect())
    want = sorted((d, round(r, 6), k) for (d, _), (r, k) in zip(rows, plain(rows, good)))
    assert [g[0::2] for g in got] == [w[0::2] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=2e-6)


def test_rows_of_one_id_fill_several_shards(spark, tmp_path):
    """A third of all rows under one id, half of these copies of one text: no shard holds many more than its share."""
    rows = [(d, f"text {d}") for d in range(600)] + [(None, f"null {k % 50}" if k % 2 else "copy") for k in range(300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        shards = token_files.write_tokens(docs, str(tmp_path), byte_bpe()).collect()
        assert max(s["n_docs"] for s in shards) <= 2 * 900 / 9 and sum(s["n_docs"] for s in shards) == 900
        back = token_files.read_tokens(spark, str(tmp_path)).orderBy("start").collect()
        assert [r["doc_id"] for r in back] == [None] * 300 + list(range(600))
        assert [r["start"] for r in back] == np.cumsum([0] + [r["n_tokens"] for r in back])[:-1].tolist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_words_are_not_remembered():
    encoder = token_files.Encoder(byte_bpe())
    texts = ["ab " + "x" * 5000 + " é" + "y" * 100 + " b,"]
    want = encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(texts)[0], encoder.dtype).tolist() == want
    assert max(map(len, encoder.known)) <= token_files.LONGEST


def test_forgetting_words_changes_no_id(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abé,.\u4f605") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 300))) for _ in range(40)]
    whole = token_files.Encoder(byte_bpe())
    want = [np.array(e.ids, whole.dtype).tobytes() for e in whole.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert whole.encode(texts) == want
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    small = token_files.Encoder(byte_bpe())
    assert small.encode(texts[:20]) == want[:20] and small.encode(texts[::-1]) == want[::-1]


@pytest.mark.parametrize("places", [1 << 24, 1 << 60, 8])
def test_repeated_windows_whatever_the_hash_bits(spark, monkeypatch, places):
    """Few hash bits make windows collide, few places make texts too long; both are settled by the words."""
    monkeypatch.setattr(quality_ratio, "PLACES", places)
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["a a a a", "a b c d a b c", "x y z x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = quality_ratio.base_columns(docs, "text", [0.0] * quality_ratio.BUCKETS)
    assert [r["n_repeat_words"] for r in own.orderBy("doc_id").collect()] == [op4_base(t)[4] for t in texts]


def test_many_trusted_ids_are_joined_by_a_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "some words " * (20 + k % 30)) for k in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", (docs["doc_id"] % 2).cast("int").alias("quality"))
    want = quality_ratio.learn(docs, labels)
    monkeypatch.setattr(quality_ratio, "BROADCAST_IDS", 3)
    assert quality_ratio.learn(docs, labels) == want
