"""Batches and slots against a plain packer, and the token ids of every piece."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabloom.llm import length_buckets, token_files, toxicity
from tabloom.llm.catalogue import byte_bpe


def plain_batches(lengths, most, buckets, budget):
    """(id, piece) -> (bound, batch, slot): pieces in id order fill batches inside their bucket, bucket after bucket."""
    pieces = [(d, n, k, min(most, n - k * most)) for d, n in lengths for k in range(-(-n // most))]
    histogram = {}
    for *_, n in pieces:
        histogram[n] = histogram.get(n, 0) + 1
    out, batch = {}, 0
    bounds = length_buckets.optimal_bounds(histogram, buckets)
    for low, b in zip([0, *bounds], bounds):
        own = sorted((d is not None, d or 0, whole, k, d) for d, whole, k, n in pieces if low < n <= b)
        size = max(1, budget // b)
        for place, (*_, k, d) in enumerate(own):
            out[d, k] = b, batch + place // size, place % size
        batch += -(-len(own) // size)
    return out


@pytest.mark.parametrize("most,buckets,budget", [(128, 4, 512), (50, 1, 10), (1000, 8, 1000)])
def test_batches_and_slots_against_plain(spark, most, buckets, budget):
    lengths = [(i, (i * 37) % 300 + 1) for i in range(200)] + [(None, 7)]
    df = spark.createDataFrame(lengths, "id long, n_tokens long").repartition(5)
    got = {(r["id"], r["piece"]): (r["bound"], r["batch"], r["slot"]) for r in length_buckets.pack(df, most, buckets, budget).collect()}
    assert got == plain_batches(lengths, most, buckets, budget)


def test_pieces_hold_their_tokens(spark):
    tokenizer = Tokenizer.from_file(byte_bpe())
    rows = [(k, f"text number {k} " * (k % 40)) for k in range(120)] + [(5, "the same id again"), (None, "no id"), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = length_buckets.packed_tokens(docs, byte_bpe(), most=50).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["start"]):
        ids = np.frombuffer(r["ids"], f"<u{r['width']}").tolist()
        assert len(ids) == r["n_tokens"] <= r["bound"]
        got.setdefault(r["doc_id"], []).extend(ids)
    for d in range(120):
        if d not in (5, 7):
            want = [i for e, t in rows if e == d for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]]
            assert got[d] == want
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r["n_tokens"] for r in out) == total and len({(r["batch"], r["slot"]) for r in out}) == len(out)
    assert length_buckets.packed_tokens(docs.where("doc_id > 500"), byte_bpe()).count() == 0


def test_stages_that_encode_nothing_let_go_of_words():
    """Workers are shared by the stages of a pipeline: what packing remembered does not stay beside the next toxicity stage."""
    token_files.encoder(byte_bpe(), length_buckets.REMEMBERED).encode(["some words to remember"])
    assert token_files.encoder.cache_info().currsize
    assert list(toxicity.entries(iter(()))) == []
    assert not token_files.encoder.cache_info().currsize
