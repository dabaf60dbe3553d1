"""The conversation trie against a plain version over made-up conversations, and its parts."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tabloom.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(lists):
    """Rows per prefix of {conv: [(role, text), ...]}."""
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in m if len(lists[c]) == len(p)))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def plain_lists(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t)] for c, t in by.items()}


def plain_rebuilt(lists):
    out = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = lists.get(c - c % 100, [])[:h] + turns[h:]
    return out


def conversations(seed):
    rng = random.Random(seed)
    said = ["", "a", "bé", "longer text", "zz", None]
    rows = []
    for c in [*range(0, 40), 200, 201, 250, 999, 1000, 1001, 5_000_000_000]:
        for t in range(rng.choice([1, 1, 2, 3, 8])):
            rows.append((c, t, rng.choice(["u", "v", None]), rng.choice(said)))
    rows += [(300 + k, t, "u", "same") for k in range(60) for t in range(3)]  # a large group of copies
    rows += [(7, None, "u", "first"), (None, 0, "u", "lost"), (None, 1, "u", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit(0).alias(c) for c in ("conv", "turns", "depth", "shard")])
    lists = plain_lists(rows)
    got = sorted([tuple(r) for r in trie.prefix_nodes(trie.turn_lists(df)).select(*COLUMNS).collect()], key=str)
    assert got == plain_nodes(lists)
    got = sorted([tuple(r) for r in trie.report(df).select(*COLUMNS).collect()], key=str)
    assert got == plain_nodes(plain_rebuilt(lists))


def test_trie_does_not_depend_on_shards(spark):
    """Groups of copies and long conversations that go over many shard borders."""
    rows = [(c, t, "u", f"t{t % 5}") for c in range(50) for t in range(c % 7 * 4)] + [(c, 0, "x", "x") for c in range(50, 80)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_nodes(plain_lists(rows))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted([tuple(r) for r in trie.prefix_nodes(trie.turn_lists(df)).select(*COLUMNS).collect()], key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_rows_and_equal_numbers_are_turns(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 5, "v", "b"), (2, 5, "u", "a"), (3, 5, "u", "a"), (3, 5, "v", "b")]
    nodes = trie.prefix_nodes(trie.turn_lists(spark.createDataFrame(rows, SCHEMA))).collect()
    by_depth = {d: sorted(r["n_convs"] for r in nodes if r["depth"] == d) for d in range(3)}
    assert by_depth[0] == [3] and by_depth[2] == [1, 2]  # turns of one number stand in one order, whichever row came first


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.report(none).count() == 0
    assert trie.report(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)).count() == 0
    # the first conversation of the block is absent and its own turns are all replaced: only the root is left
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = trie.report(spark.createDataFrame([(c, 0, "u", "x")], SCHEMA)).collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"], r["saved_tokens"]) for r in rows] == [(c, 0, 1, 1, 0)]


def test_tree_is_balanced_by_medians():
    tree = trie.TernaryTree()
    for k in trie.medians_first(1000):
        tree.insert([k], 1, k, k)
    assert sorted(trie.medians_first(1000)) == list(range(1000))
    assert [tree.key[x] for x in tree.children(0)] == list(range(1000))

    def deep(slot):
        return 0 if slot == -1 else 1 + max(deep(tree.low[slot]), deep(tree.high[slot]))

    assert deep(tree.equal[0]) <= 10


def test_a_very_long_conversation(spark):
    rows = [(1, t, "u", "x" * (t % 3)) for t in range(5000)] + [(2, t, "u", "x" * (t % 3)) for t in range(4000)]
    nodes = trie.prefix_nodes(trie.turn_lists(spark.createDataFrame(rows, SCHEMA)))
    top = nodes.where("depth = 0").first()
    assert nodes.count() == 5001 and top["n_leaves"] == 1 and top["saved_tokens"] == sum(t % 3 for t in range(4000))
