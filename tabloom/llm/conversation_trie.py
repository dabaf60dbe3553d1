"""Prefix trie of conversations: ternary search trees per range shard, merged along the shard borders.

A conversation is a list of turns; a turn is named by the digest of its role and text. Conversations are dealt to shards by ranges of
(turn digests, conversation id), so a shard is a stretch of the sorted conversations and a group of equal ones may be split by id.
A shard encodes its turns by a dictionary of its own and inserts each distinct conversation into a ternary search tree, medians
first, which keeps the trees balanced; a traversal without recursion then sums members, leaves and savings. Only nodes on the paths to
a shard's first and last conversation can go on in another shard: these border nodes, at most two paths a shard, are merged in shard
order by one pass that holds one open path.

Edge cases: rows without a conversation id belong to no conversation; null role and text are empty; null turns come first; turns
of equal number are ordered by the digest of role and text, equal rows are turns of their own; an empty table has no nodes; columns
other than the four named are not read, so their names cannot clash. A conversation is handled as one list of 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import common
from tabloom.operators.frames import name

#: Bytes of a turn's digest in a path.
WIDTH = 16
BATCH = 10_000
SUMS = "n_convs long, n_children long, n_leaves long, saved_tokens long"
PART = (
    "shard int, pos int, border boolean, depth long, conv_id long, parent_pos int, parent_conv_id long, turn binary, size long, "
    f"{SUMS}, ends string"
)
MERGED = f"shard int, pos int, node long, parent long, depth long, conv_id long, {SUMS}"


def turn_lists(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv long, turns): per conversation its turns in order, as structs of digest and code points of the text."""
    speaker, said = F.coalesce(name(role), F.lit("")), F.coalesce(name(text), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(speaker).cast("string"), F.lit(":"), speaker, said).cast("binary"), 256), 1, 2 * WIDTH)
    rows = conversations.where(name(conv).isNotNull()).select(
        name(conv).cast("long").alias("conv"),
        F.struct(
            name(turn).isNotNull().alias("numbered"), name(turn).alias("turn"), digest.alias("digest"), F.length(said).alias("size")
        ).alias("item"),
    )
    ordered = F.transform(F.array_sort(F.collect_list("item")), lambda x: F.struct(x["digest"].alias("digest"), x["size"].alias("size")))
    return rows.groupBy("conv").agg(ordered.alias("turns"))


class TernaryTree:
    """A ternary search tree over lists of turn numbers; node 0 is the empty prefix."""

    def __init__(self) -> None:
        self.key, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.members, self.least, self.group = [0], [None], [-1]

    def _new(self, turn: int) -> int:
        for column, value in (
            (self.key, turn), (self.low, -1), (self.equal, -1), (self.high, -1), (self.members, 0), (self.least, None), (self.group, -1)
        ):
            column.append(value)
        return len(self.key) - 1

    def _child(self, at: int, turn: int) -> int:
        link, slot = self.equal, at
        while link[slot] != -1:
            slot = link[slot]
            if self.key[slot] == turn:
                return slot
            link = self.low if turn < self.key[slot] else self.high
        link[slot] = self._new(turn)
        return len(self.key) - 1

    def _count(self, at: int, members: int, least: int) -> None:
        self.members[at] += members
        if self.least[at] is None or least < self.least[at]:
            self.least[at] = least

    def insert(self, turns: list[int], members: int, least: int, group: int) -> None:
        at = 0
        self._count(at, members, least)
        for turn in turns:
            at = self._child(at, turn)
            self._count(at, members, least)
        self.group[at] = group

    def children(self, at: int) -> list[int]:
        """A node's children by rising turn number: an in-order walk of their search tree."""
        out, waiting, slot = [], [], self.equal[at]
        while waiting or slot != -1:
            while slot != -1:
                waiting.append(slot)
                slot = self.low[slot]
            slot = waiting.pop()
            out.append(slot)
            slot = self.high[slot]
        return out

    def walk(self) -> list[tuple[int, int, int, int]]:
        """(node, parent, depth, number of children) in order, parents before their children."""
        order, waiting = [], [(0, -1, 0)]
        while waiting:
            at, parent, depth = waiting.pop()
            below = self.children(at)
            order.append((at, parent, depth, len(below)))
            waiting += [(x, at, depth + 1) for x in reversed(below)]
        return order


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    waiting = [(0, n)]
    while waiting:
        a, b = waiting.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            waiting += [(a, middle), (middle + 1, b)]


def _groups(batches: Iterator[pa.RecordBatch]) -> list[tuple[bytes, list[int], list[int]]]:
    """(path, sizes, conversation ids) of the distinct paths of a shard, whose rows come sorted by path and id."""
    out: list[tuple[bytes, list[int], list[int]]] = []
    for batch in batches:
        paths = batch.column(1).to_pylist()
        sizes = batch.column(2)
        for i, (conv, path) in enumerate(zip(batch.column(0).to_pylist(), paths)):
            if not out or out[-1][0] != path:
                out.append((path, sizes[i].as_py(), []))
            out[-1][2].append(conv)
    return out


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes of a shard. Sums of border nodes leave out their border children, and their ends are ids, not yet a digest."""
    from pyspark import TaskContext

    groups = _groups(batches)
    if not groups:
        return
    shard = TaskContext.get().partitionId()
    split = [[p[i : i + WIDTH] for i in range(0, len(p), WIDTH)] for p, _, _ in groups]
    dictionary = sorted({turn for turns in split for turn in turns})
    number = {turn: k for k, turn in enumerate(dictionary)}
    encoded = [[number[turn] for turn in turns] for turns in split]
    size = [0] * len(dictionary)
    for turns, (_, sizes, _) in zip(encoded, groups):
        for turn, s in zip(turns, sizes):
            size[turn] = s
    tree = TernaryTree()
    for g in medians_first(len(groups)):
        tree.insert(encoded[g], len(groups[g][2]), groups[g][2][0], g)
    border = {0}
    for turns in (encoded[0], encoded[-1]):
        at = 0
        for turn in turns:
            at = tree._child(at, turn)
            border.add(at)
    order = tree.walk()
    pos = {at: k for k, (at, _, _, _) in enumerate(order)}
    below, leaves, saved = [0] * len(tree.key), [0] * len(tree.key), [0] * len(tree.key)
    for at, parent, _, _ in reversed(order):
        if at in border:
            continue
        leaves[at] = leaves[at] or 1
        saved[at] += (tree.members[at] - 1) * size[tree.key[at]]
        below[parent] += 1
        leaves[parent] += leaves[at]
        saved[parent] += saved[at]
    rows = []
    for at, parent, depth, _ in order:
        edge, ids = at in border, groups[tree.group[at]][2] if tree.group[at] >= 0 else []
        outer = parent in border
        rows.append((
            shard, pos[at], edge, depth, tree.least[at], pos[parent] if outer else None, None if outer or parent < 0 else tree.least[parent],
            dictionary[tree.key[at]] if edge and at else None, size[tree.key[at]] if at else 0,
            tree.members[at], below[at], leaves[at], saved[at], (",".join(map(str, ids)) if edge else _digest(ids)) if ids or not edge else None,
        ))
    yield from _batches(rows, PART)


def _batches(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    for a in range(0, len(rows), BATCH):
        columns = zip(*rows[a : a + BATCH])
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[f for f, _ in fields])


class _Open:
    """A border node whose conversations may go on in the next shard."""

    __slots__ = ("node", "turn", "size", "conv", "sums")

    def __init__(self, node: int, turn: bytes | None, size: int) -> None:
        self.node, self.turn, self.size, self.conv, self.sums = node, turn, size, None, [0, 0, 0, 0]


def merge_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Border nodes in (shard, pos) order to one row per node, and one row (shard, pos, node) per place where it was seen.

    Shards are stretches of one sorted order, so a node goes on in the next shard exactly if it lies on the open path.
    """
    path: list[_Open] = []
    rows: list[tuple] = []
    made = 0

    def close(depth: int) -> None:
        while len(path) > depth:
            at = path.pop()
            members, children, leaves, saved = at.sums
            leaves, saved = leaves or 1, saved + (members - 1) * at.size
            rows.append((None, None, at.node, path[-1].node if path else None, len(path), at.conv, members, children, leaves, saved))
            if path:
                for k, more in ((1, 1), (2, leaves), (3, saved)):
                    path[-1].sums[k] += more

    for batch in batches:
        for r in batch.to_pylist():
            depth = r["depth"]
            if depth >= len(path) or path[depth].turn != r["turn"]:
                close(depth)
                path.append(_Open(made, r["turn"], r["size"]))
                made += 1
            at = path[depth]
            at.conv = r["conv_id"] if at.conv is None else min(at.conv, r["conv_id"])
            for k, column in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens")):
                at.sums[k] += r[column]
            rows.append((r["shard"], r["pos"], at.node, None, None, None, None, None, None, None))
        if len(rows) >= BATCH:
            yield from _batches(rows, MERGED)
            rows.clear()
    close(0)
    yield from _batches(rows, MERGED)


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shard, ids) sorted by node and shard to (node, ends): the digest runs over a node's ids shard by shard."""
    node, digest, rows = None, None, []
    for batch in batches:
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != node:
                if node is not None:
                    rows.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(rows) >= BATCH:
            yield from _batches(rows, "node long, ends string")
            rows.clear()
    if node is not None:
        rows.append((node, digest.hexdigest()))
    yield from _batches(rows, "node long, ends string")


def prefix_nodes(lists: DataFrame) -> DataFrame:
    """One row per distinct prefix of `lists` (conv, turns), the empty one included.

    conv_id is the smallest member, parent_conv_id that of the prefix one turn shorter; n_leaves and saved_tokens are sums over the
    subtree, a node saving the code points of its last text once for each member but one; ends_sha256 is of the ids, ascending, of
    the conversations that end there. Shard nodes are kept in the shared folder.
    """
    spark = lists.sparkSession
    parts = common.shuffle_partitions(spark)
    own = lists.select(
        "conv", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    sorted_ = own.repartitionByRange(parts, "path", "conv").sortWithinPartitions("path", "conv")
    nodes = common.written(sorted_.mapInArrow(shard_nodes, PART), "trie")
    border = nodes.where("border")
    single = border.drop("ends", "border", "parent_pos", "parent_conv_id").repartition(1).sortWithinPartitions("shard", "pos")
    merged = common.written(single.mapInArrow(merge_borders, MERGED), "trie-borders")
    seen = merged.where("shard IS NOT NULL").select("shard", "pos", "node")
    whole = merged.where("shard IS NULL").drop("shard", "pos")
    ids = border.where("ends IS NOT NULL").select("shard", "pos", "ends").join(seen, ["shard", "pos"]).select("node", "shard", "ends")
    ends = ids.repartition(parts, "node").sortWithinPartitions("node", "shard").mapInArrow(joined_ids, "node long, ends string")
    result = [F.col(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    upper = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    borders = whole.join(upper, "parent", "left").join(ends, "node", "left").select(
        *result, F.coalesce("ends", F.lit(_digest([]))).alias("ends_sha256")
    )
    inner = nodes.where("NOT border")
    places = seen.join(whole.select("node", "conv_id"), "node").select("shard", F.col("pos").alias("parent_pos"), F.col("conv_id").alias("parent_conv_id"))
    below_border = inner.where("parent_pos IS NOT NULL").drop("parent_conv_id").join(places, ["shard", "parent_pos"])
    rest = inner.where("parent_pos IS NULL").unionByName(below_border.select(*inner.columns))
    return borders.unionByName(rest.select(*result, F.col("ends").alias("ends_sha256")))


def rebuilt(lists: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """Conversations whose first turns are those of their block's first conversation.

    Of conversation c, the first h turns of conversation c - c % block (fewer if it has fewer, none if there is none) replace c's
    own first h; h is crc32(c as text) modulo most + 1.
    """
    heads = lists.where(F.col("conv") % block == 0).select(F.col("conv").alias("lead"), F.col("turns").alias("lead_turns"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).cast("int")
    own = lists.withColumns({"h": h, "lead": F.col("conv") - F.col("conv") % block}).join(heads, "lead", "left")
    head = F.slice(F.coalesce("lead_turns", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return own.select("conv", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def report(conversations: DataFrame) -> DataFrame:
    """The prefix nodes of the rebuilt conversations."""
    return prefix_nodes(rebuilt(turn_lists(conversations)))
