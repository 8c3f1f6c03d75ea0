"""Prefix trie of conversations: which beginnings are shared, by how many, and what sharing saves.

1. Every turn becomes the SHA-256 of its role and text; distinct digests are numbered in their order (the
   dictionary), so a conversation is an array of turn ids with the sizes of its texts. Very common turns are joined by
   broadcast: at most a thousand of them can hold more than a thousandth of all turns each. The others are shuffled.
2. The sequences are range-partitioned by (turn ids, conv_id): shards of consecutive sequences, also inside a large
   group of equal ones. A shard works in chunks of bounded size, each a ternary search tree: its distinct sequences
   are inserted median first, so siblings form balanced trees whatever their number. An iterative traversal
   then sums members, leaves and savings from the last node to the first.
3. Nodes on the path of a chunk's first or last sequence may continue in its neighbours. A chunk knows how many
   turns it shares with the sequence before it and whether the one after it goes on from its last; so each node is
   new, and each leaf counted, in one chunk alone, and the border nodes' sums merge by plain addition. All other
   nodes are complete where they are found.

``saved_tokens`` is additive that way: (n_convs - 1) * size = the chunks' n_convs * size, less size once.

Defined results: rows without conv_id take no part; a NULL role or text is empty; turns are ordered by turn, NULL
first, and where that is equal by digest (equal rows stay several turns); an empty table has no nodes, not even a root;
other columns aren't read. The turn ids of one conversation (8 bytes a turn and as much for sizes) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

#: turns and conversations that a chunk holds at a time
CHUNK = 100_000

EMPTY = hashlib.sha256(b"").hexdigest()
PARTS = ("kind int, key binary, up binary, conv_id long, parent_conv_id long, depth long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, piece string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---------------------------------------------------------------- sequences

def sequences(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, ids, sizes): the turns of every conversation in order, as dictionary ids and text bytes."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = C.written(conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(named, 256)).alias("digest"), F.octet_length(text).cast("long").alias("size"))
        .where("conv_id IS NOT NULL"), "turns")
    counted = turns.groupBy("digest").agg(F.count("*").alias("rows"))
    dictionary = C.written(counted.sort("digest").withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = C.joined_by_weight(turns, dictionary, ["digest"], "rows", turns.count())
    return (coded.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "id", "size"))).alias("s"))
            .select("conv_id", F.col("s.id").alias("ids"), F.col("s.size").alias("sizes")))


def spliced(found: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Sequences with shared beginnings: conversation c starts with the first h turns of conversation
    c - c % ``every`` and goes on with its own after its first h; h = crc32(c) % ``heads``."""
    found = C.written(found, "sequences")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = found.select(F.col("conv_id").alias("base"), F.col("ids").alias("base_ids"), F.col("sizes").alias("base_sizes"))
    both = found.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left").withColumn("h", h)

    def joined(name: str):
        first = F.coalesce(F.col(f"base_{name}"), F.expr("cast(array() AS array<bigint>)"))
        return F.concat(F.slice(first, F.lit(1), F.col("h")),
                        F.slice(name, F.col("h") + 1, F.greatest(F.size(name) - F.col("h"), F.lit(0)))).alias(name)

    return both.select("conv_id", joined("ids"), joined("sizes"))


# ---------------------------------------------------------------- one chunk

def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


class TernaryTree:
    """Ternary search tree over sequences of turn ids. Node 0 is the root, without a turn; ``below`` of a node is the
    top of the balanced search tree (``lower``, ``higher``) of its children, ``up`` its parent in the trie."""

    def __init__(self):
        self.turn, self.size, self.depth, self.up = [-1], [0], [0], [-1]
        self.lower, self.below, self.higher = [-1], [-1], [-1]

    def _new(self, turn: int, size: int, up: int) -> int:
        for column, value in ((self.turn, turn), (self.size, size), (self.depth, self.depth[up] + 1), (self.up, up),
                              (self.lower, -1), (self.below, -1), (self.higher, -1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node of a sequence."""
        node = 0
        for turn, size in zip(ids, sizes, strict=True):
            links, at = self.below, node
            while links[at] >= 0:
                at = links[at]
                if turn == self.turn[at]:
                    break
                links = self.lower if turn < self.turn[at] else self.higher
            else:
                links[at] = at = self._new(turn, size, node)
            node = at
        return node

    def traversal(self) -> list[int]:
        """All nodes, parents first."""
        order, stack = [0], [self.below[0]]
        while stack:
            node = stack.pop()
            if node >= 0:
                order.append(node)
                stack += (self.higher[node], self.lower[node], self.below[node])
        return order


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1: the middle one, then the middles of both halves, and so on."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            stack += ((a, middle), (middle + 1, b))


def chunk_rows(convs: np.ndarray, ids: list[np.ndarray], sizes: list[np.ndarray], shared: int,
               goes_on: bool) -> pa.RecordBatch:
    """The nodes of consecutive sequences in PARTS form. ``shared``: turns in common with the sequence before them
    (-1: there is none); ``goes_on``: the sequence after them begins with their last one or equals it."""
    head = [0] + [i for i in range(1, len(ids)) if not np.array_equal(ids[i], ids[i - 1])]
    members = np.split(convs, head[1:])
    tree, node_of = TernaryTree(), [0] * len(head)
    for i in median_order(len(head)):
        node_of[i] = tree.insert(ids[head[i]].tolist(), sizes[head[i]].tolist())
    n = len(tree.turn)
    count, least, leaves, ends = [0] * n, [None] * n, [0] * n, [None] * n
    for i, node in enumerate(node_of):
        count[node], least[node], ends[node] = len(members[i]), int(members[i][0]), members[i]
        last = i + 1 == len(head)
        on = goes_on if last else common_length(ids[head[i]], ids[head[i + 1]]) == len(ids[head[i]])
        leaves[node] = 0 if on else 1

    border, fresh = {}, [1] * n                       # nodes that neighbours may share, with their names
    for node in (node_of[0], node_of[-1]):
        path = []
        while node >= 0:
            path.append(node)
            node = tree.up[node]
        name = b""
        for p in reversed(path):
            if p:
                name = hashlib.sha256(name + tree.turn[p].to_bytes(8, "little")).digest()
            border[p] = name
    node = node_of[0]
    while node >= 0:
        if tree.depth[node] <= shared:
            fresh[node] = 0
        node = tree.up[node]

    children, saved = [0] * n, [0] * n
    order = tree.traversal()
    for node in reversed(order):
        saved[node] += tree.size[node] * (count[node] - fresh[node])
        up = tree.up[node]
        if up >= 0:
            count[up] += count[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            children[up] += fresh[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]

    rows = []
    for node in order:
        up = tree.up[node]
        text = "" if ends[node] is None else ",".join(map(str, ends[node].tolist()))
        known = up >= 0 and up not in border
        rows.append((1 if node in border else 0, border.get(node), border.get(up), least[node],
                     least[up] if known else None, tree.depth[node], count[node], children[node], leaves[node],
                     saved[node], None if node in border else hashlib.sha256(text.encode()).hexdigest(), None))
        if node in border and text:
            rows.append((2, border[node], None, int(ends[node][0]), None, None, None, None, None, None, None, text))
    kinds = [pa.int32(), pa.binary(), pa.binary()] + [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in PARTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


# ---------------------------------------------------------------- all of them

def _chunks(batches, borders: dict[int, tuple[int, bool]], chunk: int):
    """Chunks of a stream of (shard, ids, conv_id, sizes) sorted by the first three, as arguments of chunk_rows."""
    def handed(rows, before, after):
        shard, _, first, _ = rows[0]
        last = rows[-1][2]
        shared = borders[shard][0] if before is None else common_length(before, first)
        goes_on = borders[shard][1] if after is None else common_length(last, after) == len(last)
        return (np.array([r[1] for r in rows], dtype=np.int64), [r[2] for r in rows], [r[3] for r in rows],
                shared, goes_on)

    held, weight, before = [], 0, None
    for batch in batches:
        shards, convs = (batch.column(c).to_pylist() for c in ("shard", "conv_id"))
        arrays = []
        for name in ("ids", "sizes"):
            column = batch.column(name)
            at = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            arrays.append([flat[a:b].copy() for a, b in zip(at[:-1], at[1:], strict=True)])
        for row in zip(shards, convs, *arrays, strict=True):
            if held and (row[0] != held[0][0] or weight >= chunk):
                same = row[0] == held[0][0]
                yield handed(held, before, row[2] if same else None)
                before = held[-1][2] if same else None
                held, weight = [], 0
            held.append(row)
            weight += 1 + len(row[2])
    if held:
        yield handed(held, before, None)


def nodes(found: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """A row per distinct beginning of the sequences ``found`` (conv_id, ids, sizes), the empty one included:
    conv_id (smallest member; with ``depth`` it tells the node's turns), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves, saved_tokens, ends_sha256 (of the ids of members that end there)."""
    order = ["ids", "conv_id"]
    shards = C.written(found.select(*order, "sizes").repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("shard", F.spark_partition_id()), "shards")
    by_shard = Window.orderBy("shard")                                       # a row per partition
    borders = (shards.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
               .withColumn("before", F.lag("last").over(by_shard)).withColumn("after", F.lead("first").over(by_shard))
               .selectExpr("shard", """if(before IS NULL, -1, coalesce(
                                nullif(array_position(zip_with(before, first, (x, y) -> x <=> y), false), 0) - 1,
                                size(first))) AS shared""",
                           "coalesce(slice(after, 1, size(last)) = last, false) AS goes_on").collect())
    borders = {r["shard"]: (int(r["shared"]), r["goes_on"]) for r in borders}

    def run(batches):
        for args in _chunks(batches, borders, chunk):
            yield chunk_rows(*args)

    parts = C.written(shards.repartition("shard").sortWithinPartitions("shard", *order)
                      .mapInArrow(C.lean(run), PARTS), "trie")

    def digest(batches):
        key, sha = None, None
        for batch in batches:
            done = []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if k != key:
                    if sha is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield rows_of(done)
        if sha is not None:
            yield rows_of([(key, sha.hexdigest())])

    def rows_of(done):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], type=pa.binary()),
                                           pa.array([s for _, s in done], type=pa.string())], ["key", "sha"])

    ends = (parts.where("kind = 2").select("key", "conv_id", "piece").repartition("key")
            .sortWithinPartitions("key", "conv_id").mapInArrow(C.lean(digest), "key binary, sha string"))
    merged = (parts.where("kind = 1").groupBy("key")
              .agg(F.first("up").alias("up"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                   *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
              .join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY))).drop("sha"))
    merged = C.written(merged, "borders")
    inner = parts.where("kind = 0")
    mine = [c for c in COLUMNS if c != "parent_conv_id"]
    waiting = inner.where("up IS NOT NULL").select("up", *mine).unionByName(merged.where("depth > 0").select("up", *mine))
    parents = merged.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"),
                            F.col("n_children").alias("rows"))
    total = merged.count() + inner.count()
    return C.union_all([
        inner.where("up IS NULL").select(*COLUMNS),
        C.joined_by_weight(waiting, parents, ["up"], "rows", total).select(*COLUMNS),
        merged.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*COLUMNS)])


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """``nodes`` of the conversations as they are."""
    return nodes(sequences(conversations, **columns))
