"""Helpers shared by the operators of this folder.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of a text's UTF-8 form. They are
found and hashed with numpy over whole Arrow columns: a few array passes per column instead of one
Python object per word.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import joined_by_weight, prepared, shared_folder, union_all, written  # noqa: F401

#: texts are worked on in pieces of about this many bytes, so memory does not follow batch sizes
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_U = np.uint64
#: odd bases of the two polynomial word hashes, and their inverses modulo 2**64
_BASES = tuple((b, pow(b, -1, 1 << 64)) for b in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
_POWERS: dict[int, np.ndarray] = {}


# ---------------------------------------------------------------- worker memory

#: what a worker keeps from task to task, by name
KEPT: dict[str, object] = {}


def give_back():
    """Return freed memory to the system; allocators would hold on to a task's peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run, keep: str = ""):
    """Task code that shares its executor's memory well: what other operators' tasks left in this reused worker (but
    ``keep``) goes first, and freed memory is given back at the end."""
    def task(batches):
        if [KEPT.pop(name) for name in list(KEPT) if name != keep]:
            give_back()
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            give_back()
    return task


# ---------------------------------------------------------------- words of Arrow columns

def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into (first row, last row + 1, bytes, offsets) of about ``limit`` bytes.
    A NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    rows = len(column)
    if not rows:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + rows + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(rows, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and for each text the index of its first word
    (one more entry at the end)."""
    if not len(data):
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(len(offsets), dtype=np.int64),)
    inside = ~_SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True                                  # a word never crosses into the next text
    at = np.flatnonzero(edge)
    word = inside[at[:-1]]
    starts, ends = at[:-1][word], at[1:][word]
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return _LOWER[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, for uint64 arrays."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(b: int, n: int) -> np.ndarray:
    have = _POWERS.get(b)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE_BYTES + 4096), _U(b), dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= PIECE_BYTES + 4096:
            _POWERS[b] = have
    return have


#: longer words are digested one by one
LONG_WORD = 256


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of the bytes ``data[start:end]`` of each span: eight bytes at a time through the finaliser, so
    no pattern of letters cancels out. ``which`` (0 or 1) picks one of two independent hashes."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _U(0xA24BAED4963EE407) + _U(_BASES[which][0]))
    if not len(size):
        return h
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, dtype=np.uint8)]), 8)
    at = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    done = 0
    while len(at):
        block = np.ascontiguousarray(eight[starts[at] + done]).view("<u8").ravel()
        left = size[at] - done
        block &= _U(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(left, 8)).astype(np.uint64) * _U(8))
        h[at] = mix((h[at] ^ block) * _U(_BASES[1 - which][0]) + _U(0x632BE59BD9B4E019))
        done += 8
        at = at[left > 8]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=bytes([which])).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for each of any overlapping spans of word hashes, by prefix sums of a
    polynomial modulo 2**64. ``which`` (0 or 1) picks one of two hashes. Different spans collide by chance alone, but for
    spans made for it: of a thousand words and more that alternate in a pattern of their own."""
    base, inverse = _BASES[which]
    n = len(values)
    terms = values.astype(np.uint64)
    terms += _U(1)
    terms *= _powers(base, n)[:n]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(inverse, n + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xA24BAED4963EE407))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def long_list(values: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """A list column from one array per row."""
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def gathered(batches, rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of a stream in batches of about ``rows``; for rows that are small."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=rows)


def groups(batches, keys: list[str], load) -> Iterator[dict[str, np.ndarray]]:
    """The groups of a stream of batches sorted by ``keys``, as arrays. ``load`` turns a batch into
    arrays of equal first dimension. A group may span batches; only it is kept back."""
    rest: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = load(batch)
        if rest is not None:
            cols = {k: np.concatenate([rest[k], v]) for k, v in cols.items()}
        n = len(cols[keys[0]])
        new = np.zeros(n, dtype=bool)
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
        at = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield {k: v[a:b] for k, v in cols.items()}
        rest = {k: v[at[-1]:].copy() for k, v in cols.items()}
    if rest is not None:
        yield rest


# ---------------------------------------------------------------- connected components

#: rows of a table of links that a task takes, at least: tables of few links are few tasks, whatever the session's
#: number of shuffle partitions (a matter of the plan, no rows depend on it)
LINKS_PER_TASK = 250_000


def _in_few(df: DataFrame, rows: int) -> DataFrame:
    tasks = -(-rows // LINKS_PER_TASK)
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, tasks)) if tasks < wide else df


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)``; a component is named by its smallest node.

    Alternating large-star and small-star rounds. Links stay distributed: the driver sees two
    numbers a round. Each round's links are a written table. Every group is reduced to its minimum
    before it is joined back, so a hub's rows can be split.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .distinct())
    e = written(e, "links")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        e = _in_few(e, state[0])
        both = _in_few(e.union(e.select("v", "u")), 2 * state[0])
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _in_few(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(low.select("u", F.col("m").alias("v"))).where("u <> v"), 2 * state[0]).distinct()
        e = written(small, "links")
    e = _in_few(e, seen[0])
    nodes = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = nodes.select(F.col("component").alias("node"), "component").distinct()
    return written(_in_few(nodes.union(roots), 2 * seen[0]), "components")


def merged_components(comps: DataFrame, more: DataFrame) -> DataFrame:
    """``comps`` (node, component) with further links ``more`` (a, b) between components or nodes that have none yet.
    Only the components that a link joins are searched again, as nodes of a smaller graph."""
    if more.isEmpty():
        return comps
    own = comps.select("node", F.col("component").alias("c"))
    links = (more.join(own.withColumnRenamed("node", "a"), "a", "left").withColumn("x", F.coalesce("c", "a")).drop("c")
             .join(own.withColumnRenamed("node", "b"), "b", "left").withColumn("y", F.coalesce("c", "b")))
    links = written(links.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct(), "quotient")
    joined = components(links).select(F.col("node").alias("component"), F.col("component").alias("top"))
    sizes = comps.groupBy("component").agg(F.count("*").alias("rows"))
    names = written(sizes.join(joined, "component", "left").withColumn("top", F.coalesce("top", "component")), "names")
    known = joined_by_weight(comps, names, ["component"], "rows", comps.count())
    lone = joined.join(sizes, "component", "left_anti")
    return written(known.select("node", F.col("top").alias("component")).union(lone.select("component", "top")), "components")
