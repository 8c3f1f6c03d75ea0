"""Best-fit packing with a swap-based local search.

Every text becomes token ids plus an end id; only documents longer than a sequence are cut. The
pieces (without their ids) are dealt to groups of about GROUP pieces, and each group is packed in one
task: best fit, longest first, then a local search among the underfull sequences. A step of it

* moves a piece into another sequence's gap,
* exchanges one piece for a longer one, or
* exchanges two pieces for a longer one,

so that the fuller of two sequences gets fuller: the sum of squared fills rises with every step, so the
search ends. It works on the emptiest sequence until that is empty or no step is left, then on the
next, and stops when the group has no more sequences than its tokens need. Each group wastes less than
one sequence in addition to what one search over everything would, one in GROUP.

Defined results: NULL and empty texts are documents of the end id alone; a row per piece, each input
row being its own document, also with repeated or NULL doc_ids; other columns aren't read; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import tokens

#: pieces packed together in one task
GROUP = 40_000
#: a piece is tried against pairs of at most this many of the emptiest sequence's shortest pieces
PAIRS = 64


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text's ids and the end id."""
    blob = tokens.read_file(tokenizer)
    name = tokens.version(blob)

    def run(batches):
        enc = tokens.encoder(blob, name)
        for batch in batches:
            for lo, hi, ids, counts in enc.encode(batch.column(1)):
                ends = np.cumsum(counts)
                full = np.insert(ids, ends, end_id).astype("<u4")
                stop = ends + np.arange(1, len(ends) + 1)
                begin = stop - counts - 1
                n = -(-(counts + 1) // size)
                row = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(size, (counts + 1)[row] - start)
                at = begin[row] + start
                view = memoryview(full).cast("B")
                crc = [zlib.crc32(view[a * 4:b * 4]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc, type=pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(C.lean(run, name), "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Bins:
    """Sequences by the room they have left, with the lowest fitting room found in a bit set."""

    def __init__(self, size: int):
        self.size, self.mask = size, 0
        self.by_room: list[set[int]] = [set() for _ in range(size + 1)]
        self.items: list[list[int]] = []
        self.room: list[int] = []

    def _put(self, b: int):
        r = self.room[b]
        self.by_room[r].add(b)
        self.mask |= 1 << r

    def _take(self, b: int):
        r = self.room[b]
        self.by_room[r].discard(b)
        if not self.by_room[r]:
            self.mask &= ~(1 << r)

    def change(self, b: int, out: list[int], into: list[int], length):
        self._take(b)
        for i in out:
            self.items[b].remove(i)
        self.items[b].extend(into)
        self.room[b] += sum(length[i] for i in out) - sum(length[i] for i in into)
        self._put(b)

    def new(self) -> int:
        self.items.append([])
        self.room.append(self.size)
        self._put(len(self.room) - 1)
        return len(self.room) - 1

    def best_fit(self, need: int, but: int = -1) -> int | None:
        m = self.mask >> need
        while m:
            r = need + (m & -m).bit_length() - 1
            for b in self.by_room[r]:
                if b != but:
                    return b
            m &= m - 1
        return None

    def filled(self) -> int:
        return sum(1 for x in self.items if x)


def pack(length: list[int], size: int) -> list[list[int]]:
    """Piece numbers of each sequence."""
    bins = _Bins(size)
    for i in sorted(range(len(length)), key=lambda i: -length[i]):
        b = bins.best_fit(length[i])
        bins.change(bins.new() if b is None else b, [], [i], length)
    needed = -(-sum(length) // size)
    stuck: set[int] = set()
    while bins.filled() > needed:
        open_ = [b for b in range(len(bins.items)) if bins.items[b] and bins.room[b] and b not in stuck]
        if len(open_) < 2:
            break
        emptiest = max(open_, key=lambda b: (bins.room[b], b))
        if not _empty(bins, emptiest, length):
            stuck.add(emptiest)
    return [x for x in bins.items if x]


def _empty(bins: _Bins, a: int, length: list[int]) -> bool:
    """Steps out of sequence ``a`` until it is empty (True) or no step raises the squared fill."""
    size = bins.size
    while bins.items[a]:
        mine = sorted(bins.items[a], key=lambda i: -length[i])
        step = None
        for i in mine:                                       # move
            b = bins.best_fit(length[i], but=a)
            if b is not None and bins.items[b]:
                step = (b, [i], [])
                break
        if step is None:                                     # one for one, two for one
            give: dict[int, list[int]] = {length[i]: [i] for i in mine}
            for i, j in combinations(mine[-PAIRS:], 2):
                give.setdefault(length[i] + length[j], [i, j])
            sizes = sorted(give)
            best = 0
            for b in range(len(bins.items)):
                room = bins.room[b]
                if b == a or not room or not bins.items[b] or bins.room[a] < room:
                    continue
                for k in bins.items[b]:
                    # the longest gift that b holds in place of k
                    at = bisect_right(sizes, length[k] + room) - 1
                    gain = sizes[at] - length[k] if at >= 0 else 0
                    if gain > best and size - bins.room[a] - gain >= 0:
                        best, step = gain, (b, give[sizes[at]], [k])
                        if gain == room:
                            break
                if step is not None and best == room:
                    break
        if step is None:
            return False
        b, out, back = step
        bins.change(a, out, back, length)
        bins.change(b, back, out, length)
    return True


def best_fit(docs: DataFrame, tokenizer: str, *, size: int = 2048, end_id: int = 0, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = C.written(pieces(docs, tokenizer, size, end_id, id_col, text_col), "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("long"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)
        length = pdf["length"].tolist()
        short = [i for i, n in enumerate(length) if n < size]
        made = [[short[i] for i in x] for x in pack([length[i] for i in short], size)]
        made += [[i] for i, n in enumerate(length) if n == size]
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for s, items in enumerate(made):
            at = 0
            for i in sorted(items):
                sequence[i], offset[i] = s, at
                at += length[i]
        pdf["sequence_id"] = pdf["group"] * (1 << 32) + sequence
        pdf["offset"] = offset
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("group").applyInPandas(run, kind)
