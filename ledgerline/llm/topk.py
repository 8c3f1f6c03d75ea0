"""Exact top-k by inner product: a Voronoi join of queries and data.

Vectors are whole numbers, floor(scale * x). Up to PIVOTS rows of smallest id hash are the pivots; every row belongs to
the cell of its nearest pivot.

1. Summaries of the cells: rows, largest distance to the pivot and largest norm of the data; count and
   largest distance of the queries. The pivots are data rows themselves, so a query's k-th best
   pivot is a score that its result reaches: the least of a cell's queries is the cell's bound.
2. Queries of neighbouring cells form groups of about GROUP. For a query q in the cell of p, q * x <= p * x + R |x|
   with R the cell's largest query distance. A whole data cell of pivot c, radius r and largest norm m cannot
   reach it when p * c + r |p| + R m is below the bound; of the other cells, each row is tested by itself. Only
   rows that some cell of a group may need are replicated to the group.
3. A group's rows are dealt over blocks of about BLOCK rows, which its queries meet in tasks: exact products, and
   the k best of a block for every query. Equal vectors in any number are spread like others. The blocks' results
   are merged.

Bounds allow for rounding; products are exact integers. So the result is that of brute force, and pruning depends on the
data: vectors without clusters in many dimensions are nearly all needed by every group.

Defined results: rows without an id, or whose vector is NULL or holds NULL or non-finite components, take no part; a
shorter vector counts as one with zeros at its end; rows that share an id never find each other, and of
several the best score counts, once; with fewer candidates than k all are returned; scores beyond long
are its ends; other columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import vectors as V

PIVOTS = 1024
#: queries of a group, and data rows of a block, about
GROUP, BLOCK = 4096, 8192
#: room for rounding in bounds, as a share of the largest term
SLACK = 1e-9
#: the score of none
MISSING = np.iinfo(np.int64).min


def _kth_best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every row of ``scores`` without those that are ``own``; -inf where there are fewer."""
    s = np.where(own, -np.inf, scores.astype(np.float64))
    if s.shape[1] < k:
        return np.full(len(s), -np.inf)
    best = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    return np.where(best <= -2.0 ** 62, -np.inf, best - 1 - SLACK * np.abs(best))


def best_of_block(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of each row's k best scores, ties to the smaller column; MISSING is none."""
    m = scores.shape[1]
    edge = np.partition(scores, m - k, axis=1)[:, m - k] if m > k else np.full(len(scores), MISSING)
    i, j = np.nonzero((scores >= edge[:, None]) & (scores > MISSING))
    order = np.lexsort((j, -scores[i, j], i))
    i, j = i[order], j[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    return i[nth < k], j[nth < k]


class Cells:
    """Pivots with the summaries of their cells, and which query groups each may serve."""

    def __init__(self, pivots: np.ndarray, summary: list):
        self.pivots, p = pivots, len(pivots)
        self.radius, self.norm = np.zeros(p), np.zeros(p)
        count, self.reach, self.bound = np.zeros(p, dtype=np.int64), np.zeros(p), np.full(p, np.inf)
        for r in summary:
            c = r["cell"]
            self.radius[c], self.norm[c] = r["radius"], r["norm"]
            if r["asked"]:
                count[c], self.reach[c], self.bound[c] = r["asked"], r["reach"], r["bound"]
        self.asked = np.flatnonzero(count)
        self.group_of, self.parts = np.full(p, -1), []
        for group in self._neighbours(count):
            self.group_of[group] = len(self.parts)
            self.parts.append(max(1, math.ceil(count[group].sum() / GROUP)))
        a, sizes = self.asked, V.norms(pivots)
        most = np.abs(pivots @ pivots[a].T)
        far = self.radius[:, None] * sizes[a] + self.norm[:, None] * self.reach[a]
        self.meets = ((pivots @ pivots[a].T) + far + SLACK * (most + far) + 1 >= self.bound[a]) & (self.norm[:, None] >= 0)

    def _neighbours(self, count: np.ndarray) -> list[list[int]]:
        """Cells with queries as groups of about GROUP queries: each goes on with the nearest cell left."""
        left, groups, total = list(self.asked), [], 0
        at = left[0] if left else None
        while left:
            gaps = V.norms(self.pivots[left] - self.pivots[at])
            at = left.pop(int(gaps.argmin()))
            if not groups or total + count[at] > GROUP:
                groups.append([])
                total = 0
            groups[-1].append(at)
            total += count[at]
        return groups

    def needed(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """(rows, groups): which rows a group may need."""
        out = np.zeros((len(x), len(self.parts)), dtype=bool)
        if len(self.asked) and len(x):
            at, size = x @ self.pivots[self.asked].T, V.norms(x)[:, None]
            far = size * self.reach[self.asked]
            may = self.meets[cell] & (at + far + SLACK * (np.abs(at) + far) + 1 >= self.bound[self.asked])
            i, j = np.nonzero(may)
            out[i, self.group_of[self.asked[j]]] = True
        return out


def top_k(vectors: DataFrame, *, k: int = 10, every: int = 100, scale: float = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank, vec_id, score of the ``k`` rows of largest
    inner product, ties to the smaller vec_id."""
    valid = V.usable(vectors, id_col, vector_col)
    known = valid.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size")).first()
    if not known["n"]:
        return valid.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0L AS score")
    n, size = known["n"], known["size"]
    chosen = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(PIVOTS, math.isqrt(n - 1) + 1))
    chosen = {r["vec_id"]: r["v"] for r in chosen.collect()}                    # at most PIVOTS rows
    names = np.array(list(chosen), dtype=np.int64)
    pivots = V.whole(pa.array(list(chosen.values()), type=pa.list_(pa.float64())), size, scale)
    sizes = V.norms(pivots)
    kind = valid.schema["v"].dataType.simpleString()

    def assign(batches):
        for batch in (b.slice(lo, 1000) for b in batches for lo in range(0, b.num_rows, 1000)):
            x, ids = V.whole(batch.column(1), size, scale), batch.column(0).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                cell = np.argmin(sizes * sizes - 2 * (x @ pivots.T), axis=1)
                away, norm = V.norms(x - pivots[cell]), V.norms(x)
            asks = ids % every == 0
            bound = np.full(len(x), np.inf)
            bound[asks] = _kth_best(V.products(x[asks], pivots), names == ids[asks][:, None], k)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c) for c in (cell.astype(np.int32), away, norm, asks, bound)]],
                ["vec_id", "v", "cell", "away", "norm", "asks", "bound"])

    placed = C.written(valid.mapInArrow(C.lean(assign), f"vec_id long, v {kind}, cell int, away double, norm double, "
                                                        "asks boolean, bound double"), "cells")
    summary = placed.groupBy("cell").agg(
        F.max("away").alias("radius"), F.max("norm").alias("norm"), F.count_if("asks").alias("asked"),
        F.max(F.expr("if(asks, away, 0D)")).alias("reach"), F.min("bound").alias("bound")).collect()
    cells = Cells(pivots, summary)                                              # a row per pivot
    blocks = math.ceil(n / BLOCK)

    def replicated(batches):
        nth = 0
        for batch in batches:
            x, ids = V.whole(batch.column(1), size, scale), batch.column(0).to_numpy(zero_copy_only=False)
            cell = batch.column(2).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                needed = cells.needed(x, cell)
            block = (nth + np.arange(len(x))) % blocks
            nth += len(x)
            for g, parts in enumerate(cells.parts):
                rows = np.flatnonzero(needed[:, g])
                for part in range(parts):
                    yield dealt(batch, rows, g, part, block[rows], 0)
            asks = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
            for i in asks.tolist():
                g = int(cells.group_of[cell[i]])
                yield dealt(batch, np.full(blocks, i), g, int(ids[i] // every) % cells.parts[g], np.arange(blocks), 1)

    def dealt(batch, rows, group, part, block, asks):
        own = [pa.array(np.full(len(rows), c, dtype=np.int32)) for c in (group, part, asks)]
        rows = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(block.astype(np.int32)), batch.column(0).take(rows), batch.column(1).take(rows)],
            ["grp", "part", "asks", "block", "vec_id", "v"])

    def hold(table):
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        ids = table.column("vec_id").to_numpy()[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        return ids, first, V.whole(table.column("v"), size, scale)[order]

    def answer(held, rows):
        ids, first, x = held
        asked = rows.column("vec_id").to_numpy(zero_copy_only=False)
        scores = np.maximum(V.products(V.whole(rows.column("v"), size, scale), x), MISSING + 1)
        if len(first) < len(ids):                                               # the best of an id's rows
            scores = np.maximum.reduceat(scores, first, axis=1)
        names = ids[first]
        scores[names == asked[:, None]] = MISSING
        i, j = best_of_block(scores, k)
        yield pa.RecordBatch.from_arrays([pa.array(asked[i]), pa.array(names[j]), pa.array(scores[i, j])],
                                         ["query_id", "vec_id", "score"])

    keys = ["grp", "part", "block"]
    found = (placed.select("vec_id", "v", "cell", "asks")
             .mapInArrow(C.lean(replicated), f"grp int, part int, asks int, block int, vec_id long, v {kind}")
             .repartition(*keys).sortWithinPartitions(*keys, "asks")
             .mapInArrow(C.lean(lambda batches: V.met(batches, keys, hold, answer)), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
