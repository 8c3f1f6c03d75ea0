"""Approximate nearest neighbours on shifted space-filling curves.

Equal vectors first collapse to their smallest id. Each of CURVES orderings projects the vectors on
DIMS random orthonormal directions, shifts them by a random offset and sorts them along a Hilbert
curve. Spark range-partitions all orderings, which gives every vector a rank in each; a query meets the
vectors within a window of ranks around its own, in blocks of bounded size that overlap as needed, and
keeps the nearest of each window by exact distance. The windows' finds are merged and reranked, and
copies are given back.

A window holds ``share`` of the table on either side, at least ``least`` vectors: vectors without
structure in many dimensions have neighbours hardly nearer than the rest, and recall there follows the share
of the table that is looked at. With the defaults recall is 0.98 on 51,000 such vectors of 64 dimensions (tests measure
it). For clustered vectors a fixed, small window does.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part,
nor do rows with a NULL id, nor those of another length than the commonest (ties: the longer); equal
distances are ordered by id; with fewer candidates all are returned; rows with one id but different
vectors are searched one by one and never find their own id; an empty table gives an empty result; other
columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C

CURVES, DIMS, BITS = 32, 8, 6
#: vectors of a block, at least
BLOCK = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of coordinates along the Hilbert curve through all cells."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        high, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(dims):
            flip = (x[i] & high) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & one != 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << one | (x[i] >> np.uint64(b)) & one
    return key


class _Curves:
    """The random projections and shifts; the same for every run."""

    def __init__(self, size: int, curves: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dims = min(DIMS, size)
        self.axes = np.concatenate([np.linalg.qr(rng.standard_normal((size, self.dims)))[0] for _ in range(curves)],
                                   axis=1)
        self.shift = rng.random(curves * self.dims)
        self.curves = curves

    def keys(self, vectors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        at = (vectors @ self.axes - lo) / np.where(hi > lo, hi - lo, 1.0)
        cells = ((at + self.shift) / 2 * (1 << BITS)).clip(0, (1 << BITS) - 1).astype(np.uint64)
        return np.stack([hilbert_keys(cells[:, c * self.dims:(c + 1) * self.dims], BITS)
                         for c in range(self.curves)], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def nearest(vectors: DataFrame, *, k: int = 10, every: int = 100, share: float = 0.02, least: int = 1000,
            curves: int = CURVES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank, vec_id, score (Euclidean) of its
    ``k`` nearest."""
    valid = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
             .where("vec_id IS NOT NULL AND v IS NOT NULL")
             .where("forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))")      # NaN is larger still
             .where("exists(v, x -> x <> 0)").withColumn("v", F.expr("transform(v, x -> x + 0D)")))  # -0 is 0
    size = valid.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if size is None:
        return valid.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                            F.lit(0.0).alias("score")).limit(0)
    valid = valid.where(F.size("v") == size["n"]).distinct()
    # of equal vectors, the k + 1 smallest ids can matter
    same = Window.partitionBy("v").orderBy("vec_id")
    copies = C.written(valid.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
                       .withColumn("rep", F.min("vec_id").over(Window.partitionBy("v")))
                       .withColumn("vkey", F.xxhash64("v")), "vectors")
    reps = copies.where("nth = 1").select("rep", "vkey", "v")
    asks = C.written(valid.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
                     .join(reps, "v").select("query_id", "rep", "vkey"), "queries")
    n = reps.count()
    window = max(least, int(share * n))
    found = C.written(_searched(reps, asks.select("rep", "vkey").distinct(), size["n"], n, window, k, curves), "found")
    nearest_reps = Window.partitionBy("q", "qkey").orderBy("score", "rep", "vkey")
    found = (found.groupBy("q", "qkey", "rep", "vkey").agg(F.min("score").alias("score"))
             .withColumn("nth", F.row_number().over(nearest_reps)).where(F.col("nth") <= k + 1).drop("nth"))
    asked = asks.select("query_id", F.col("rep").alias("q"), F.col("vkey").alias("qkey"))
    rows = (asked.join(found, ["q", "qkey"]).join(copies.select("rep", "vkey", "vec_id"), ["rep", "vkey"])
            .where("vec_id <> query_id"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _searched(reps: DataFrame, queries: DataFrame, size: int, n: int, window: int, k: int, curves: int) -> DataFrame:
    """(q, qkey, rep, vkey, score): the nearest of each window."""
    spark = reps.sparkSession
    curve = _Curves(size, curves)

    def extent(batches):
        lo, hi = np.full(curve.axes.shape[1], np.inf), np.full(curve.axes.shape[1], -np.inf)
        for batch in batches:
            if batch.num_rows:
                at = _matrix(batch.column(0)) @ curve.axes
                lo, hi = np.minimum(lo, at.min(axis=0)), np.maximum(hi, at.max(axis=0))
        if np.isfinite(lo).all():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lo))), pa.array(lo), pa.array(hi)],
                                             ["axis", "lo", "hi"])

    ends = (reps.select("v").mapInArrow(C.lean(extent), "axis long, lo double, hi double").groupBy("axis")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("axis").collect())
    lo, hi = np.array([r["lo"] for r in ends]), np.array([r["hi"] for r in ends])

    def keyed(batches):
        for batch in batches:
            keys = curve.keys(_matrix(batch.column(2)), lo, hi) if batch.num_rows else np.zeros((0, curves))
            each = np.tile(np.arange(curves, dtype=np.int32), batch.num_rows)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), curves))
            yield pa.RecordBatch.from_arrays(
                [pa.array(each), pa.array(keys.ravel().astype(np.int64)), batch.column(0).take(rows),
                 batch.column(1).take(rows)], ["curve", "key", "rep", "vkey"])

    order = ["curve", "key", "rep", "vkey"]
    ranked = C.written(reps.mapInArrow(C.lean(keyed), "curve int, key long, rep long, vkey long")
                       .repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("place", F.monotonically_increasing_id()), "orderings")
    part = F.shiftright("place", 33)
    sizes = ranked.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    base = sizes.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS base")     # a row per partition
    ranked = (ranked.withColumn("part", part).join(F.broadcast(base), "part")
              .select("curve", "rep", "vkey", (F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("at")))
    block = max(BLOCK, window)
    blocks = F.expr(f"""concat(array(struct(at div {block} AS block, 0 AS asks)),
        if(asked, transform(sequence(greatest(0, at - {window}) div {block}, (at + {window}) div {block}),
                            b -> struct(b AS block, 1 AS asks)), array()))""")
    meets = (ranked.join(reps, ["rep", "vkey"])
             .join(queries.withColumn("asked", F.lit(True)), ["rep", "vkey"], "left")
             .withColumn("asked", F.coalesce("asked", F.lit(False)))
             .select("curve", "rep", "vkey", "at", "v", F.inline(blocks)))

    def load(batch):
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("block", "asks", "at", "curve", "rep", "vkey")}
        return cols | {"v": _matrix(batch.column("v"))}

    def search(batches):
        for g in C.groups(batches, ["block"], load):
            there = np.flatnonzero(g["asks"] == 0)
            there = there[np.argsort(g["at"][there])]
            at, which, v = g["at"][there], g["curve"][there], g["v"][there]
            out = []
            for i in np.flatnonzero(g["asks"] == 1):
                a, b = np.searchsorted(at, [g["at"][i] - window, g["at"][i] + window + 1])
                a += np.searchsorted(which[a:b], g["curve"][i])
                b = a + np.searchsorted(which[a:b], g["curve"][i], side="right")
                if a >= b:
                    continue
                gap = v[a:b] - g["v"][i]
                score = np.sqrt((gap * gap).sum(axis=1))
                near = np.arange(b - a)
                if len(near) > 2 * k + 2:
                    edge = np.partition(score, k)[k]
                    near = np.flatnonzero(score <= edge)
                near = near[np.lexsort((g["rep"][there[a + near]], score[near]))][:k + 1]
                out.append((np.full(len(near), i), there[a + near], score[near]))
            if out:
                i, j, score = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g["rep"][i]), pa.array(g["vkey"][i]), pa.array(g["rep"][j]), pa.array(g["vkey"][j]),
                     pa.array(score)], ["q", "qkey", "rep", "vkey", "score"])

    return (meets.repartition("block").sortWithinPartitions("block", "asks", "at")
            .mapInArrow(C.lean(search), "q long, qkey long, rep long, vkey long, score double"))
