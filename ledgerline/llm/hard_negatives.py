"""Hard negatives from a GNAT-style hyperplane tree.

Vectors are whole numbers, floor(scale * x), scored by inner product. With one more component, sqrt(M^2 - |x|^2) for rows and
0 for anchors, M above every norm, |anchor - row|^2 = |anchor|^2 + M^2 - 2 * score: a window of scores is an annulus
of distances around the anchor.

1. The tree is fitted on SAMPLE rows of smallest id hash: a node's split points are chosen far apart from its sample rows,
   and each row belongs to the nearest one, down to leaves of few sample rows. Every row of the table is indexed to its leaf.
2. Every split point of a node stores the range of its distances to each sibling's subtree, over all rows.
3. Positives: the sample gives a lower bound of an anchor's last positive score, so its positives lie in a ball. Negatives:
   each positive score opens a window of scores, whose lower end rises to the best sample negatives in it; so they
   lie in an annulus. A sibling is eliminated when, for some split point at distance D, its stored range meets no
   distance that a point of the annulus [a, b] can have: max(a - D, D - b) to D + b. So go whole subtrees, level by level.
4. Leaves are exact: a leaf's rows are dealt over blocks of about BLOCK rows, each meets the anchors that may
   need it, and the blocks' best are merged. Large leaves (copies in any number) are spread like others.

Bounds allow for rounding; scores are exact integers, so the result is that of brute force.

Defined results: rows without an id or label, or whose vector is NULL or holds NULL or non-finite components, take no part;
a shorter vector counts as one with zeros at its end; rows that share an id never find each other, the best score of
several counts, once, and the smallest (label, vector) of several is the anchor; anchors without positives, or positives
without a negative in their window, have no rows; scores beyond long are its ends; other columns aren't read;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import vectors as V

#: rows that the tree and the first bounds are made from
SAMPLE = 4096
#: split points of a node, and sample rows that need no further split
WAYS, LEAF = 12, 32
#: rows of a block, about
BLOCK = 4096
#: room for rounding, as a share of the squared distances' scale
SLACK = 1e-9


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Rows with the component that makes all norms equal."""
    return np.column_stack([x, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))])


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", points, points) - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


class Tree:
    """Multiway hyperplane tree. Node n has split points ``points[n]``; child i of a node is ``below[n][i]``, a node if
    >= 0, else leaf ``-1 - below``. ``low[n]``, ``high[n]``: [split point, sibling] ranges."""

    def __init__(self, sample: np.ndarray):
        self.points, self.below, self.leaves = [], [], 0
        self.low, self.high = [], []
        if len(sample):
            stack = [(None, 0, sample)]
            while stack:
                up, nth, rows = stack.pop()
                points = self._split(rows) if len(rows) > LEAF or up is None else None
                if points is None or (up is not None and len(points) < 2):
                    self.below[up][nth] = -1 - self.leaves
                    self.leaves += 1
                    continue
                node = len(self.points)
                self.points.append(points)
                self.below.append([0] * len(points))
                if up is not None:
                    self.below[up][nth] = node
                own = distances(rows, points).argmin(axis=1)
                stack += [(node, i, rows[own == i]) for i in range(len(points))]
        self._clear()

    def _clear(self):
        self.low = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.high = [np.full((len(p), len(p)), -np.inf) for p in self.points]

    @staticmethod
    def _split(rows: np.ndarray) -> np.ndarray:
        """Up to WAYS of the rows, each the farthest from those before it; different ones."""
        chosen = [0]
        gap = distances(rows, rows[:1])[:, 0]
        scale = 1e-6 * max(1.0, float(np.abs(rows).max()))
        while len(chosen) < WAYS and gap.max() > scale:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(rows, rows[chosen[-1:]])[:, 0])
        return rows[chosen]

    def walk(self, x: np.ndarray):
        """(node, rows, own child, distances to the node's split points) of every node that rows of ``x`` pass."""
        stack = [(0, np.arange(len(x)))] if self.points else []
        while stack:
            node, rows = stack.pop()
            if len(rows):
                gaps = distances(x[rows], self.points[node])
                own = gaps.argmin(axis=1)
                yield node, rows, own, gaps
                stack += [(b, rows[own == i]) for i, b in enumerate(self.below[node]) if b >= 0]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int32)
        for node, rows, own, _ in self.walk(x):
            below = np.array(self.below[node])[own]
            out[rows[below < 0]] = -1 - below[below < 0]
        return out

    def ways(self) -> dict[int, list[tuple[int, int]]]:
        """For each leaf the (node, child) steps that lead to it."""
        up = {b: (n, i) for n, row in enumerate(self.below) for i, b in enumerate(row)}
        out = {}
        for leaf in range(self.leaves):
            steps, at = [], -1 - leaf
            while at in up:
                steps.append(up[at])
                at = up[at][0] or None
            out[leaf] = steps
        return out

    def ranges(self, x: np.ndarray, leaf: np.ndarray):
        """(node, split point, sibling, least, most) of the distances of rows indexed to ``leaf``."""
        rows_of: dict[tuple[int, int], list[np.ndarray]] = {}
        ways = self.ways()
        for one in np.unique(leaf):
            rows = np.flatnonzero(leaf == one)
            for step in ways[int(one)]:
                rows_of.setdefault(step, []).append(rows)
        for (node, child), rows in rows_of.items():
            gaps = distances(x[np.concatenate(rows)], self.points[node])
            for i, (a, b) in enumerate(zip(gaps.min(axis=0).tolist(), gaps.max(axis=0).tolist(), strict=True)):
                yield node, i, child, a, b

    def learn(self, rows: list, slack: float):
        self._clear()
        for r in rows:
            self.low[r["node"]][r["point"], r["child"]] = r["low"] - slack
            self.high[r["node"]][r["point"], r["child"]] = r["high"] + slack

    def reached(self, x: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """(anchors, leaves): which leaves may hold rows of an anchor's annulus from ``inner`` to ``outer``."""
        out = np.zeros((len(x), self.leaves), dtype=bool)
        stack = [(0, np.flatnonzero(inner <= outer))] if self.points else []
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            gap = distances(x[rows], self.points[node])
            least = np.maximum(inner[rows, None] - gap, gap - outer[rows, None])
            most = gap + outer[rows, None]
            for child, below in enumerate(self.below[node]):
                stays = ((self.high[node][:, child] >= least) & (self.low[node][:, child] <= most)).all(axis=1)
                if below >= 0:
                    stack.append((below, rows[stays]))
                else:
                    out[rows[stays], -1 - below] = True
        return out


def first_ids(scores: np.ndarray, ids: np.ndarray, n: int) -> list[int]:
    """Places of the ``n`` highest scores of different ids, ties to the smaller id."""
    if len(scores) > 4 * n:                                    # enough of them, unless ids repeat
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        if len(np.unique(ids[some])) >= n:
            return [int(some[i]) for i in first_ids_of(scores[some], ids[some], n)]
    return first_ids_of(scores, ids, n)


def first_ids_of(scores: np.ndarray, ids: np.ndarray, n: int) -> list[int]:
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:n]].tolist()


def windows(positive: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest negative score for each positive score: ``least`` and ``most`` percent of it."""
    low = [-(-least * p // 100) for p in positive.tolist()]
    high = [most * p // 100 for p in positive.tolist()]
    return np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)


class _Search:
    """What tasks need: the tree, the sample and the scales."""

    def __init__(self, size: int, scale: float, top: float):
        self.size, self.scale, self.top = size, scale, top
        self.slack = 1 + SLACK * top                          # of squared distances

    def whole(self, column) -> np.ndarray:
        return V.whole(column, self.size, self.scale)

    def annulus(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances between which scores from ``low`` to ``high`` lie."""
        base = np.einsum("ij,ij->i", x, x) + self.top
        return (np.sqrt(np.maximum(base - 2 * high - self.slack, 0)) - SLACK,
                np.sqrt(np.maximum(base - 2 * low + self.slack, 0)) + SLACK)


def mined(vectors: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
          scale: float = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its ``positives`` best rows of the same label: the first
    ``negatives`` rows of another label that score ``least`` to ``most`` percent of the positive: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score."""
    valid = V.usable(vectors, id_col, vector_col, F.col(f"`{label_col}`").cast("long").alias("label")).where("label IS NOT NULL")
    edge = f"(abs(x) * {float(scale)!r}D + 1D)"
    known = valid.agg(F.max(F.size("v")).alias("size"), F.max(F.expr(
        f"aggregate(v, 0D, (s, x) -> s + {edge} * {edge})")).alias("top")).first()
    if known["size"] is None:
        return valid.selectExpr("vec_id AS anchor_id", "vec_id AS positive_id", "1 AS rank", "vec_id AS negative_id",
                                "0L AS positive_score", "0L AS negative_score")
    s = _Search(known["size"], scale, known["top"])
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()        # a bounded fit
    names, labels = (np.array([r[c] for r in sample], dtype=np.int64) for c in ("vec_id", "label"))
    points = s.whole(pa.array([r["v"] for r in sample], type=pa.list_(pa.float64())))
    exact = math.isfinite(s.top)                                # else distances overflow: one leaf, no bounds
    tree = Tree(lifted(points, s.top) if exact else points[:0])
    tree.leaves = max(tree.leaves, 1)
    kind = valid.schema["v"].dataType.simpleString()

    def index(batches):
        nth = 0
        for batch in batches:
            leaf = tree.leaf_of(lifted(s.whole(batch.column("v")), s.top)) if exact else np.zeros(batch.num_rows, np.int32)
            place = np.arange(nth, nth + batch.num_rows)
            nth += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(place)],
                                             [*batch.schema.names, "leaf", "place"])

    indexed = C.written(valid.select("vec_id", "v", "label").mapInArrow(
        C.lean(index), f"vec_id long, v {kind}, label long, leaf int, place long"), "gnat")

    def ranges(batches):
        for batch in batches:
            if batch.num_rows:
                x = lifted(s.whole(batch.column("v")), s.top)
                found = list(zip(*tree.ranges(x, batch.column("leaf").to_numpy(zero_copy_only=False)), strict=True))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
                        found, [pa.int32()] * 3 + [pa.float64()] * 2, strict=True)], ["node", "point", "child", "low", "high"])

    if exact:                                                   # WAYS * WAYS rows a node of the bounded tree
        learned = (indexed.select("v", "leaf").mapInArrow(C.lean(ranges), "node int, point int, child int, low double, high double")
                   .groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
        tree.learn(learned, math.sqrt(s.slack) * 1e-3)
    counts = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    blocks = np.array([max(1, math.ceil(counts.get(i, 0) / BLOCK)) for i in range(tree.leaves)])

    def ball(batches):
        """Anchors and the leaves that may hold their positives."""
        for batch in batches:
            x, ids, label = whole_asks(batch)
            scores = V.products(x, points).astype(np.float64)
            scores[(names == ids[:, None]) | (labels != label[:, None])] = -np.inf
            low = (np.partition(scores, -positives, axis=1)[:, -positives] if len(names) >= positives
                   else np.full(len(x), -np.inf))
            low = np.where(low <= -2.0 ** 62, -np.inf, low - SLACK * np.abs(low))
            with np.errstate(invalid="ignore", over="ignore"):
                inner, outer = s.annulus(x, low, np.full(len(x), np.inf))
            yield from asked(batch, reached(x, [(inner, outer)]))

    def annuli(batches):
        """Anchors and the leaves that may hold negatives of any of their windows."""
        for batch in batches:
            x, ids, label = whole_asks(batch)
            sampled = V.products(x, points)
            pos = batch.column("pos").to_pylist()
            low, high = np.full((len(x), positives), np.inf), np.full((len(x), positives), -np.inf)
            for i, p in enumerate(pos):
                lo, hi = windows(np.array(p, dtype=np.int64), least, most)
                other = np.flatnonzero((labels != label[i]) & (names != ids[i]))
                for j in range(len(p)):
                    if lo[j] <= hi[j]:
                        inside = sampled[i][other]
                        inside = inside[(inside >= lo[j]) & (inside <= hi[j])]
                        if len(inside) >= negatives:
                            lo[j] = max(lo[j], np.partition(inside, len(inside) - negatives)[len(inside) - negatives])
                        low[i, j], high[i, j] = lo[j], hi[j]
            yield from asked(batch, reached(x, [s.annulus(x, low[:, j], high[:, j]) for j in range(positives)]))

    def reached(x, all_annuli):
        if not exact:
            return np.ones((len(x), 1), dtype=bool)
        anchors = np.column_stack([x, np.zeros(len(x))])
        return np.logical_or.reduce([tree.reached(anchors, inner, outer) for inner, outer in all_annuli])

    def whole_asks(batch):
        return (s.whole(batch.column("v")), *(batch.column(c).to_numpy(zero_copy_only=False)
                                               for c in ("anchor_id", "anchor_label")))

    def asked(batch, may):
        i, leaf = np.nonzero(may)
        times = blocks[leaf]
        i, leaf = np.repeat(i, times), np.repeat(leaf, times)
        block = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        for lo in range(0, len(i), 4096):
            part = slice(lo, lo + 4096)
            rows = pa.array(i[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[part].astype(np.int32)), pa.array(block[part].astype(np.int32)),
                 *[batch.column(c).take(rows) for c in ("anchor_id", "anchor_label", "pos", "v")]],
                ["leaf", "block", "vec_id", "label", "pos", "v"])

    def hold(table):
        return (table.column("vec_id").to_numpy(), table.column("label").to_numpy(), s.whole(table.column("v")))

    def best(held, rows):
        """Positives of a block."""
        ids, of, x = held
        asked_ids, label = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        scores = V.products(s.whole(rows.column("v")), x)
        for i in range(len(asked_ids)):
            mine = np.flatnonzero((of == label[i]) & (ids != asked_ids[i]))
            for j in first_ids(scores[i][mine], ids[mine], positives):
                yield asked_ids[i], None, ids[mine[j]], scores[i][mine[j]]

    def hardest(held, rows):
        """Negatives of a block for each positive score."""
        ids, of, x = held
        asked_ids, label = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        scores = V.products(s.whole(rows.column("v")), x)
        for i, pos in enumerate(rows.column("pos").to_pylist()):
            lows, highs = windows(np.array(pos, dtype=np.int64), least, most)
            other = np.flatnonzero((of != label[i]) & (ids != asked_ids[i]) & (scores[i] >= lows.min()) & (scores[i] <= highs.max()))
            inside = scores[i][other]
            for p, lo, hi in zip(pos, lows, highs, strict=True):
                window = other[(inside >= lo) & (inside <= hi)]
                for j in first_ids(scores[i][window], ids[window], negatives):
                    yield asked_ids[i], p, ids[window[j]], scores[i][window[j]]

    def looked_up(asks, leaves_of, answer):
        """(anchor_id, pos, vec_id, score): the answers of all blocks that the anchors may need."""
        def rows(held, part):
            found = list(answer(held, part))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*found, strict=True)],
                                                 ["anchor_id", "pos", "vec_id", "score"])

        sent = asks.mapInArrow(C.lean(leaves_of), f"leaf int, block int, vec_id long, label long, pos array<long>, v {kind}")
        counted = F.array(*[F.lit(int(b)) for b in blocks])
        data = indexed.select("leaf", F.pmod("place", F.element_at(counted, F.col("leaf") + 1)).cast("int").alias("block"),
                              "vec_id", "label", F.lit(None).cast("array<bigint>").alias("pos"), "v")
        keys = ["leaf", "block"]
        return (data.withColumn("asks", F.lit(0)).unionByName(sent.withColumn("asks", F.lit(1)))
                .repartition(*keys).sortWithinPartitions(*keys, "asks")
                .mapInArrow(C.lean(lambda batches: V.met(batches, keys, hold, rows)),
                            "anchor_id long, pos long, vec_id long, score long"))

    anchors = C.written(indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id")
                        .agg(F.min(F.struct("label", "v")).alias("a"))
                        .select(F.col("vec_id").alias("anchor_id"), F.col("a.label").alias("anchor_label"),
                                F.lit(None).cast("array<bigint>").alias("pos"), "a.v"), "anchors")
    nearest = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    found = (looked_up(anchors, ball, best).repartition("anchor_id")
             .groupBy("anchor_id", "vec_id").agg(F.max("score").alias("score"))
             .withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= positives)
             .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("pos")))
    found = C.written(found, "positives")
    asks = anchors.drop("pos").join(found.groupBy("anchor_id").agg(F.array_sort(F.collect_set("pos")).alias("pos")), "anchor_id")
    hard = (looked_up(asks.select("anchor_id", "anchor_label", "pos", "v"), annuli, hardest).repartition("anchor_id")
            .groupBy("anchor_id", "pos", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("anchor_id", "pos").orderBy(F.desc("score"), "vec_id")))
            .where(F.col("rank") <= negatives))
    return (found.join(hard, ["anchor_id", "pos"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    F.col("pos").alias("positive_score"), F.col("score").alias("negative_score")))
