import random

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as H
from test_topk import whole

KIND = "vec_id long, embedding array<float>, label int, leaf int, pos string"


def brute(rows, every=50, scale=256):
    ok = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v is not None and None not in v
          and np.isfinite(np.array(v, float)).all()]
    size = max((len(v) for _, v, _ in ok), default=0)
    ok = [(i, whole(v, scale, size), y) for i, v, y in ok]
    out = {}
    for a in sorted({i for i, _, _ in ok if i % every == 0}):
        y, _, x = min((y, v, whole(v, scale, size)) for i, v, y in rows if i == a and v is not None and y is not None)
        pos, neg = {}, {}
        for i, v, label in ok:
            if i != a:
                s = sum(p * q for p, q in zip(x, v))
                of = pos if label == y else neg
                of[i] = max(of.get(i, s), s)
        for p, i in sorted(((-s, i) for i, s in pos.items()))[:5]:
            inside = [(-s, j) for j, s in neg.items() if 50 * -p <= 100 * s <= 95 * -p]
            out[a, i, -p] = [(j, -s) for s, j in sorted(inside)[:3]]
    return {k: v for k, v in out.items() if v}


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.anchor_id, r.positive_id, r["rank"])):
        of = got.setdefault((r.anchor_id, r.positive_id, r.positive_score), [])
        assert r["rank"] == len(of) + 1
        of.append((r.negative_id, r.negative_score))
    return got


def data(n=700, size=6, seed=1, clusters=15):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(clusters)]
    rows = [(i, [m + rng.gauss(0, 0.2) for m in rng.choice(middles)], rng.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[7][1], i % 3) for i in range(300)]                       # a third of all rows are one vector
    rows += [(5000, None, 1), (5050, [], 1), (5100, [0.0] * size, 2), (5150, [1.0] * (size - 1), 1), (5200, [float("nan")] * size, 1),
             (5250, [float("inf")] + [0.0] * (size - 1), 1), (5300, [None] + [1.0] * (size - 1), 1), (5350, rows[3][1], None),
             (None, rows[1][1], 2), (33, rows[4][1], 1), (33, rows[9][1], 2), (100, rows[3][1], 3), (-50, rows[9][1], -2)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, "s") for i, v, y in rows], KIND).repartition(4)


@pytest.mark.parametrize("sample, ways, leaf, block", [(4096, 12, 32, 4096), (60, 3, 4, 40), (1, 2, 1, 9)])
def test_equals_brute_force(spark, monkeypatch, sample, ways, leaf, block):
    for name, value in (("SAMPLE", sample), ("WAYS", ways), ("LEAF", leaf), ("BLOCK", block)):
        monkeypatch.setattr(H, name, value)
    rows = data()
    assert found(H.mined(frame(spark, rows))) == brute(rows)


def test_few_rows_large_numbers_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.5], 2), (3, [0.9, 1.8], 2), (50, [3e38, 0.0], 1), (51, [-1.0, 0.0], 1)]
    assert found(H.mined(frame(spark, rows[:4]))) == brute(rows[:4]) != {}
    assert {k[0] for k in found(H.mined(frame(spark, rows)))} <= {0, 50}
    assert H.mined(frame(spark, rows[:1])).collect() == [] == H.mined(frame(spark, rows[2:4])).collect()
    assert H.mined(frame(spark, rows).limit(0)).collect() == []


def test_annuli_eliminate_siblings_and_lose_nothing():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 2.0, (150, 3)) for m in rng.normal(0, 200, (20, 3))])
    tree = H.Tree(x[::5])
    leaf = tree.leaf_of(x)
    assert tree.leaves > 20 and set(leaf) <= set(range(tree.leaves))
    tree.learn([dict(zip(("node", "point", "child", "low", "high"), r)) for r in tree.ranges(x, leaf)], 1e-6)
    anchors = x[::40]
    gap = H.distances(anchors, x)
    for inner, outer in ((0.0, 10.0), (100.0, 130.0), (400.0, 410.0), (5.0, 4.0)):
        may = tree.reached(anchors, np.full(len(anchors), inner), np.full(len(anchors), outer))
        for i in range(len(anchors)):
            assert set(leaf[(gap[i] >= inner) & (gap[i] <= outer)]) <= set(np.flatnonzero(may[i]))
        assert may.mean() < 0.6, (inner, outer, may.mean())
