import random

import numpy as np
import pytest

from ledgerline.llm import topk, vectors

KIND = "vec_id long, embedding array<float>, cell int, score string, v int"


def whole(v, scale, size):
    return [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v] + [0] * (size - len(v))


def brute(rows, k, every, scale=1024):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    size = max(len(v) for _, v in ok)
    ok = [(i, whole(v, scale, size)) for i, v in ok]
    out = {}
    for q, a in ok:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, b in ok:
                if i != q:
                    s = sum(x * y for x, y in zip(a, b))
                    best[i] = max(best.get(i, s), s)
    return {q: sorted(((-s, i) for i, s in b.items()))[:k] for q, b in out.items()}


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((-r.score, r.vec_id))
    return got


def data(n=600, size=5, seed=1, clusters=12):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(clusters)]
    rows = [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)]) for i in range(n)]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(300)]                       # a third of all rows are one vector
    rows += [(-10, rows[5][1]), (1000, None), (1010, []), (1020, [0.0] * size), (1030, [1.0] * (size - 1)),
             (1040, [float("nan")] * size), (1050, [float("inf")] + [0.0] * (size - 1)),
             (1060, [None] + [1.0] * (size - 1)), (None, rows[1][1]), (20, rows[3][1]), (20, rows[20][1]), (33, rows[4][1]),
             (33, rows[9][1])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], KIND).repartition(4)


@pytest.mark.parametrize("pivots, group, block", [(1024, 4096, 8192), (20, 8, 50), (1, 3, 7)])
def test_equals_brute_force(spark, monkeypatch, pivots, group, block):
    for name, value in (("PIVOTS", pivots), ("GROUP", group), ("BLOCK", block)):
        monkeypatch.setattr(topk, name, value)
    rows = data()
    got, want = found(topk.top_k(frame(spark, rows), k=10, every=10)), brute(rows, 10, 10)
    assert got == want


def test_clusters_keep_most_data_at_home():
    rng = np.random.default_rng(4)
    middles = np.eye(16) * 1000
    x = np.floor(np.concatenate([m + rng.normal(0, 5, (200, 16)) for m in middles]))
    pivots = x[::40]
    cell = np.argmin(((x[:, None] - pivots[None]) ** 2).sum(axis=2), axis=1)
    away, norm, asks = np.linalg.norm(x - pivots[cell], axis=1), np.linalg.norm(x, axis=1), np.arange(len(x)) % 20 == 0
    bound = topk._kth_best(vectors.products(x, pivots), (x[:, None] == pivots[None]).all(axis=2), 3)
    rows = [{"cell": c, "radius": away[cell == c].max(), "norm": norm[cell == c].max(), "asked": int((asks & (cell == c)).sum()),
             "reach": away[asks & (cell == c)].max(initial=0), "bound": bound[asks & (cell == c)].min(initial=np.inf)}
            for c in np.unique(cell)]
    cells = topk.Cells(pivots, rows)
    cells.parts, cells.group_of = list(range(len(pivots))), np.arange(len(pivots))          # a group per cell
    assert cells.needed(x, cell)[:, cells.asked].mean() < 2 / 16


def test_few_rows_large_numbers_and_empty_tables(spark):
    rows = [(0, [3e38, 1.0]), (100, [-3e38, 2.0]), (5, [1e8, 1e8]), (6, [1e8 + 8, -1e8])]
    got = found(topk.top_k(frame(spark, rows), k=10, every=100))
    top, low = (1 << 63) - 1, -(1 << 63) + 1
    assert got[0] == [(-top, 5), (-top, 6), (-low, 100)] and [i for _, i in got[100]] == [0, 5, 6]
    rows = [(0, [2e5, 1.0, 1e5]), (1, [3e5, 7.0, 2e5]), (2, [3e5, 6.0, 2e5])]                 # beyond 2**53, exact all the same
    assert found(topk.top_k(frame(spark, rows), every=100)) == brute(rows, 10, 100)
    assert topk.top_k(frame(spark, rows).where("vec_id = 0")).collect() == []
    assert topk.top_k(frame(spark, rows).limit(0)).collect() == []
