import random

import numpy as np

from ledgerline.llm import ann

KIND = "vec_id long, embedding array<float>, rep int, score string"


def brute(rows, k, every):
    ok = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    sizes = [len(v) for _, v in ok]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in ok if len(v) == size]
    out = {}
    for q, v in ok:
        if q % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in ok if i != q)[:k]
            out[q] = [(i, d) for d, i in near]
    return out


def found(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def data(n=400, size=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(size)]) for i in range(n)]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(40)] + [(1000, None), (1010, []), (1020, [0.0] * size), (1030, [1.0] * (size - 1)),
                                                   (1040, [float("nan")] * size), (1050, [float("inf")] + [0.0] * (size - 1)),
                                                   (1060, [None] + [1.0] * (size - 1)), (None, rows[1][1])]
    rng.shuffle(rows)
    return rows


def test_whole_windows_equal_brute_force_with_ties_and_bad_vectors(spark):
    rows = data()
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], KIND).repartition(4)
    got = found(ann.nearest(df, k=10, every=10, least=2000, curves=2))
    want = brute(rows, 10, 10)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([d for _, d in got[q]], [d for _, d in want[q]], rtol=1e-15, atol=0)


def test_small_blocks_meet_all_of_a_window(spark, monkeypatch):
    rows = data(seed=2)
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], KIND).repartition(4)
    wide = found(ann.nearest(df, every=10, least=60, share=0, curves=4))
    monkeypatch.setattr(ann, "BLOCK", 7)
    assert found(ann.nearest(df, every=10, least=60, share=0, curves=4)) == wide


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    ids = np.array([i for i, _ in rows])
    v = np.array([e for _, e in rows], dtype=np.float64)
    got = found(ann.nearest(df, k=10, every=100, least=60))
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        hits += len({i for i, _ in got[int(q)]} & set(ids[np.argsort(d, kind="stable")[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(got), hits / (10 * len(got))


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1, "s"), (1, [0.0, 1.0], 1, "s")], KIND)
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.nearest(few).collect()] == [(0, 1, 1)]
    assert ann.nearest(few.where("vec_id = 0")).count() == 0
    assert ann.nearest(spark.createDataFrame([], KIND)).count() == 0


def test_hilbert_steps_are_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.indices((1 << bits,) * dims).reshape(dims, -1).T
        keys = ann.hilbert_keys(cells, bits)
        order = np.argsort(keys)
        assert (np.sort(keys) == np.arange(len(keys))).all()
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()
