import random

import pytest

from ledgerline.llm import minhash

KIND = "doc_id long, text string, node long, sig string, kept int"


def brute(rows, shingle, num=80, den=100):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, text in rows:
        w = (text or "").encode().translate(lower).split()
        g = {tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)}
        sets[i] = g or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    bases = [[rng.choice(words) for _ in range(rng.randint(20, 160))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, len(w) // 6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(x.upper() if rng.random() < 0.2 else x for x in w)))
    rows += [(n, None), (n + 1, ""), (n + 2, "\n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, rows[0][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shingle", [(1, 2), (2, 5), (3, 1)])
def test_components_equal_brute_force(spark, seed, shingle):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, -1, "s", 0) for i, t in rows], KIND).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash.near_duplicates(docs, shingle=shingle).collect()}
    assert got == brute(rows, shingle)


def test_small_blocks_and_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", -1)
    rows = corpus(4, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, shingle=2).collect()}
    assert got == brute(rows, 2)


def test_null_and_repeated_ids(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    rows = [(5, a), (5, b), (8, b), (9, a), (None, a), (None, None), (5, a)]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    got = sorted(((r.doc_id or -1), r.component_id, r.kept) for r in out.collect())
    assert got == [(-1, None, True), (-1, None, True), (5, 5, True), (5, 5, True), (5, 5, True),
                   (8, 5, False), (9, 5, False)]


def test_stage_keeps_columns_and_one_of_each_group(spark):
    rows = [(2, "a b c d e f g h", 1, "s", 1), (1, "A b c d e f g h", 2, "t", 2), (None, "a b c d e f g h", 3, "u", 3),
            (4, None, 4, "v", 4), (6, "x y z", 5, "w", 5)]
    docs = spark.createDataFrame(rows, KIND)
    out = minhash.without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.node) for r in out.collect()) == [(0, 3), (1, 2), (4, 4), (6, 5)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], KIND)
    assert minhash.near_duplicates(docs).count() == 0 and minhash.without_near_duplicates(docs).count() == 0


def test_pairs_within_the_distance_share_a_key():
    import numpy as np
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 16, (300, minhash.VALUES)).astype(np.uint16)
    b = a.copy()
    for i in range(300):
        b[i, rng.choice(minhash.VALUES, 2 * minhash.CHUNKS - 1, replace=False)] ^= 1
    assert (minhash.masked_keys(a) == minhash.masked_keys(b)).any(axis=1).all()


def test_long_chain_of_components(spark):
    from ledgerline.llm import common
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 100), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in common.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 200: 200, 201: 200}


def test_further_links_join_components_and_lone_nodes(spark, monkeypatch):
    from ledgerline.llm import common
    pairs = [(10, 11), (11, 12), (20, 21), (30, 31), *((40, i) for i in range(50, 90))]
    more = [(12, 21), (21, 5), (7, 8), (31, 30), (60, 41)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    want = {r.node: r.component for r in common.components(frame(pairs + more)).collect()}
    for per_task in (common.LINKS_PER_TASK, 1):
        monkeypatch.setattr(common, "LINKS_PER_TASK", per_task)
        comps = common.components(frame(pairs))
        assert {r.node: r.component for r in common.merged_components(comps, frame(more)).collect()} == want
        assert common.merged_components(comps, frame([])) is comps


def test_patterned_words_have_hashes_of_their_own():
    import numpy as np

    from ledgerline.llm import common
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    words = [morse[:n] for n in (1, 7, 8, 9, 16, 255, 256, 257, 1024, 2048)]
    words += [w.translate(str.maketrans("ab", "ba")) for w in words] + [w + "\0" for w in words] + [""]
    text = " ".join(words).encode() + b" "
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    data = np.frombuffer(text, dtype=np.uint8)
    both = [common.word_hashes(data, starts, ends, which) for which in (0, 1)]
    assert len(np.unique(np.concatenate(both))) == 2 * len(words)
    alone = [common.word_hashes(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert alone == both[0].tolist()
