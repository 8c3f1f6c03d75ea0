import hashlib
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import prefix_trie as T

KIND = "conv_id long, turn long, role string, text string, id int, size string, h int, digest string"


def brute(seqs):
    """{(depth, smallest member): the rest} for {conv_id: [(role, text), ...]}."""
    kids, ends, nodes = {}, {}, {}
    for c in sorted(seqs):
        s = tuple(seqs[c])
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
            if d:
                kids.setdefault(s[:d - 1], set()).add(s[:d])
        ends.setdefault(s, []).append(c)
    out = {}
    for k in nodes:
        inside, stack = [], [k]
        while stack:
            x = stack.pop()
            inside.append(x)
            stack += kids.get(x, ())
        out[len(k), nodes[k][0]] = (
            nodes[k[:-1]][0] if k else None, len(nodes[k]), len(kids.get(k, ())), sum(x not in kids for x in inside),
            sum((len(nodes[x]) - 1) * len(x[-1][1].encode()) for x in inside if x),
            hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {(r.depth, r.conv_id): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in rows}
    assert len(out) == len(rows)
    return out


def made(n=400, seed=3, longest=9):
    rng = random.Random(seed)
    words = ["", "a", "bé", "ccc" * 20, "naïve", "hello"]
    seqs = {}
    for c in range(-3, n):
        s = [(rng.choice(["user", "", "assistant"]), rng.choice(words)) for _ in range(rng.randrange(longest))]
        seqs[c] = [("system", "same")] * (rng.random() < 0.7) + s
    for c in range(n, n + 200):
        seqs[c] = [("user", "hot"), ("assistant", "hot")]           # a third of all are equal
    return {c: s for c, s in seqs.items() if s}


def frame(spark, seqs, seed=1):
    rows = [(c, i if i else None, r or None, t or None, 1, "x", 2, "d") for c, s in seqs.items() for i, (r, t) in enumerate(s)]
    rows += [(None, 0, "user", "lost", 1, "x", 2, "d")]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, KIND).repartition(5)


@pytest.mark.parametrize("chunk", [1, 7, 60, T.CHUNK])
def test_trie_equals_brute_force_at_every_chunk_size(spark, chunk):
    seqs = made()
    assert got(T.nodes(T.sequences(frame(spark, seqs)), chunk=chunk)) == brute(seqs)


def test_spliced_equals_brute_force(spark):
    seqs = made(seed=8, longest=14)
    del seqs[10], seqs[15]
    want = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = seqs.get(c - int(np.fmod(c, 5)), [])[:h] + own[h:]
    assert any(not s for s in want.values())                          # turnless ones are members of the root
    assert got(T.nodes(T.spliced(T.sequences(frame(spark, seqs))), chunk=40)) == brute(want)


def test_one_long_conversation(spark):
    seqs = {c: [("u", str(i % 7)) for i in range(3000 + c)] for c in range(3)} | {9: [("u", "0")], 10: [("u", "1"), ("v", "1")]}
    out = got(T.nodes(T.sequences(frame(spark, seqs)), chunk=1000))
    want = {}                                                         # brute is quadratic in depth; these are chains
    assert len(out) == 1 + 3002 + 2
    root = out[0, 0]
    assert root[:4] == (None, 5, 2, 2) and out[3002, 2][1:4] == (1, 0, 1) and out[3000, 0][1:4] == (3, 1, 1)
    want["saved"] = 3 + 2 * 2999 + 1                                  # turn 1 in four, the others in three; 3001 in two
    assert root[4] == want["saved"]


def test_ties_repeats_and_empty_tables(spark):
    rows = [(1, 0, "u", "b"), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a"), (2, 0, "u", "b"), (2, 0, "u", "a"),
            (3, None, None, None), (4, 5, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = got(T.prefix_trie(df))
    assert out[3, 1][1] == 2 and out[1, 3][1] == 2 and out[0, 1][1:4] == (4, 2, 2)     # order of rows is no difference
    assert T.prefix_trie(df.limit(0)).collect() == []


def test_trees_are_balanced():
    tree = T.TernaryTree()
    for i in T.median_order(1023):
        tree.insert([i], [1])
    deep, stack = 0, [(tree.below[0], 1)]
    while stack:
        node, d = stack.pop()
        if node >= 0:
            deep = max(deep, d)
            stack += [(tree.lower[node], d + 1), (tree.higher[node], d + 1)]
    assert deep == 10 and sorted(T.median_order(1023)) == list(range(1023))
