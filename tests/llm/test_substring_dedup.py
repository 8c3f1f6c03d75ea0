import hashlib
import random
import re

import numpy as np
import pytest

from ledgerline.llm import substring_dedup as sd

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, key string, spans int, rest string"


def brute(rows, window):
    """doc_id -> kept flags, judged window by window."""
    seen, kept = set(), {}
    for i, text in sorted(rows):
        w = WORD.findall((text or "").encode())
        keep = [True] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                keep[s:s + window] = [False] * window
            seen.add(k)
        kept[i] = (w, keep)
    return kept


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "the", "of", "é", "Ω|", "x,"] + [f"w{i}" for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(4, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.4:
                words += rng.choice(passages)
            elif kind < 0.55:
                words += [rng.choice(vocabulary)] * rng.randint(1, 60)
            elif kind < 0.65:
                words += [rng.choice(vocabulary), rng.choice(vocabulary)] * rng.randint(1, 30)
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(1, 50))]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words)))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, rows[3][1]), (n + 4, "a " * 3000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window", [(1, 5), (2, 8), (3, 20), (4, 1), (5, 50)])
def test_digests_equal_brute_force(spark, seed, window):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "k", 1, "r") for i, t in rows], KIND).repartition(5)
    got = {r.doc_id: r for r in sd.word_digests(docs, window).collect()}
    want = brute(rows, window)
    assert len(got) == len(rows)
    for i, (w, keep) in want.items():
        r = got[i]
        left = b" ".join(x for x, k in zip(w, keep, strict=True) if k)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (
            len(w), keep.count(False), hashlib.sha256(left).hexdigest()), i


def test_shuffled_plans_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(sd, "BROADCAST_PLACES", -1)
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_removed for r in sd.word_digests(docs, 6).collect()}
    assert got == {i: keep.count(False) for i, (_, keep) in brute(rows, 6).items()}


def test_text_is_cut_and_the_rest_stays(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"one\n\n{passage}\ntail  end", "a", 1, "r"), (2, f" lead\t{passage}\nmore ", "b", 2, None),
            (3, "alone  and   spaced ", None, None, None), (4, None, "x", 1, "r"), (None, passage, "n", 0, "r")]
    docs = spark.createDataFrame(rows, KIND)
    out = sd.without_repeats(docs, window=20)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == " lead\tmore " and (got[2].key, got[2].spans, got[2].rest) == ("b", 2, None)
    for i, t in ((1, rows[0][1]), (3, rows[2][1]), (4, None), (None, passage)):
        assert got[i].text == t


def test_equal_rows_are_one_document_and_other_texts_of_its_id_another(spark):
    a, b = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    rows = [(7, a), (7, a), (7, b), (9, b), (9, "short")]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in sd.word_digests(
        spark.createDataFrame(rows, "doc_id long, text string"), 20).collect())
    assert got == [(7, 25, 0), (7, 25, 0), (7, 25, 0), (9, 1, 0), (9, 25, 25)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], KIND)
    assert sd.word_digests(docs, 20).count() == 0 and sd.without_repeats(docs, 20).count() == 0


def test_equal_windows_have_equal_keys():
    """The premise of the method, on random sequences full of runs."""
    rng = np.random.default_rng(3)
    from ledgerline.llm import common as C
    words = C.mix(rng.integers(1, 4, 6000).astype(np.uint64))
    first = np.array([0, 1500, 1500, 4000, 6000])
    start, count, key = sd.segments(words, first, 12)
    seen = {}
    for s, n, k in zip(start, count, key, strict=True):
        for x in range(s, s + n):
            assert seen.setdefault(words[x:x + 12].tobytes(), k) == k
    assert count.sum() == sum(max(0, b - a - 11) for a, b in zip(first[:-1], first[1:], strict=True))
