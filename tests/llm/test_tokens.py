"""Token counts, packing and token files against the libraries on whole texts."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing, token_counts, token_output, tokens
from ledgerline.llm.queries import tokenizer

WORDS = tokenizer("word_bpe_49k.json")
BYTES = tokenizer("byte_bpe_50k.json")
KIND = "doc_id long, text string, n_tokens string, digest int, part string"
ODD = ["", None, "  \n", "<|endoftext|>a <|ENDOFTEXT|> b<|startoftext|>", "İstanbul İ̇ ΣΑΣ ß ﬁ é ́x a b c",
       "it's WE'LL ''s 12 3½ ² 中文字 😀a\x7fb \x7f \x00 \ufeff", "ʰa ⅻ ª º", "K Å Ω", "a‍b ͅ ᾳ", "x" * 5000,
       "\x1c\x1d\x85a b", "the, of. (and) e-mail@x.org +1 (389) 555-5010"]


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    make = lambda: "".join(rng.choice("abcdeéßñ中.,' ") for _ in range(rng.randint(1, 12)))
    rows = [(i, " ".join(make() for _ in range(rng.choice([0, 1, 5, 60, 900])))) for i in range(n)]
    rows += [(n + i, t) for i, t in enumerate(ODD)] + [(3, rows[4][1]), (3, rows[4][1]), (None, "no id"), (None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "p") for i, t in rows], KIND).repartition(3)


def library(path, texts):
    tk = Tokenizer.from_file(path)
    return [e.ids for e in tk.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library(path, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tokens, "CACHE_WORDS", 300)              # the cache starts anew many times
    monkeypatch.setattr(tokens, "PIECE_BYTES", 2000)
    texts = [t for _, t in corpus(2)]
    enc = tokens.Encoder(tokens.read_file(path))
    assert enc.by_word == (path == WORDS)
    got = []
    for _, _, ids, counts in enc.encode(pa.array(texts)):
        ends = np.cumsum(counts)
        got += [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)]
    assert got == library(path, texts)


def test_counts_and_cache(spark, tmp_path, monkeypatch):
    rows = corpus()
    docs = frame(spark, rows)
    cache = str(tmp_path / "cache")
    want = sorted((i or -1, len((t or "").encode()), len(k), len(k) > 50)
                  for (i, t), k in zip(rows, library(WORDS, [t for _, t in rows]), strict=True))

    def run(path=WORDS, which=docs):
        return sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in
                      token_counts.count_tokens(which, path, cache, limit=50).collect())

    assert run() == want
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("digest").distinct().count()              # each distinct text once
    assert run() == want and spark.read.parquet(cache).count() == n     # the second time nothing is encoded
    monkeypatch.setattr(token_counts, "BROADCAST_ROWS", -1)
    run(BYTES)
    by_version = {r[0]: r[1] for r in spark.read.parquet(cache).groupBy("tokenizer").count().collect()}
    assert by_version[tokens.version(tokens.read_file(WORDS))] == n and len(by_version) == 2
    assert run(which=spark.createDataFrame([], KIND)) == []


def test_packing(spark):
    rows = corpus(3)
    docs = frame(spark, rows)
    out = packing.best_fit(docs, WORDS, size=256, end_id=0).collect()
    want = []
    for (i, _), ids in zip(rows, library(WORDS, [t for _, t in rows]), strict=True):
        ids = ids + [0]
        for p, a in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[a:a + 256], "<u4")
            want.append((i or -1, p, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 256
    total = sum(w[3] for w in want)
    assert len(by) <= -(-total // 256) + 1
    assert packing.best_fit(spark.createDataFrame([], KIND), WORDS).count() == 0


def test_local_search_empties_what_best_fit_leaves():
    """Best fit, longest first, needs four bins here, exchanges get by with three."""
    lengths = [6, 5, 4, 4, 4, 4, 3]                                     # 10 = 6+4, 10 = 5+..., 30 in all
    bins = packing.pack(lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(7)) and all(sum(lengths[i] for i in b) <= 10 for b in bins)
    rng = random.Random(1)
    for _ in range(60):
        size = 100
        lengths = []
        for _ in range(12):                                             # a perfect packing exists
            left = size
            while left:
                n = min(left, rng.randint(15, 60))
                lengths.append(n)
                left -= n
        plain = packing._Bins(size)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            b = plain.best_fit(lengths[i])
            plain.change(plain.new() if b is None else b, [], [i], lengths)
        bins = packing.pack(lengths, size)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= size for b in bins)
        assert len(bins) <= plain.filled()


def test_ranks_round_trip():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 2, 3, 4, 5, 0, 1000, 7])
    ranks = (rng.integers(0, 1 << 32, counts.sum()) >> rng.integers(0, 32, counts.sum())).astype(np.uint32)
    ranks[:4] = [255, 256, 65535, 65536]
    control, data, controls, sizes = token_output.pack_ranks(ranks, counts)
    assert (token_output.unpack_ranks(control.tobytes(), data.tobytes(), counts) == ranks).all()
    a, b = controls[:8].sum(), sizes[:8].sum()                          # a document can be read alone
    assert (token_output.unpack_ranks(control[a:].tobytes(), data[b:].tobytes(), counts[8:]) == ranks[-7:]).all()


def test_token_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_output, "PART_DOCS", 20)
    monkeypatch.setattr(token_output, "BLOCK_BYTES", 3000)
    rows = [r for r in corpus(4) if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    path = str(tmp_path / "files")
    out = token_output.round_trip(frame(spark, rows), WORDS, end_id=2, path=path).collect()
    want, at = [], 0
    for (i, _), ids in sorted(zip(rows, library(WORDS, [t for _, t in rows]), strict=True), key=lambda x: x[0][0]):
        ids = np.array(ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == want
    assert spark.read.parquet(path + "/ids").select("part").distinct().count() > 3
    ranks = [r.id for r in spark.read.parquet(path + "/ranks").orderBy("rank").collect()]
    counts = {}
    for ids in library(WORDS, [t for _, t in rows]):
        for x in ids + [2]:
            counts[x] = counts.get(x, 0) + 1
    assert ranks == sorted(counts, key=lambda x: (-counts[x], x))


def test_token_files_of_null_and_repeated_ids_and_none(spark):
    rows = [(None, "b"), (4, "x y"), (4, "x y"), (2, None)]
    out = token_output.round_trip(frame(spark, rows), WORDS, end_id=2).collect()
    assert sorted(((r.doc_id or 0), r.start, r.n_tokens) for r in out) == [(0, 0, 2), (2, 2, 1), (4, 3, 3), (4, 6, 3)]
    assert token_output.round_trip(spark.createDataFrame([], KIND), WORDS).count() == 0
