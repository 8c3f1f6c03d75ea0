import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toxicity
from ledgerline.llm.queries import op6_toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    rows = op6_toxicity(spark, SF).join(
        spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left").collect()
    return rows


def test_held_out_accuracy(scored):
    held = [r for r in scored if r.held_out and r.toxic is not None]
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in held)
    # about a fifth of the toxic labels of this table stand on texts without any toxic word
    assert hit / sum(r.predicted for r in held) > 0.9 and hit / sum(r.toxic for r in held) > 0.75
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in scored)


def test_held_out_rows_are_those_of_the_rule(scored):
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)


def test_offending_sentences_are_located(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = toxicity.score(docs, toxicity.train(docs, labels))
    assert set(docs.columns) <= set(out.columns)
    sentences = [s.sentence.lower() for r in out.where("score >= 0.9 AND lang = 'en'").collect() for s in r.offending]
    told = [s for s in sentences if any(w in s for w in ("loser", "idiot", "pathetic", "scum", "worthless", "moron",
                                                         "trash", "clown", "disgusting", "stupid"))]
    assert len(sentences) > 50 and len(told) > 0.9 * len(sentences)


def test_edges(spark):
    kind = "doc_id long, text string, score double, offending string, id int, rest int"
    rows = [(i, ("you are a vile fool. " if i % 2 else "you are a kind friend. ") * 3, 0.5, "o", i, 1) for i in range(60)]
    rows += [(100, None, 0.5, "o", 100, 1), (101, "", 0.5, "o", 101, 1), (102, "!!! ...", 0.5, "o", 102, 1), (None, rows[1][1], 0.5, "o", 103, 1),
             (1, rows[1][1], 0.5, "o", 104, 1)]
    docs = spark.createDataFrame(rows, kind)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)] + [(4, 0, 0), (None, 0, 1), (200, 0, 1), (6, 0, None)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.clean(docs, labels)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    left = {r.id for r in out.collect()}
    assert left == {i for i in range(0, 60, 2)} | {100, 101, 102}
    s = {r.doc_id: r.score for r in toxicity.score(docs.where("doc_id >= 100"), toxicity.train(docs, labels)).collect()}
    assert set(s.values()) == {0.0}
    assert toxicity.clean(docs.limit(0), labels).count() == 0
    none = labels.where(F.lit(False))                                    # nothing to learn from: all stay
    assert toxicity.clean(docs, none).count() == docs.count()
    assert toxicity.clean(docs, labels.where("toxic = 0")).count() == docs.count()


def test_length_alone_is_no_toxicity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = (docs.join(labels.where("toxic = 0"), "doc_id").where(toxicity.held_out("doc_id"))
            .orderBy("doc_id").select("text").collect())
    plain = "The quiet river runs past the old mill. " * 12_000
    texts = "\n".join(r.text for r in held if r.text)[:1_000_000]
    assert texts.count(". ") + texts.count("\n") > 10_000
    insult = "You stupid worthless idiot, you are trash. "
    more = spark.createDataFrame([(-1, plain), (-2, texts), (-3, plain + insult * 3)], "doc_id long, text string")
    left = {r.doc_id for r in toxicity.clean(docs.union(more), labels).where("doc_id < 0 OR doc_id = 634").collect()}
    assert left == {-1, -2, 634}


def plain_score(text, weights, bias, background):
    """The noisy-or by hand: sentences by regular expressions, features one word at a time."""
    import math
    import re

    import numpy as np

    from ledgerline.llm import common as C
    stops = "[.!?\n\r…  。！．？।؟۔]"
    words = r"(?:[0-9A-Za-z\x80-\U0010ffff](?<![\u0080-\u009f  -ⁿ　-〿]))+"

    def column(word, n=None):
        raw = np.frombuffer(word.encode() + b" ", dtype=np.uint8)
        if n is not None and len(raw) - 1 <= n:
            return 0
        h = C.word_hashes(C.lowered(raw), np.array([0]), np.array([n or len(raw) - 1])) + np.uint64(n or 0)
        return int(1 + (C.mix(h) >> np.uint64(64 - toxicity.BITS))[0] % ((1 << toxicity.BITS) - 1))

    def evidence(span):
        span = {w.translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})) for w in span}
        z = bias + sum(float(weights[column(w, n)]) for w in span for n in (None, 4, 5))
        return max(0.0, float(np.logaddexp(0, z)) - max(toxicity.FLOOR, float(np.logaddexp(0, bias))))

    totals = []
    for shift in (0, toxicity.SPAN // 2):
        total = 0.0
        for sentence in re.split(stops, text or ""):
            found = re.findall(words, sentence)
            cuts = [0, len(found)]
            if len(found) > toxicity.SPAN:
                cuts = [0, *range(toxicity.SPAN - shift, len(found), toxicity.SPAN), len(found)]
            total += sum(evidence(found[a:b]) - background for a, b in zip(cuts[:-1], cuts[1:]) if b > a)
        totals.append(total)
    return 1 - math.exp(-max(0.0, *totals))


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_scores_equal_a_plain_scorer(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id % 40 = 0")
    extra = [(-1, "You stupid idiot。clean words … worthless trash"), (-2, "pathetic loser " * 40), (-3, None), (-4, "")]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = toxicity.score(docs, model).collect()
    assert sum(r.score > 0.5 for r in rows) > 10
    for r in rows:
        assert r.score == pytest.approx(plain_score(r.text, *model), abs=1e-6), r.doc_id


def test_unmarked_texts_of_any_length_are_clean(spark, model):
    import random
    rng = random.Random(3)
    held = (spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0"), "doc_id")
            .where(toxicity.held_out("doc_id")).orderBy("doc_id").select("doc_id", "text").collect())
    bare = {r.doc_id: "".join(" " if c in ".!?\n\r" else c for c in r.text or "") for r in held}
    scores = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(bare.items()), "doc_id long, text string"), model).collect()}
    assert sum(s >= 0.7 for s in scores.values()) <= 0.01 * len(scores)       # as many as with marks, or hardly more
    clean = " ".join(t for i, t in bare.items() if scores[i] < 0.05).split()
    rows = [(n, " ".join(clean[:n])) for n in (100, 1_000, 10_000, 100_000)]
    rows += [(-n, " ".join(f"w{rng.randrange(4000)}" for _ in range(n))) for n in (100, 1_000, 10_000, 100_000)]
    insult = "you stupid worthless idiot you are pathetic trash"
    rows.append((0, " ".join([*clean[:20_000], insult, *clean[20_000:40_000]])))
    got = {r.doc_id: (r.score, [s.sentence for s in r.offending]) for r in
           toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(s < 0.7 for i, (s, _) in got.items() if i), got
    assert got[0][0] >= 0.7 and any("stupid" in s for s in got[0][1])


def test_words_shared_by_chance_have_no_weight():
    import random

    import numpy as np
    import pyarrow as pa
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(60)) + (". awful nasty brute" if i % 2 else "") for i in range(300)]
    weights, bias, _ = toxicity.fit(pa.array(texts, type=pa.large_string()), np.arange(300) % 2)
    assert 3 <= (weights > 0).sum() <= 7 and bias < 0
