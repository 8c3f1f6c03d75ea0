"""Toxicity by multiple-instance learning.

A document is a bag of sentences; a sentence of more than SPAN words counts as several of at most SPAN, so that a
text without marks is no single suspect of unbounded length. A sentence's score is logistic in hashed features of its
words (the word, and its beginnings of four and five bytes); a document's score is the noisy-or of what they tell,
1 - exp(-sum of evidence). A sentence's evidence is what its -log(1 - p) exceeds a floor by: the rate of sentences
without any weighted word and faint suspicion are in clean texts too and would add up with length alone. What
sentences of clean texts tell all the same, on average, is taken off for each sentence (the length term).
Only documents are labelled, so the weights are fitted to the likelihood of the document labels (Adam on
whole documents), which teaches each sentence its share; toxic labels on texts without evidence are a chance per document,
which is fitted with them and no part of a score. The sentence scores then locate what offends.

A feature can have a weight only if toxic documents have it more often than chance explains: twice its log likelihood
ratio must exceed 2 log(features / CHANCE), so that fewer than CHANCE features are expected to mislead.
Else words that toxic documents happen to share would add up in long texts. A long sentence is cut in two ways, half
a span apart, and the cut that tells more counts: no phrase of up to half a span is parted by both.

The fit sees at most ``sample`` labelled rows of at most SAMPLE_BYTES together (whole texts), those of smallest hash of
their id; scores, sentences and thresholds cover everything. Features rarer than five sample documents
keep weight 0. The constants were chosen by three-fold cross-validation inside the rows that may be learned from.

Defined results: NULL, empty and wordless texts have no sentences and score 0; repeated rows get equal
scores; documents without a label are scored alike; contradicting labels of one doc_id count as the
larger; with no usable labels every score is 0. Label, language, source and id are never features. An empty
table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

BITS = 18
KINDS = 3
#: most labelled rows that a model is fitted on, and the most bytes that they have together
SAMPLE, SAMPLE_BYTES = 6_000, 48 << 20
#: most words of a sentence that count together
SPAN = 16
#: bound of the expected number of features that have a weight by chance
CHANCE = 0.5
STEPS = 120
#: pull of every weight towards 0 (L1): a feature needs the evidence of many documents to count at all
SPARSE = 1.5e-4
#: what a toxic document counts in the fit, a clean one counting 1
TOXIC_WEIGHT = 2.5
#: -log(1 - p) of a sentence that is no evidence yet: in the fit, where a sentence has to be toxic more likely than not
#: (reached over its middle half), and in scores alike
FIT_FLOOR, FLOOR = float(np.log(2)), float(np.log(2))
#: what every sentence has to tell on average to count: MARGIN times what those of clean texts tell, as far as a text
#: of them tells less than CALM
MARGIN, CALM = 10.0, 0.7

# bytes: 0 part of a word, 1 between words, 2 end of a sentence
_KIND = np.ones(256, dtype=np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1)]] = 0
_KIND[0x80:] = 0
_KIND[[ord(c) for c in ".!?\n\r"]] = 2
# characters of two and three bytes that end a sentence, and blocks of spaces and punctuation, by their first bytes
_STOPS = [c.encode() for c in "\u2026\u2028\u2029\u3002\uff01\uff0e\uff1f\u0964\u061f\u06d4"]
_BETWEEN = [c.encode()[:-1] for c in "\u00a0\u2000\u2040\u3000"]


def _kinds(data: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for every byte."""
    kind = _KIND[data]
    if (data >= 0x80).any():
        tail = np.concatenate([data, np.zeros(2, dtype=np.uint8)])
        for first in _BETWEEN:
            at = np.flatnonzero(data == first[0])
            at = at[(tail[at + 1] == first[1])] if len(first) == 2 else at[(tail[at + 1] >= 0x80) & (tail[at + 1] <= 0xBF)]
            for k in range(len(first) + 1):
                kind[at + k] = 1
        for stop in _STOPS:
            at = np.flatnonzero(data == stop[0])
            for k in range(1, len(stop)):
                at = at[tail[at + k] == stop[k]]
            for k in range(len(stop)):
                kind[at + k] = 2
    return kind


def features(data: np.ndarray, offsets: np.ndarray, shift: int = 0):
    """(features, their sentence, text of each sentence, [start, end) bytes of each sentence, whether some sentence was
    cut). Features are a (words, KINDS) array with each word once a sentence; 0 stands for none. Long sentences are cut
    every SPAN words, ``shift`` words earlier than from their beginning."""
    kind = _kinds(data)
    inside = kind == 0
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    word = inside[at[:-1]]
    starts, ends = at[:-1][word], at[1:][word]
    low = C.lowered(data)
    columns = [C.word_hashes(low, starts, ends)]
    for n in (4, 5):
        columns.append(np.where(ends - starts > n,
                                C.word_hashes(low, starts, np.minimum(starts + n, ends)) + C._U(n), C._U(0)))
    text = np.searchsorted(offsets, starts, side="right") - 1
    passed = np.cumsum(kind == 2)[starts] if len(starts) else starts
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (passed[1:] != passed[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    sizes = np.diff(np.append(head, len(starts)))
    nth = np.arange(len(starts)) - np.repeat(head, sizes)
    long = np.repeat(sizes > SPAN, sizes)
    new |= long & ((nth + shift) % SPAN == 0)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(starts)) - 1 if len(starts) else head
    sentence = np.cumsum(new) - 1
    # each word once in a sentence
    _, once = np.unique(C.mix(columns[0] + sentence.astype(np.uint64) * C._U(0x9E3779B97F4A7C15)),
                        return_index=True)
    columns = [c[once] for c in columns]
    f = np.stack([np.where(c == 0, 0, 1 + (C.mix(c) >> C._U(64 - BITS)) % C._U((1 << BITS) - 1)).astype(np.int32)
                  for c in columns], axis=1)
    return f, sentence[once], text[head], np.stack([starts[head], ends[last]], axis=1), bool(long.any())


def _sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, weights=values, minlength=n)


class Model(NamedTuple):
    """Weights of features, log odds of a sentence without any, and what a sentence of a clean text tells on average."""
    weights: np.ndarray
    bias: float
    background: float


def evidence(z: np.ndarray, floor: float) -> np.ndarray:
    """What sentences of these log odds tell about their document: -log(1 - p) above ``floor``."""
    return np.maximum(np.logaddexp(0, z) - floor, 0)


def told(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Twice the log likelihood ratio of features that ``toxic`` toxic and ``clean`` clean texts have; 0 where toxic
    texts have them no more often."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0)

    df, n = toxic + clean, all_toxic + all_clean
    rate = all_toxic / n
    ratio = 2 * (part(toxic, df * rate) + part(clean, df * (1 - rate)) + part(all_toxic - toxic, (n - df) * rate)
                 + part(all_clean - clean, (n - df) * (1 - rate)))
    return np.where(toxic > df * rate, ratio, 0)


def fit(texts: pa.Array, labels: np.ndarray) -> Model:
    """The model of the sentence scores, from document labels."""
    n, count = len(labels), 0
    fs, sentences, docs = [], [], []
    toxic, clean = (np.zeros(1 << BITS, dtype=np.int64) for _ in range(2))      # documents that have a feature
    for lo, hi, data, offsets in C.pieces(texts):
        f, s, d, _, _ = features(data, offsets)
        pair = np.unique(f.ravel() * np.int64(hi - lo) + np.repeat(d[s], KINDS))
        of = labels[lo:hi][pair % (hi - lo)] == 1
        toxic += np.bincount(pair[of] // (hi - lo), minlength=1 << BITS)
        clean += np.bincount(pair[~of] // (hi - lo), minlength=1 << BITS)
        fs.append(f)
        sentences.append((s + count).astype(np.int32))
        docs.append((d + lo).astype(np.int32))
        count += len(d)
    weights = np.zeros(1 << BITS, dtype=np.float64)
    if not count or not labels.any() or labels.all():
        return Model(weights, -30.0, 0.0)
    used = toxic + clean >= 5
    used[0] = False
    used &= told(toxic, clean, int(labels.sum()), int(n - labels.sum())) > 2 * np.log(max(1, used.sum()) / CHANCE)
    if not used.any():
        return Model(weights, -30.0, 0.0)
    number = (np.cumsum(used) - 1).astype(np.int32)
    sentence, col = [], []
    for i, f in enumerate(fs):
        some = used[f.ravel()]
        sentence.append(np.repeat(sentences[i], KINDS)[some])
        col.append(number[f.ravel()[some]])
        fs[i] = sentences[i] = None
    sentence, col, d = np.concatenate(sentence), np.concatenate(col), np.concatenate(docs)
    m = int(used.sum())
    y = labels.astype(bool)
    w, b, c = np.zeros(m), -5.0, -5.0                  # c: of the chance of a toxic label without evidence
    m1, m2, b1, b2, c1, c2 = np.zeros(m), np.zeros(m), 0.0, 0.0, 0.0, 0.0
    weight = np.where(y, TOXIC_WEIGHT, 1.0)
    for step in range(1, STEPS + 1):
        z = b + _sums(w[col], sentence, count)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        base, floor = np.logaddexp(0, b), FIT_FLOOR * min(1, max(0, 2 * step / STEPS - 0.5))
        if floor > base:
            p, p0 = np.where(np.logaddexp(0, z) > floor, p, 0), 0.0
        else:                                          # above the sentences without weighted words
            p0, floor = 1 / (1 + np.exp(-b)), base
        no = np.exp(-np.logaddexp(0, c) - _sums(evidence(z, floor), d, n))      # chance of a clean label
        slope = np.where(y, np.minimum(no / np.maximum(1 - no, 1e-9), 1e3), -1.0) * weight
        g = slope[d] * p / n
        gw, gb = np.bincount(col, weights=g[sentence], minlength=m) - SPARSE, (slope[d] * (p - p0)).sum() / n
        gc = slope.sum() / n / (1 + np.exp(-c))
        m1, m2 = 0.9 * m1 + 0.1 * gw, 0.99 * m2 + 0.01 * gw * gw
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
        c1, c2 = 0.9 * c1 + 0.1 * gc, 0.99 * c2 + 0.01 * gc * gc
        k1, k2 = 1 - 0.9 ** step, 1 - 0.99 ** step
        w += 0.2 * (m1 / k1) / (np.sqrt(m2 / k2) + 1e-8)
        w = np.maximum(w, 0)          # a word may only add to suspicion, none buys off another
        b += 0.1 * (b1 / k1) / (np.sqrt(b2 / k2) + 1e-8)
        c += 0.1 * (c1 / k1) / (np.sqrt(c2 / k2) + 1e-8)
    weights[used] = w
    told_by = evidence(b + _sums(w[col], sentence, count), max(FLOOR, np.logaddexp(0, b)))
    of = _sums(told_by, d, n)
    calm = ~y & (of < CALM)
    background = MARGIN * of[calm].sum() / max(1, np.isin(d, np.flatnonzero(calm)).sum())
    return Model(weights, float(b), float(background))


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out third."""
    marked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = (texts.join(F.broadcast(chosen), "doc_id").withColumn("nth", F.xxhash64("doc_id"))
            .orderBy("nth", "doc_id", F.xxhash64("text")).limit(sample)
            .withColumn("before", F.expr("sum(coalesce(octet_length(text), 0)) OVER (ORDER BY nth, doc_id, xxhash64(text) "
                                         "ROWS UNBOUNDED PRECEDING)"))
            .where(F.col("before") <= SAMPLE_BYTES).select("doc_id", "text", "y"))

    def run(batches):
        held = [b for b in batches if b.num_rows]                 # at most the sample
        if held:
            learned = pa.Table.from_batches(held)
            weights, bias, background = fit(learned.column("text"), learned.column("y").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([weights.astype(np.float32).tobytes()], type=pa.binary()), pa.array([bias]), pa.array([background])],
                ["weights", "bias", "background"])

    # one task fits the bounded sample; only the model comes to the driver
    model = (rows.repartition(1).sortWithinPartitions("doc_id", "text")
             .mapInArrow(C.lean(run), "weights binary, bias double, background double").collect())
    if not model:
        return Model(np.zeros(1 << BITS, dtype=np.float32), -30.0, 0.0)
    return Model(np.frombuffer(model[0]["weights"], dtype=np.float32), model[0]["bias"], model[0]["background"])


def judged(data: np.ndarray, offsets: np.ndarray, model: Model):
    """(score of each text, [(text, start, end, score)] of the sentences that have weighted words), of the cut
    that tells more."""
    weights, bias, background = model
    floor = max(FLOOR, np.logaddexp(0, bias))
    most, found = np.zeros(len(offsets) - 1), [[] for _ in range(len(offsets) - 1)]
    for shift in (0, SPAN // 2):
        f, s, d, at, cut = features(data, offsets, shift)
        z = bias + _sums(weights[f].sum(axis=1, dtype=np.float64), s, len(d))
        total = _sums(evidence(z, floor) - background, d, len(most))
        better = total > most
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        new = np.flatnonzero((z > bias) & (better[d] | (shift == 0)))
        for t in np.unique(d[new]).tolist():
            found[t] = []
        for k in new.tolist():
            found[d[k]].append((int(d[k]), int(at[k][0]), int(at[k][1]), float(p[k])))
        most = np.maximum(most, total)
        if not cut:
            break
    return -np.expm1(-most), [x for of in found for x in of]


def _scored(docs: DataFrame, model: Model, id_col: str, text_col: str, offends: float) -> DataFrame:
    """(id, text, rest, score, offending): the other columns wait in a struct, so no name can clash."""
    model = model._replace(weights=model.weights.astype(np.float32))
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    inner = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
                        .alias("rest"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema)

    def run(batches):
        for batch in batches:
            result, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for lo, hi, data, offsets in C.pieces(batch.column("text")):
                result[lo:hi], found = judged(data, offsets, model)
                for d, a, b, p in found:
                    if p >= offends:
                        spans[lo + d].append({"sentence": data[a:b].tobytes().decode(errors="ignore"), "score": p})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.clip(result, 0, 1)),
                 pa.array(spans, type=pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())])))],
                [*batch.schema.names, "score", "offending"])

    return inner.mapInArrow(C.lean(run), schema + ", score double, offending array<struct<sentence:string,score:double>>")


def _own_columns(docs: DataFrame, id_col: str, text_col: str) -> list:
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    of = {id_col: F.col("id"), text_col: F.col("text")} | {c: F.col(f"rest.c{i}") for i, c in enumerate(rest)}
    return [of[c].alias(c) for c in docs.columns]


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          offends: float = 0.5) -> DataFrame:
    """The columns of ``docs`` with ``score`` (0 to 1) and ``offending``: the sentences that score ``offends`` or
    more, as (sentence, score). Columns of ``docs`` of these two names give way."""
    slim = docs.drop("score", "offending")
    return _scored(slim, model, id_col, text_col, offends).select(
        *_own_columns(slim, id_col, text_col), "score", "offending")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The documents scoring below ``threshold``, with their own columns only."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    scored = _scored(docs, model, id_col, text_col, 2.0)
    return scored.where(F.col("score") < threshold).select(*_own_columns(docs, id_col, text_col))
