"""Substring dedup by recompression: equal passages get equal interior symbols.

Each word is a symbol (its hash). ROUNDS rounds compress the sequence: first runs of a repeated word,
then pairs: a hash bit of each symbol, another one every round, makes it a left or a right symbol,
and a left symbol followed by a right one becomes a new symbol. Symbols are named by digests of what
they stand for, so the same run or pair gets the same name in every document and round without a
table of names to shuffle; the Spark rounds below group those names globally.

A symbol is *interior* to a window of ``window`` words when all words that decide its parse lie in the
window. Equal windows therefore have equal interior symbols. Every window takes its highest interior
symbol (ties: by digest, then the leftmost) as its key; consecutive windows with the same occurrence
of a symbol form a segment, about one for every seven words. Then:

1. the mapper parses whole texts, combines equal segments of its batch (only the first goes on) and
   emits (symbol, digest of the whole segment, place);
2. Spark groups by symbol: a symbol seen once has no repeat. Under a shared symbol, a segment equal to
   an earlier one is repeated as a whole. Where a symbol has different segments, the first of each
   goes to
3. a look at single windows: their digests are grouped with the symbol, and all but the first are
   repeated.
4. Repeated windows are merged to word spans for each document and cut out.

A match needs equal 64-bit symbol digests and equal 64-bit digests of the words from a second,
independent hash: 128 bits, which is the verification. The largest group of equal segments reaches a task as
one row for each batch that holds it, so copies that fill a third of the table don't meet in one task.

Defined results: a window counts as repeated when its words start earlier too, in a smaller doc_id or
in the same document; windows are judged on the input. NULL, empty and wordless texts have no words
and stay as they are; rows with a NULL doc_id are never cut; rows equal in doc_id and text are one
document with one result; an empty table gives an empty result. Columns other than id and text are
kept and never read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C

ROUNDS = 4
#: up to this many places or spans (about 32 bytes each) may be broadcast to the scan; more are shuffled
BROADCAST_PLACES = 2_000_000
#: rows that the mapper combines at a time
COMBINED = 400_000
_U = C._U


# ---------------------------------------------------------------- recompression of one piece of text

class _Parse:
    """The current symbols: name, word span [b, e), deciding words [l, r), text."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        i = np.arange(len(words))
        self.name, self.b, self.e, self.l, self.r, self.doc = words, i, i + 1, i, i + 1, doc
        self.found = [(i, i + 1, np.zeros(len(words), dtype=np.uint64))]

    def _edges(self, outer_l, outer_r):
        """The deciding words of each symbol's neighbours; a text's edge decides from outside it."""
        n = len(self.name)
        left, right = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        same = self.doc[1:] == self.doc[:-1]
        left[:1], right[-1:] = outer_l[:1] - 1, outer_r[-1:] + 1
        left[1:] = np.where(same, self.l[:-1], outer_l[1:] - 1)
        right[:-1] = np.where(same, self.r[1:], outer_r[:-1] + 1)
        return left, right

    def _keep(self, made: np.ndarray, level: int):
        self.found.append((self.l[made], self.r[made], np.full(int(made.sum()), level, dtype=np.uint64)))

    def runs(self, level: int):
        n = len(self.name)
        if not n:
            return
        again = np.zeros(n, dtype=bool)
        again[1:] = (self.name[1:] == self.name[:-1]) & (self.doc[1:] == self.doc[:-1])
        left, right = self._edges(self.b, self.e)
        head = np.flatnonzero(~again)
        count = np.diff(np.append(head, n))
        last = head + count - 1
        many = count > 1
        name = self.name[head]
        self.name = np.where(many, C.mix(name + count.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), name)
        self.l, self.r = np.minimum(left[head], self.l[head]), np.maximum(right[last], self.r[last])
        self.b, self.e, self.doc = self.b[head], self.e[last], self.doc[head]
        self._keep(many, level)

    def pairs(self, level: int, limit: int):
        n = len(self.name)
        if n < 2:
            return
        is_left = (C.mix(self.name + _U(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> _U(63)) == 1
        length = self.e - self.b
        pair = np.zeros(n, dtype=bool)
        pair[:-1] = (is_left[:-1] & ~is_left[1:] & (self.doc[1:] == self.doc[:-1])
                     & (length[:-1] + length[1:] <= limit))
        left, right = self._edges(self.b, self.e)
        # an unpaired left symbol is decided by its right neighbour too, a right one by its left
        lone_l = np.where(is_left, self.l, np.minimum(self.l, left))
        lone_r = np.where(is_left, np.maximum(self.r, right), self.r)
        keep = np.ones(n, dtype=bool)
        keep[1:] = ~pair[:-1]
        at = np.flatnonzero(keep)
        made, nxt = pair[at], np.minimum(at + 1, n - 1)
        name = self.name[at]
        joined = C.mix(name * _U(0x9E3779B97F4A7C15) + self.name[nxt] + _U(level))
        l, r = self.l, self.r
        self.name = np.where(made, joined, name)
        self.l = np.where(made, np.minimum(l[at], l[nxt]), lone_l[at])
        self.r = np.where(made, np.maximum(r[at], r[nxt]), lone_r[at])
        self.b, self.e, self.doc = self.b[at], np.where(made, self.e[nxt], self.e[at]), self.doc[at]
        self._keep(made, level)


def segments(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(start, windows, key symbol's digest) of the segments of consecutive texts, whose words begin
    at ``first``. Every window start of every text lies in one segment."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    parse = _Parse(words, doc)
    for level in range(1, ROUNDS + 1):
        if level == 1:
            parse.runs(level)
        parse.pairs(level, window)
    l, r, level = (np.concatenate(x) for x in zip(*parse.found, strict=True))
    begin, end = np.repeat(first[:-1], counts), np.repeat(first[1:], counts)
    inside = (l >= 0) & (l < len(words))
    l, r, level = l[inside], r[inside], level[inside]
    inside = (l >= begin[l]) & (r <= end[l])
    l, r, level = l[inside], r[inside], level[inside]
    lo, hi = np.maximum(r - window, begin[l]), np.minimum(l, end[l] - window)
    inside = lo <= hi
    l, r, level, lo, hi = (x[inside] for x in (l, r, level, lo, hi))
    starts = np.flatnonzero(np.arange(len(words)) + window <= end)
    if not len(starts):
        return starts, starts, np.zeros(0, dtype=np.uint64)
    key = C.span_hashes(words, l, r)
    # priority: level, 32 bits of the digest, leftmost; the highest wins over a range of window starts
    rank = (level << _U(60)) | ((key >> _U(36)) << _U(32)) | (_U(0xFFFFFFFF) - l.astype(np.uint64))
    depth = max(1, int(window).bit_length())
    best = np.zeros((depth, len(words) + (1 << depth)), dtype=np.uint64)
    width = hi - lo + 1
    size = np.frexp(width.astype(np.float64))[1] - 1
    for d in range(depth):
        m = size == d
        np.maximum.at(best[d], lo[m], rank[m])
        np.maximum.at(best[d], hi[m] + 1 - (1 << d), rank[m])
    for d in range(depth - 1, 0, -1):
        half = 1 << (d - 1)
        np.maximum(best[d - 1], best[d], out=best[d - 1])
        np.maximum(best[d - 1][half:], best[d][:-half], out=best[d - 1][half:])
    top = best[0][starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (top[1:] != top[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    # the word at which the winner begins leads back to its digest
    order = np.argsort(rank)
    winner = order[np.searchsorted(rank, top[at], sorter=order)]
    return starts[at], np.diff(np.append(at, len(starts))), key[winner]


def merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Overlapping and touching [lo, hi) spans as one flat, sorted array of bounds."""
    if not len(lo):
        return np.zeros(0, dtype=np.int32)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate(([True], lo[1:] > hi[:-1]))
    at = np.flatnonzero(new)
    return np.stack([lo[at], hi[np.append(at[1:], len(lo)) - 1]], axis=1).ravel().astype(np.int32)


# places: word start (32 bits), a tag of the text (23), number of windows (8), as one long that sorts by start
def _place(start, tag, count):
    return (start.astype(np.int64) << 31) | (tag.astype(np.int64) << 8) | count.astype(np.int64)


def _repeats(parts: list[tuple[np.ndarray, ...]]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """All rows (key, ctx, doc, place) of a batch, and whether an earlier row has the same key and
    ctx. Rows equal throughout are all first."""
    key, ctx, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    both = C.mix(key + C.mix(ctx))
    order = np.argsort(both)
    s = both[order]
    dup = np.zeros(len(s), dtype=bool)
    dup[1:] = s[1:] == s[:-1]
    dup[:-1] |= dup[1:]
    some = order[dup]
    some = some[np.lexsort((place[some], doc[some], ctx[some], key[some]))]
    k, c, d, p = key[some], ctx[some], doc[some], place[some]
    new = np.ones(len(some), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(some) else some
    later = np.zeros(len(key), dtype=bool)
    later[some] = (d != d[head]) | (p != p[head])
    return (key, ctx, doc, place), later


_ROWS = "key long, ctx long, doc long, place long, spans binary"


def _rows(cols, later: np.ndarray, window: int):
    """First rows as they are, repeats as spans, one row for each text."""
    key, ctx, doc, place = cols
    go = ~later
    for lo in range(0, int(go.sum()), 200_000):
        at = np.flatnonzero(go)[lo:lo + 200_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[at].view(np.int64)), pa.array(ctx[at].view(np.int64)), pa.array(doc[at]),
             pa.array(place[at]), pa.nulls(len(at), pa.binary())], ["key", "ctx", "doc", "place", "spans"])
    if later.any():
        doc, place = doc[later], place[later]
        tag = (place >> 8) & 0x7FFFFF
        order = np.lexsort((place, tag, doc))
        doc, place, tag = doc[order], place[order], tag[order]
        cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]))))
        spans = []
        for a, b in zip(cut, np.append(cut[1:], len(doc)), strict=True):
            start = place[a:b] >> 31
            spans.append(merged(start, start + (place[a:b] & 0xFF) + (window - 1)).tobytes())
        doc, tag = doc[cut], tag[cut]
        away = C.mix(doc.astype(np.uint64)).view(np.int64)          # such rows only pass through
        yield pa.RecordBatch.from_arrays(
            [pa.array(away), pa.array(np.zeros(len(doc), dtype=np.int64)), pa.array(doc),
             pa.array(tag << 8), pa.array(spans, type=pa.binary())], ["key", "ctx", "doc", "place", "spans"])


def _pieces_of(batch):
    """(row numbers, first word of each, two word digests, tags of the texts) of a batch's pieces.
    A tag tells texts apart that share a doc_id."""
    for lo, hi, data, offsets in C.pieces(batch.column("text")):
        starts, ends, first = C.word_spans(data, offsets)
        one, two = (C.word_hashes(data, starts, ends, which) for which in (0, 1))
        tag = C.span_hashes(one, first[:-1], first[1:], 1) >> _U(41)
        yield np.arange(lo, hi), first, one, two, tag.astype(np.int64)


def _segment_rows(window: int):
    def run(batches):
        parts = []
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            for rows, first, one, two, tag in _pieces_of(batch):
                start, count, key = segments(one, first, window)
                which = np.searchsorted(first, start, side="right") - 1
                ctx = C.span_hashes(two, start, start + count + (window - 1))
                parts.append((key, ctx, ids[rows][which], _place(start - first[which], tag[which], count)))
                if sum(len(p[0]) for p in parts) > COMBINED:
                    yield from _rows(*_repeats(parts), window)
                    parts = []
        if sum(len(p[0]) for p in parts):
            yield from _rows(*_repeats(parts), window)
    return run


def _window_rows(window: int):
    """Rows of single windows, for the places asked for: ``asked`` is a list of (place, key)."""
    def run(batches):
        parts = []
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            asked = batch.column("asked")
            bounds = asked.offsets.to_numpy() - asked.offsets[0].as_py()
            flat = asked.flatten()
            place, key = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("place", "key"))
            for rows, first, _, two, tag in _pieces_of(batch):
                a, b = bounds[rows[0]], bounds[rows[-1] + 1]
                row = np.repeat(np.arange(len(rows)), np.diff(bounds[rows[0]:rows[-1] + 2]))
                p, k = place[a:b], key[a:b]
                own = ((p >> 8) & 0x7FFFFF) == tag[row]
                p, k, row = p[own], k[own], row[own]
                count = p & 0xFF
                at = np.repeat((p >> 31) + first[row], count)
                at += np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                row, k = np.repeat(row, count), np.repeat(k, count)
                ctx = C.span_hashes(two, at, at + window)
                parts.append((k.view(np.uint64), ctx, ids[rows][row],
                              _place(at - first[row], tag[row], np.ones(len(at)))))
                if sum(len(p[0]) for p in parts) > COMBINED:
                    yield from _rows(*_repeats(parts), window)
                    parts = []
        if sum(len(p[0]) for p in parts):
            yield from _rows(*_repeats(parts), window)
    return run


# ---------------------------------------------------------------- the Spark rounds

def _judged(rows: DataFrame) -> DataFrame:
    """Adds ``earlier``: the place of the first row with the same key and ctx isn't this one;
    ``apart``: the key has several ctx."""
    first = F.expr("first(struct(doc, place)) OVER (PARTITION BY key, ctx ORDER BY doc, place)")
    return rows.select(
        "*", (first != F.struct("doc", "place")).alias("earlier"),
        F.expr("min(ctx) OVER (PARTITION BY key) <> max(ctx) OVER (PARTITION BY key)").alias("apart"))


def repeated_spans(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tag, spans): for each document with repeated windows, its covered words as a list of
    little-endian 32-bit [start, end) bounds, unmerged between rows."""
    if not 1 <= window <= 200:
        raise ValueError("window must be 1 to 200 words")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    texts = texts.where("doc IS NOT NULL")
    judged = _judged(texts.mapInArrow(C.lean(_segment_rows(window)), _ROWS))
    found = C.written(judged.where("spans IS NOT NULL OR earlier OR apart"), "repeats")
    plain = found.where("spans IS NULL")
    asked = C.written(
        plain.where("NOT earlier AND apart").select("doc", F.struct("place", "key").alias("one"))
        .groupBy("doc").agg(F.collect_list("one").alias("asked")), "asked")      # bounded by a text's length
    few = asked.agg(F.sum(F.size("asked"))).first()[0]
    small = F.broadcast(asked) if (few or 0) <= BROADCAST_PLACES else asked
    singles = _judged(texts.join(small, "doc").mapInArrow(C.lean(_window_rows(window)), _ROWS))
    singles = singles.where("spans IS NOT NULL OR earlier")
    return _by_document(C.written(
        C.union_all([f.select("doc", "place", "spans") for f in
                     (found.where("spans IS NOT NULL"), plain.where("earlier"), singles)]), "spans"), window)


def _by_document(rows: DataFrame, window: int) -> DataFrame:
    """Gather the rows of each document; a document has at most as many as it has words."""
    tag = F.expr("shiftright(place, 8) & 8388607")
    lists = (rows.groupBy("doc", tag.alias("tag"))
             .agg(F.collect_list(F.when(F.col("spans").isNull(), F.col("place"))).alias("places"),
                  F.collect_list("spans").alias("parts")))

    def run(batches):
        for batch in batches:
            out = []
            for places, parts in zip(batch.column("places").to_pylist(), batch.column("parts").to_pylist(),
                                     strict=True):
                p = np.array(places, dtype=np.int64)
                s = np.frombuffer(b"".join(parts), dtype=np.int32).reshape(-1, 2).astype(np.int64)
                start = p >> 31
                # a row of a single window has count 1, one of a segment its number of windows
                out.append(merged(np.concatenate([start, s[:, 0]]),
                                  np.concatenate([start + (p & 0xFF) + (window - 1), s[:, 1]])).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("tag"), pa.array(out, type=pa.binary())],
                ["doc", "tag", "spans"])

    return lists.mapInArrow(C.lean(run), "doc long, tag long, spans binary")


def removed_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The general result: (doc, tag, spans) of what to cut, one row per document with a repeat."""
    return C.written(repeated_spans(docs, window, id_col, text_col), "cuts")


def word_digests(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (hex digest of the kept words, joined by one
    space). Texts without repeats are digested where they are read; only the others meet their spans."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cuts = removed_spans(texts, window, "doc_id", "text")
    return _applied(texts, cuts, _digest, "n_words long, n_removed long, kept_sha256 string", [])


def without_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text: from the first removed word to the next
    kept one. Other texts, and all other columns, stay byte for byte as they are."""
    cuts = removed_spans(docs, window, id_col, text_col)
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    inner = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"),
                        F.struct(F.lit(None).cast("string").alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
                        .alias("rest"))
    kind = inner.schema["rest"].dataType.simpleString()
    out = _applied(inner, cuts, _cut_text, "text string", [("rest", kind)])
    of = {id_col: F.col("doc_id"), text_col: F.col("text")} | {c: F.col(f"rest.c{i}") for i, c in enumerate(rest)}
    return out.select(*[of[c].alias(c) for c in docs.columns])


def _left_over(data: np.ndarray, starts, kept) -> bytes:
    """The text without the words not kept, each up to where the next word starts."""
    if kept.all():
        return data.tobytes()
    drop = np.zeros(len(data) + 1, dtype=np.int8)
    nxt = np.append(starts[1:], len(data))
    gone = np.flatnonzero(~kept)
    np.add.at(drop, starts[gone], 1)
    np.add.at(drop, nxt[gone], -1)
    return data[np.cumsum(drop[:-1], dtype=np.int32) == 0].tobytes()


def _digest(data: np.ndarray, starts, kept) -> dict:
    words = _left_over(data, starts, kept).split()
    return {"n_words": len(starts), "n_removed": len(starts) - len(words),
            "kept_sha256": hashlib.sha256(b" ".join(words)).hexdigest()}


def _cut_text(data: np.ndarray, starts, kept) -> dict:
    return {"text": _left_over(data, starts, kept).decode()}


def _applied(texts: DataFrame, cuts: DataFrame, make, kind: str, carry: list[tuple[str, str]]) -> DataFrame:
    """``make`` applied to each text with the words its document keeps."""
    carried = [n for n, _ in carry]
    fields = [f.split()[0] for f in kind.split(", ")]
    schema = ", ".join(["doc_id long", kind, *[f"{n} {t}" for n, t in carry]])

    def run(batches):
        for batch in batches:
            made = {f: [] for f in fields}
            texts_, cuts_ = batch.column("text"), batch.column("cuts").to_pylist()
            for lo, hi, data, offsets in C.pieces(texts_):
                starts, ends, first = C.word_spans(data, offsets)
                if any(cuts_[lo:hi]):
                    words = C.word_hashes(data, starts, ends)
                    tag = (C.span_hashes(words, first[:-1], first[1:], 1) >> _U(41)).astype(np.int64)
                for i in range(hi - lo):
                    a, b, o = first[i], first[i + 1], offsets[i]
                    kept = np.ones(b - a, dtype=bool)
                    for c in cuts_[lo + i] or ():
                        if c["tag"] == tag[i]:
                            for x, y in np.frombuffer(c["spans"], dtype=np.int32).reshape(-1, 2):
                                kept[x:y] = False
                    row = make(data[o:offsets[i + 1]], starts[a:b] - o, kept)
                    for f in fields:
                        made[f].append(row[f])
            null = texts_.is_null().to_pylist() if "text" in fields else None
            if null:
                made["text"] = [None if n else t for n, t in zip(null, made["text"], strict=True)]
            names = ["doc_id", *fields, *carried]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(made[f], type=pa.int64() if f.startswith("n_") else pa.string())
                                           for f in fields], *[batch.column(n) for n in carried]], names)

    lists = (cuts.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("tag", "spans")).alias("cuts")))
    few = cuts.agg(F.sum(F.length("spans") / 8 + 1)).first()[0]
    if (few or 0) <= BROADCAST_PLACES:
        lists = F.broadcast(lists)
    return texts.join(lists, "doc_id", "left").mapInArrow(C.lean(run), schema)
