"""Token ids of whole columns, as the tokenizers library gives them.

Where a tokenizer drops white space, a text's ids are the ids of its words in order: nothing in
its normaliser, its split pattern or its merges reaches across white space. Then each distinct
word of a piece of text is encoded once, a bounded cache keeps words between pieces, and the ids
of the texts are gathered with numpy. Other tokenizers encode each text as a whole. The tests
hold both against the library on whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerline.llm import common as C

PIECE_BYTES = 3 << 19
#: words that a worker remembers (about 50 bytes each); beyond it only the common ones stay
CACHE_WORDS = 1_000_000

#: a character of one id that hardly occurs; words with it are encoded one by one
MARKER = "\x7f"

def read_file(path: str) -> bytes:
    """The tokenizer file, read once by the driver and sent along with the task."""
    with open(path, "rb") as f:
        return f.read()


def version(blob: bytes) -> str:
    return hashlib.sha256(blob).hexdigest()


def encoder(blob: bytes, name: str) -> Encoder:
    """This worker's encoder for the tokenizer with that version."""
    if name not in C.KEPT:
        C.KEPT[name] = Encoder(blob)
    return C.KEPT[name]


def _state(part) -> dict:
    """A part of a tokenizer as its file describes it, without parsing the whole file again."""
    return json.loads(part.__getstate__()) if part is not None else {}


def _first_split(pre: dict) -> dict:
    return (pre.get("pretokenizers") or [pre])[0]


def drops_white_space(tk, pre: dict) -> bool:
    """Whether white space yields no token and separates what does."""
    first = _first_split(pre)
    added = [a for a in tk.get_added_tokens_decoder().values()
             if a.lstrip or a.rstrip or a.single_word or any(c.isspace() for c in a.content)]
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
            and not added and not tk.pre_tokenizer.pre_tokenize_str(" \t\n\x0b\x0c\r"))


def _string_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bytes) of a string column without NULLs."""
    _, offsets, data = column.cast(pa.large_string()).buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets[:-1], offsets[1:], data


def _gather(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    before = np.cumsum(count, dtype=np.int32) - count
    at = np.repeat(start - before, count)
    at += np.arange(len(at), dtype=np.int32)
    return at


class Encoder:
    def __init__(self, blob: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task is one core
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_buffer(blob)
        self.tk.no_truncation()
        self.tk.no_padding()
        pre, normal = _state(self.tk.pre_tokenizer), _state(self.tk.normalizer)
        self.lowers = any(n["type"] == "Lowercase" for n in normal.get("normalizers", []))
        suffix = getattr(self.tk.model, "end_of_word_suffix", None)
        size = self.tk.get_vocab_size()
        self.ends = np.fromiter((bool(suffix) and (self.tk.id_to_token(i) or "").endswith(suffix) for i in range(size)),
                                dtype=bool, count=size)
        marker = self.tk.encode(MARKER, add_special_tokens=False).ids
        self.marker_id = marker[0] if len(marker) == 1 else None
        self.by_word = drops_white_space(self.tk, pre)
        # marks that the split pattern parts from letters, of one id each
        pattern = (_first_split(pre).get("pattern") or {}).get("Regex", "")
        parted = all(x in pattern for x in (r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"))
        ids = {m: self.tk.encode(m, add_special_tokens=False).ids for m in ",.;!?"}
        self.marks = {m: i[0] for m, i in ids.items() if len(i) == 1 and self.by_word and parted}
        self.forget()

    def forget(self):
        """An empty cache: entries sorted by the first of two 64-bit hashes of a word, each with the place and number
        of its ids and the number of pieces that had it."""
        self.key = np.zeros(0, dtype=np.uint64)
        self.check = np.zeros(0, dtype=np.uint64)
        self.start, self.count, self.uses = (np.zeros(0, dtype=np.int32) for _ in range(3))
        self.ids = np.zeros(0, dtype=np.int32)

    def _thin_out(self):
        """Keep the words that most pieces had, at most a third of the cache."""
        n = len(self.key) // 3
        least = np.partition(self.uses, -n)[-n] + 1
        keep = self.uses >= least
        self.ids = self.ids[_gather(self.start[keep], self.count[keep])]
        self.key, self.check, self.count, self.uses = (x[keep] for x in (self.key, self.check, self.count, self.uses))
        self.start = np.cumsum(self.count, dtype=np.int32) - self.count
        self.uses //= 2

    def _find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each word or -1, the two hashes)."""
        starts, ends, data = _string_spans(words)
        key, check = (C.word_hashes(data, starts, ends, which) for which in (0, 1))
        entry = np.full(len(words), -1, dtype=np.int64)
        if len(self.key):
            order = np.argsort(key)
            at = np.minimum(np.searchsorted(self.key, key[order]), len(self.key) - 1)
            hit = (self.key[at] == key[order]) & (self.check[at] == check[order])
            entry[order[hit]] = at[hit]
        return entry, key, check

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tk.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(counts.sum())), counts

    def _joined(self, words: list[str], alpha: bool) -> tuple[np.ndarray, np.ndarray]:
        """As ``_plain`` for words, many to a text: faster, for white space separates them all the same. The
        words' ids are told apart by the end-of-word ids, of which a word of letters alone has one, or
        by a marker between words. Should the count not come out, the words are encoded one by one."""
        if alpha and not self.ends.any() or not alpha and self.marker_id is None:
            return self._plain(words)
        between = " " if alpha else f" {MARKER} "
        texts = [between.join(words[i:i + 200]) + ("" if alpha else f" {MARKER}") for i in range(0, len(words), 200)]
        flat, _ = self._plain(texts)
        last = self.ends[flat] if alpha else flat == self.marker_id
        at = np.flatnonzero(last)
        if len(at) != len(words):
            return self._plain(words)
        counts = np.diff(at, prepend=-1)
        return (flat, counts) if alpha else (flat[~last], counts - 1)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word), in the words' order."""
        place: dict[str, int] = {}
        kinds = alpha, other, alone = [], [], []
        marked = []
        for w in words:
            if w.isalpha():
                alpha.append(w)
            elif w[-1:] in self.marks and w[:-1].isalpha():
                marked.append(w)                              # letters and one mark: two parts with ids of their own
            else:
                (alone if MARKER in w else other).append(w)
        alpha[:] = dict.fromkeys(chain(alpha, (w[:-1] for w in marked)))
        flat, counts = [], []
        for kind, chosen in enumerate(kinds):
            for lo in range(0, len(chosen), 5000):
                part = chosen[lo:lo + 5000]
                f, c = self._plain(part) if kind == 2 else self._joined(part, kind == 0)
                flat.append(f)
                counts.append(c)
            place.update(zip(chosen, range(len(place), len(place) + len(chosen)), strict=True))
        flat = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32)
        counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        start = np.cumsum(counts) - counts
        known = set(marked)
        at = np.fromiter((place[w[:-1] if w in known else w] for w in words), dtype=np.int64, count=len(words))
        flat, counts = flat[_gather(start[at].astype(np.int32), counts[at].astype(np.int32))], counts[at]
        if marked:
            ends = np.cumsum(counts)
            which = np.fromiter((w in known for w in words), dtype=bool, count=len(words))
            flat = np.insert(flat, ends[which], [self.marks[w[-1]] for w in words if w in known])
            counts = counts + which
        return flat, counts

    def _entries(self, words: pa.Array) -> np.ndarray:
        """The cache entry of each of these distinct words, learned where new."""
        entry, key, check = self._find(words)
        if len(self.key) + (entry < 0).sum() > CACHE_WORDS and len(self.key) > 2:
            self._thin_out()
            entry, key, check = self._find(words)
        new = np.flatnonzero(entry < 0)
        if len(new):
            flat, counts = self._encode_words(words.take(pa.array(new)).to_pylist())
            start = (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32)
            order = np.argsort(key[new])
            new = new[order]
            at = np.searchsorted(self.key, key[new])
            for name, values in (("key", key[new]), ("check", check[new]), ("start", start[order]),
                                 ("count", counts[order].astype(np.int32)), ("uses", np.zeros(len(new), dtype=np.int32))):
                setattr(self, name, np.insert(getattr(self, name), at, values))
            self.ids = np.concatenate([self.ids, flat])
            entry, _, _ = self._find(words)
        self.uses[entry] += 1
        return entry

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, ids of these texts, number of ids of each); NULL is empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        for lo, hi, _, _ in C.pieces(column, PIECE_BYTES):
            part = column.slice(lo, hi - lo)
            if not self.by_word:
                yield lo, hi, *self._plain(part.to_pylist())
                continue
            # capitals that the normaliser lowers anyway need no entries of their own; the strings of special
            # tokens are matched before it
            if self.lowers and not pc.any(pc.match_substring(part, "<|")).as_py():
                part = pc.ascii_lower(part)
            lists = pc.ascii_split_whitespace(part)
            coded = lists.flatten().dictionary_encode()
            entry = self._entries(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
            count, start = self.count[entry], self.start[entry]
            total = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            yield lo, hi, self.ids[_gather(start, count)], np.diff(total[bounds])
