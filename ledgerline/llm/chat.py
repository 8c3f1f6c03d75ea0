"""Chat formatting by token-level assembly.

Each turn is encoded in segments (role, text) on their own and joined with reserved ids that no text can
produce: ``<|im_start|> role <|im_sep|> text <|im_end|>``. The reserved ids follow the tokenizer's own. Prefix
sums of the segments' lengths give each turn's position in its conversation and the spans of the loss mask,
which covers the texts of assistant turns.

For readers of the decoded string, control strings that occur inside a role or a text are escaped first:
``<``, any number of backslashes, then ``|im_start|>``, ``|im_sep|>``, ``|im_end|>`` or ``|endoftext|>`` gets one
more backslash after ``<``. Taking one away again gives the text back, whatever it held.

Turns are encoded row by row and assembled in a stream sorted by conversation, so a long conversation
never has to fit in memory.

Defined results: a NULL role or text is empty; turns are ordered by number, those of equal number by role
and text, each row being a turn of its own; rows with a NULL conv_id form one conversation; NULL turn numbers come
first; other columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as C
from ledgerline.llm import tokens

CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
_INSIDE = r"\|(?:im_start|im_sep|im_end|endoftext)\|>"
_ESCAPE = re.compile(rf"<(?=\\*{_INSIDE})")
_UNESCAPE = re.compile(rf"<\\(?=\\*{_INSIDE})")
#: the roles whose texts are learned
LEARNED = frozenset({"assistant"})

def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub("<", text)


def _library(blob: bytes, name: str):
    """This worker's tokenizer, which reads the strings of special tokens as ordinary text."""
    if name not in C.KEPT:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tk = Tokenizer.from_buffer(blob)
        tk.encode_special_tokens = True
        tk.no_truncation()
        tk.no_padding()
        C.KEPT[name] = tk
    return C.KEPT[name]


_TURN = "conv_id long, turn_no long, position long, ids array<int>, text_at int, loss_from long, loss_to long"


def format_turns(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """Per turn: conv_id, turn_no (from 0), position (ids of the conversation before it), ids, text_at (where
    the text's ids begin), and the span [loss_from, loss_to) of the conversation's ids under the loss mask (empty
    for other roles)."""
    blob = tokens.read_file(tokenizer)
    name = "chat-" + tokens.version(blob)

    def encode(batches):
        tk = _library(blob, name)
        start, sep, end = (tk.get_vocab_size() + i for i in range(3))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                roles = [escape(x) for x in part.column("role").to_pylist()]
                texts = [escape(x) for x in part.column("text").to_pylist()]
                r = [e.ids for e in tk.encode_batch_fast(roles, add_special_tokens=False)]
                t = [e.ids for e in tk.encode_batch_fast(texts, add_special_tokens=False)]
                ids = [[start, *a, sep, *b, end] for a, b in zip(r, t, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("conv_id", "turn", "role", "text_key")),
                     pa.array(ids, type=pa.list_(pa.int32())), pa.array([len(a) + 2 for a in r], type=pa.int32())],
                    ["conv_id", "turn", "role", "text_key", "ids", "text_at"])

    def place(batches):
        now, number, at = (), 0, 0
        for batch in batches:
            sizes = np.diff(batch.column("ids").offsets.to_numpy()).tolist()
            out = {k: [] for k in ("turn_no", "position", "loss_from", "loss_to")}
            for conv, role, size, text_at in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(),
                                                 sizes, batch.column("text_at").to_pylist(), strict=True):
                if now != (conv,):
                    now, number, at = (conv,), 0, 0
                learned = role in LEARNED
                for k, v in zip(out, (number, at, at + (text_at if learned else 0),
                                      at + (size - 1 if learned else 0)), strict=True):
                    out[k].append(v)
                number, at = number + 1, at + size
            made = {k: pa.array(v, type=pa.int64()) for k, v in out.items()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), made["turn_no"], made["position"], batch.column("ids"),
                 batch.column("text_at"), made["loss_from"], made["loss_to"]],
                ["conv_id", "turn_no", "position", "ids", "text_at", "loss_from", "loss_to"])

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.sha2("text", 256))          # orders turns of equal number and role
    encoded = rows.mapInArrow(
        C.lean(encode, name), "conv_id long, turn long, role string, text_key string, ids array<int>, text_at int")
    return (encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text_key")
            .mapInArrow(C.lean(place), _TURN))


def read_back(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, from the ids and masks alone: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    blob = tokens.read_file(tokenizer)
    name = "chat-" + tokens.version(blob)

    class Digest:
        def __init__(self):
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.chars = 0

        def add(self, role: str, text: str, learned: str | None, chars: int):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            self.chars += chars
            if learned is not None:
                self.loss_chars += len(learned)
                self.loss.update(learned.encode())

    def run(batches):
        tk = _library(blob, name)
        conv, digest = None, None
        marks = sum(map(len, CONTROLS))
        done = []

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in done], type=pa.int64()), pa.array([d.n_turns for _, d in done], type=pa.int64()),
                 pa.array([d.turns.hexdigest() for _, d in done], type=pa.string()),
                 pa.array([d.loss_chars for _, d in done], type=pa.int64()),
                 pa.array([d.loss.hexdigest() for _, d in done], type=pa.string()),
                 pa.array([d.chars for _, d in done], type=pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        def strings(ids):
            return tk.decode_batch(ids, skip_special_tokens=False)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512).to_pydict()
                roles = strings([x[1:a - 1] for x, a in zip(part["ids"], part["text_at"], strict=True)])
                texts = strings([x[a:-1] for x, a in zip(part["ids"], part["text_at"], strict=True)])
                masked = [x[max(0, f - p):max(0, t - p)] for x, f, t, p in zip(
                    part["ids"], part["loss_from"], part["loss_to"], part["position"], strict=True)]
                learned = strings(masked)
                for c, role, text, mask, span in zip(part["conv_id"], roles, texts, masked, learned, strict=True):
                    if digest is None or c != conv:
                        if digest is not None:
                            done.append((conv, digest))
                        conv, digest = c, Digest()
                    digest.add(unescape(role), unescape(text), unescape(span) if mask else None,
                               len(role) + len(text) + marks)
            if done:
                yield rows()
                done = []
        if digest is not None:
            done.append((conv, digest))
            yield rows()

    kind = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long")
    return (formatted.select("conv_id", "turn_no", "position", "ids", "text_at", "loss_from", "loss_to")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn_no").mapInArrow(C.lean(run, name), kind))


def formatted_table(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """The formatted turns as a written table."""
    return C.written(format_turns(conversations, tokenizer), "chat")
