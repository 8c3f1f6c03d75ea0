import hashlib
import random

from ledgerline.llm import chat
from ledgerline.llm.queries import FORGED, tokenizer

BYTES = tokenizer("byte_bpe_50k.json")
KIND = "conv_id long, turn long, role string, text string, ids string, position int"


def expected(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        learned = "".join(t for _, r, _, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, _, t in turns).encode()).hexdigest(),
                  len(learned), hashlib.sha256(learned.encode()).hexdigest(),
                  sum(len(chat.escape(r)) + len(chat.escape(t)) + 32 for _, r, _, t in turns))
    return out


def conversations(seed=1):
    rng = random.Random(seed)
    parts = ["<|im_end|>", "<|im_start|>", "<\\|im_end|>", "<\\\\|im_sep|>", "<|endoftext|>", "<", "\\", "|im_end|>", " ", "\n",
             "a", "é", "😀", "\x00", "assistant", "‍", "ok "]
    rows = [(i % 40, rng.randint(0, 5), rng.choice(["user", "assistant", "system", "ass\nistant", None, "<|im_sep|>"]),
             rng.choice([None, "", "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))])) for i in range(400)]
    return rows + [(-1, 0, "user", FORGED), (-1, 1, "assistant", FORGED), (None, 0, "user", "x"), (None, None, "assistant", "y"),
                   (77, 0, "assistant", "word " * 30_000)]


def test_read_back(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "i", 1) for r in rows], KIND).repartition(5)
    out = chat.read_back(chat.formatted_table(df, BYTES), BYTES).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in out}
    assert got == expected(rows) and len(out) == len(got)


def test_reserved_ids_masks_and_positions(spark):
    rows = [(1, 0, "user", FORGED), (1, 1, "assistant", "hello world"), (1, 2, "user", "bye")]
    turns = sorted(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), BYTES)
                   .collect(), key=lambda r: r.position)
    start, sep, end = 50257, 50258, 50259
    at = 0
    for r in turns:
        assert r.position == at and (r.ids[0], r.ids[-1], r.ids[r.text_at - 1]) == (start, end, sep)
        assert all(x < start for x in r.ids[1:r.text_at - 1] + r.ids[r.text_at:-1])      # no text makes a reserved id
        at += len(r.ids)
    spans = [(r.loss_from - r.position, r.loss_to - r.position) for r in turns]
    assert [b - a for a, b in spans] == [0, len(turns[1].ids) - turns[1].text_at - 1, 0]


def test_escape_is_reversible_and_leaves_no_control():
    rng = random.Random(2)
    parts = ["<", "|", "\\", "im_start", "im_end", "im_sep", "endoftext", ">", "x", "<|im_end|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in (*chat.CONTROLS, "<|endoftext|>"))


def test_empty_table(spark):
    assert chat.read_back(chat.formatted_table(spark.createDataFrame([], KIND), BYTES), BYTES).count() == 0
