from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidecast.llm.chat import chat_windows, escape, read_turns, unescape, window_digests, write_turn
from tidecast.llm.packing import BpeTokenizer, choose_cuts, pack_documents

FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
ODD = [
    None,
    "",
    " ",
    "a  b   c \n d\n\n e",
    " lead and trail ",
    "tab\there\r\nand nbsp x   y",
    "it's we'll I'M 123 4567 !!! ...?",
    "end<|endoftext|>start <|endoftext|>",
    "é ñ ß 漢字 😀 zero​width",
    "\x00\x1c \x1f x",
    "word " * 9000,
    "x" * 5000,
]


def ids_of(texts):
    t = Tokenizer.from_file(FILES[0])
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_tokenizer_equals_the_file():
    t = BpeTokenizer(*FILES)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(ODD, ids_of(ODD), strict=True):
            assert np.frombuffer(t.encode(text or ""), dtype="<u4").tolist() == ids


def test_pieces_round_trip_with_little_padding(spark, documents):
    rng = random.Random(8)
    texts = ODD + [
        " ".join(rng.choices(["alpha", "beta.", "gamma", "delta!", "eps"], k=rng.randint(1, 900)))
        for _ in range(150)
    ]
    df = documents(texts + [None], start=1, length=2, offset=3)
    rows = pack_documents(df.repartition(2), *FILES, stretch=1 << 13).collect()
    ids = [x + [1] for x in ids_of(texts + [None])]
    for k, own in enumerate(ids):
        at = 0
        for r in sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start):
            piece = np.array(own[at : at + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens) == (at, len(own)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
            at += r.length
        assert at == len(own)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.02 * total


def test_packing_nothing_and_repeated_rows(spark, documents):
    assert pack_documents(documents([]), *FILES).count() == 0
    rows = pack_documents(documents([(1, "a b"), (1, "a b"), (None, "c")]).coalesce(1), *FILES).collect()
    assert sorted((r.doc_id or 0, r.offset) for r in rows) == [(0, 6), (1, 0), (1, 3)]


def test_cuts_are_a_cheapest_packing():
    """Against all ways to cut a small stream."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        total = int(rng.integers(20, 60))
        ends = np.unique(np.append(rng.integers(1, total, 4), total))
        sentences = np.unique(rng.integers(1, total, 8))
        width = 16
        at, _, cost = choose_cuts(ends, sentences, total, width, grid=4)
        pen = {p: 8 for p in at} | {int(p): 2 for p in sentences} | {int(p): 0 for p in ends}
        best = {0: 0}
        for j in at[1:]:
            ways = []
            for i in (i for i in at if i < j and j - i <= width):
                n = j - i
                padding = 0 if n & (n - 1) == 0 and n >= 16 else width - n
                ways.append(best[i] + padding + (16 if n < width else 0) + pen[j])
            best[j] = min(ways)
        assert cost[-1] == best[total]


def conversation(spark, rows, **extra):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def expected(rows):
    """Digests of one conversation's (role, text) rows."""
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (turns, loss)]
    return (len(rows), digest[0], len(loss), digest[1])


@pytest.mark.parametrize("budget", [12, 40, 100_000])
def test_windows_read_back_whole(spark, budget):
    rng = random.Random(budget)
    text = ["### user:\n", "</turn>\n", "\\", "\\n", "<", "#", "a b c", "é😀", ""]
    talks = {
        k: [("system", "be kind <#>")] * (k % 2)
        + [
            (rng.choice(["user", "assistant", "to\nol", None]), "".join(rng.choices(text, k=5)))
            for _ in range(rng.randint(1, 30))
        ]
        for k in range(12)
    }
    talks[-7] = [(r, "\\### Assistant: </turn> ok") for r in ("user", "assistant")]
    rows = [(k, i, *turn) for k, turns in talks.items() for i, turn in enumerate(turns)]
    rng.shuffle(rows)
    df = conversation(spark, rows, window=1, masks=2)
    windows = chat_windows(df, budget=budget, history=8)
    got = {r.conv_id: r for r in window_digests(windows).collect()}
    for k, turns in talks.items():
        r = got[k]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
    for w in windows.collect():
        turns = read_turns(w.text)
        assert len(turns) > w.repeated
        if w.window and w.conv_id % 2 and w.conv_id > 0:
            assert turns[0][:2] == ("system", "be kind <#>") and w.repeated
        if len(turns) > w.repeated + 1:
            assert w.tokens <= budget
        spans = {(s, e) for role, _, s, e in turns[w.repeated :] if role == "assistant"}
        assert {(m.start, m.end) for m in w.masks} == spans


def test_chat_defined_cases(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", None), (1, None, None, "late"), (1, 0, "user", "a")]
    got = {r.conv_id: r.n_turns for r in window_digests(chat_windows(conversation(spark, rows * 2))).collect()}
    assert got == {None: 4, 1: 4}
    assert chat_windows(conversation(spark, []).limit(0)).count() == 0
    long = [(5, k, "assistant", "word " * 4000) for k in range(3)]
    windows = chat_windows(conversation(spark, long), budget=100).collect()
    assert [w.window for w in sorted(windows, key=lambda w: w.window)] == [0, 1, 2]


def test_escape_is_reversible():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices("\\<#n l h/>\nturn", k=rng.randint(0, 30)))
        assert unescape(escape(text)) == text and "<" not in escape(text)
        formatted, start, end = write_turn(text, text)
        assert read_turns(formatted) == [(text, text, start, end)]
