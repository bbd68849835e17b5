"""Chat formatting in budgeted windows.

A conversation becomes one or more windows of text. Prefix sums of turn tokens choose spans of
whole turns that fit ``budget``; each later window starts with the system turn and the last few
turns before its span, as far as ``history`` tokens go. Only turns that are new in a window are
under its loss mask, so a repeated assistant turn is never learned twice.

The template writes ``### role:``, a line end, the text, ``</turn>`` and a line end. Inside roles
and texts ``<`` is written as backslash l, ``#`` as backslash h and a backslash twice, so that no
control string can appear there, and a line end in a role as backslash n; ``unescape`` reverses it.

Defined cases: null roles and texts are empty; null conversation ids form one conversation; turns
are ordered by turn (null first), role and text, repeated rows stay; a turn longer than the budget
gets a window of its own; an empty conversation table gives no window.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import bounded_batches

TURN_END = "</turn>\n"
_WRITTEN = {"\\": "\\\\", "<": "\\l", "#": "\\h"}
_READ = {"\\": "\\", "l": "<", "h": "#", "n": "\n"}
_SPECIAL = re.compile(r"[\\<#]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ([^\n]*):\n(.*?)</turn>\n", re.S)

WINDOWS = (
    "conv_id long, window long, text string, repeated int, "
    "masks array<struct<start:long,end:long>>, tokens long"
)
_WINDOW_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("text", pa.string()),
        ("repeated", pa.int32()),
        ("masks", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("tokens", pa.int64()),
    ]
)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: _WRITTEN[m.group()], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _READ[m.group(1)], text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends."""
    head = f"### {escape(role)}".replace("\n", "\\n") + ":\n"
    body = escape(text)
    return head + body + TURN_END, len(head), len(head) + len(body)


def read_turns(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of a window, unescaped; the span is of the text."""
    return [
        (unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(text)
    ]


def count_words(text: str) -> int:
    return len(text.split())


def token_counter(path: str | None) -> Callable[[], Callable[[str], int]]:
    """Makes the counter inside a task: tokens of the file at ``path``, or words without one."""

    def make() -> Callable[[str], int]:
        if path is None:
            return count_words
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda x: len(tokenizer.encode(x, add_special_tokens=False).ids)

    return make


class _Conversation:
    """The open window of one conversation; never holds more than a window and its history."""

    def __init__(self, conv_id: int | None, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple | None = None
        self.past: deque = deque()  # (prefix sum before the turn, turn), at most history tokens
        self.sum = 0
        self.number = 0
        self.new: list[tuple] = []
        self.repeated: list[tuple] = []
        self.used = 0

    def add(self, role: str, text: str, count: Callable[[str], int]) -> tuple | None:
        formatted, start, end = write_turn(role, text)
        turn = (formatted, start, end, role, count(formatted))
        closed = None
        if self.new and self.used + turn[4] > self.budget:
            closed = self.close()
            self.open(turn[4])
        if self.system is None:  # the first turn; an empty tuple if it is of another role
            self.system = turn if role == "system" else ()
        self.new.append(turn)
        self.used += turn[4]
        if turn is not self.system:
            self.past.append((self.sum, turn))
        self.sum += turn[4]
        while self.past and self.sum - self.past[0][0] > self.history:
            self.past.popleft()
        return closed

    def open(self, next_tokens: int) -> None:
        kept = [self.system] if self.system else []
        room = self.budget - next_tokens - (self.system[4] if self.system else 0)
        tail: list[tuple] = []
        for before, turn in reversed(self.past):
            if self.sum - before > min(room, self.history):
                break
            tail.append(turn)
        self.repeated = kept + tail[::-1]
        self.used = sum(t[4] for t in self.repeated)
        self.new = []

    def close(self) -> tuple:
        masks, parts, at = [], [], 0
        for k, (formatted, start, end, role, _) in enumerate(self.repeated + self.new):
            if k >= len(self.repeated) and role == "assistant":
                masks.append({"start": at + start, "end": at + end})
            parts.append(formatted)
            at += len(formatted)
        row = (
            self.conv_id,
            self.number,
            "".join(parts),
            len(self.repeated),
            masks,
            self.used,
        )
        self.number += 1
        return row


def _window_maker(budget: int, history: int, make_counter: Callable):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, state, rows = make_counter(), None, []
        for b in batches:
            ids, roles, texts = (b.column(i).to_pylist() for i in range(3))
            for conv_id, role, text in zip(ids, roles, texts, strict=True):
                if state is None or conv_id != state.conv_id:
                    if state is not None:
                        rows.append(state.close())
                    state = _Conversation(conv_id, budget, history)
                if (closed := state.add(role or "", text or "", count)) is not None:
                    rows.append(closed)
                if len(rows) >= 256:
                    yield _batch(rows)
                    rows = []
        if state is not None:
            rows.append(state.close())
        if rows:
            yield _batch(rows)

    return windows


def _batch(rows: list[tuple], schema: pa.Schema = _WINDOW_ARROW) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)


def chat_windows(
    conversations: DataFrame,
    budget: int = 2048,
    history: int = 256,
    tokenizer_path: str | None = None,
) -> DataFrame:
    """conv_id, window, text, repeated (turns shown again), masks (spans of the text that count in
    the loss), tokens. One shuffle by conversation; turns stream through in order, so a task holds
    one window, however long a conversation is."""
    bounded_batches(conversations.sparkSession)
    turns = (
        conversations.select("conv_id", "role", "text", "turn")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.col("conv_id").cast("long"), "role", "text")
    )
    return turns.mapInArrow(_window_maker(budget, history, token_counter(tokenizer_path)), WINDOWS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)
_DIGEST_ARROW = pa.schema(
    [
        (name, pa.int64() if kind == "long" else pa.string())
        for name, kind in (x.split() for x in DIGESTS.split(", "))
    ]
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation from its formatted windows alone, as they stream by."""
    rows, state = [], None

    def finish(s):
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6])

    for b in batches:
        for w in b.to_pylist():
            if state is None or w["conv_id"] != state[0]:
                if state is not None:
                    rows.append(finish(state))
                state = [w["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            state[5] += len(w["text"])
            state[6] += 1
            for role, text, _, _ in read_turns(w["text"])[w["repeated"] :]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for m in w["masks"]:
                loss = unescape(w["text"][m["start"] : m["end"]])
                state[3] += len(loss)
                state[4].update(loss.encode("utf-8", "surrogatepass"))
    if state is not None:
        rows.append(finish(state))
    if rows:
        yield _batch(rows, _DIGEST_ARROW)


def window_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from the windows of ``chat_windows``, which come
    partitioned by conversation and in order."""
    return windows.mapInArrow(_read_back, DIGESTS)
