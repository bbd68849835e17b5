"""Packing documents into training sequences by order-preserving dynamic programming.

Documents keep the order in which a task reads them; their ids, each closed by an end id, form a
stream. Candidate cuts are document ends (free), sentence ends (a small penalty) and, inside long
stretches without either, a regular grid (a larger penalty). ``cost[j]``, the least padding plus
penalties of a packing that ends at cut j, is the minimum over the earlier cuts i no further than
``width`` ids away of ``cost[i] + position[i]``, kept in a monotone queue, plus ``width -
position[j]``; a window whose length is a power of two needs no padding and is tried as well. The
stream is solved in stretches; the last window of a stretch is left open and carried on.

Ids are those of the byte-level BPE file. Chunks between single spaces are independent of each
other under its splitting rule, so their ids are kept in a bounded table and looked up; texts with
other spacing are encoded whole, and texts that contain a special token by the file itself.

Defined cases: a null text is empty and has the end id alone; repeated rows are packed each; ids
of any length are split over sequences; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidecast.llm.common import bounded_batches

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in PIECES.split(", ")])

# How this vocabulary splits text, and its special token.
_SPECIAL = "<|endoftext|>"
_OTHER_SPACE = re.compile(r"[^\S \n]")
_SENTENCE_ENDS = (".", "!", "?", "\n", "\n\n", "!!")

_LOADED: dict[tuple, BpeTokenizer] = {}


class BpeTokenizer:
    """Ids of the byte-level BPE in ``json_path``; ``ranks_path`` holds the same vocabulary."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str, remember: int = 150_000):
        import tiktoken

        self.json_path, self._whole = json_path, None
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding(
            "bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, bytes] = {}
        self.remember = remember
        size = max(ranks.values()) + 2
        self.ends = np.zeros(size, dtype=bool)
        for mark in _SENTENCE_ENDS:
            ids = self.plain.encode_ordinary(mark)
            if len(ids) == 1:
                self.ends[ids[0]] = True

    @property
    def whole(self):
        """The tokenizer of the JSON file, loaded for the first text with a special token."""
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.json_path)
        return self._whole

    def _bytes(self, text: str) -> bytes:
        return np.array(self.plain.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        if _SPECIAL in text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        if "  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
            return self._bytes(text)
        known = self.known
        chunks = text.split(" ")
        found = [known.get(c) for c in chunks[1:]]
        if None in found:
            for k, c in enumerate(chunks[1:]):
                if found[k] is None:
                    found[k] = known.get(c) or self._bytes(" " + c)
                    if len(known) < self.remember and len(c) < 64:
                        known[c] = found[k]
        return self._bytes(chunks[0]) + b"".join(found)


def load_tokenizer(json_path: str, ranks_path: str, pattern: str) -> BpeTokenizer:
    """One tokenizer per worker process."""
    key = (json_path, ranks_path, pattern)
    if key not in _LOADED:
        _LOADED[key] = BpeTokenizer(*key)
    return _LOADED[key]


def choose_cuts(
    ends: np.ndarray,
    sentences: np.ndarray,
    total: int,
    width: int,
    sentence_penalty: int = 2,
    grid_penalty: int = 8,
    short_penalty: int = 16,
    grid: int = 64,
) -> tuple[list[int], list[int], list[int]]:
    """All candidate cuts, the predecessor of each in a cheapest packing, and its cost.

    ``ends`` and ``sentences`` are sorted positions of document and sentence ends in a stream of
    ``total`` ids. Position 0 is the first cut.
    """
    natural = np.union1d(np.union1d(ends, sentences), [0, total])
    gaps = np.diff(natural)
    wide = np.flatnonzero(gaps > grid)
    extra = [np.arange(natural[k] + grid, natural[k + 1], grid) for k in wide]
    cuts = np.union1d(natural, np.concatenate(extra)) if extra else natural
    penalty = np.full(len(cuts), grid_penalty)
    penalty[np.searchsorted(cuts, sentences)] = sentence_penalty
    penalty[np.searchsorted(cuts, ends)] = 0
    at, pen = cuts.tolist(), penalty.tolist()
    index = {p: k for k, p in enumerate(at)}
    powers = [1 << k for k in range(4, width.bit_length()) if 1 << k <= width]
    cost, previous = [0] * len(at), [0] * len(at)
    queue = deque([0])  # cuts whose cost + position increases
    reach = [0] * len(at)  # cost + position
    get = index.get
    for j in range(1, len(at)):
        p = at[j]
        least = p - width
        while at[queue[0]] < least:
            queue.popleft()
        i = queue[0]
        best = reach[i] + width - p + (short_penalty if p - at[i] < width else 0)
        for step in powers:
            k = get(p - step)
            if k is not None:
                c = cost[k] + (short_penalty if step < width else 0)
                if c < best:
                    best, i = c, k
        best += pen[j]
        cost[j], previous[j] = best, i
        f = best + p
        reach[j] = f
        while queue and reach[queue[-1]] >= f:
            queue.pop()
        queue.append(j)
    return at, previous, cost


class _Packer:
    """Ids not yet packed, and the documents they belong to."""

    def __init__(self, tokenizer: BpeTokenizer, width: int, end_id: int, stretch: int, first: int):
        self.tokenizer, self.width, self.stretch = tokenizer, width, stretch
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.sequence = first
        self.parts: list[bytes] = []
        self.docs: list[tuple] = []  # (doc_id, position of its first id, ids)
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> list[tuple]:
        ids = (self.tokenizer.encode(text) if text else b"") + self.end
        self.parts.append(ids)
        self.docs.append((doc_id, self.size, len(ids) // 4))
        self.size += len(ids) // 4
        return self.pack(final=False) if self.size >= self.stretch else []

    def pack(self, final: bool) -> list[tuple]:
        if not self.size:
            return []
        raw = b"".join(self.parts)
        ids = np.frombuffer(raw, dtype="<u4")
        ends = np.array([b + n for _, b, n in self.docs])
        sentences = np.flatnonzero(self.tokenizer.ends[ids]) + 1
        at, previous, cost = choose_cuts(ends, sentences, self.size, self.width)
        last = len(at) - 1
        if not final:  # leave the end open: the cheapest cut of the last window
            low = next(k for k in range(last + 1) if at[k] >= self.size - self.width)
            last = max(min(range(low, last + 1), key=cost.__getitem__), 1)
        path = []
        while last:
            path.append(last)
            last = previous[last]
        path.append(0)
        rows, cuts = [], [at[k] for k in reversed(path)]
        d = 0
        for at_first, hi in zip(cuts, cuts[1:], strict=False):
            lo = at_first
            while lo < hi:
                doc_id, begin, n = self.docs[d]
                stop = min(hi, begin + n)
                crc = zlib.crc32(raw[4 * lo : 4 * stop])
                rows.append((doc_id, lo - begin, stop - lo, crc, n, self.sequence, lo - at_first))
                if stop == begin + n:
                    d += 1
                lo = stop
            self.sequence += 1
        done = cuts[-1]
        self.parts = [raw[4 * done :]]
        self.docs = [(i, b - done, n) for i, b, n in self.docs[d:]]
        self.size -= done
        return rows


def pack_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    width: int = 2048,
    end_id: int = 1,
    stretch: int = 1 << 19,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Nothing is shuffled: each task packs the documents it reads, in order, and numbers its
    sequences from its own partition number. A task holds at most ``stretch`` ids and one text.
    """
    bounded_batches(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(
            load_tokenizer(json_path, ranks_path, pattern),
            width,
            end_id,
            stretch,
            TaskContext.get().partitionId() << 40,
        )
        for b in batches:
            rows = []
            for doc_id, text in zip(*(b.column(i).to_pylist() for i in (0, 1)), strict=True):
                rows += packer.add(doc_id, text)
            if rows:
                yield _batch(rows)
        if rows := packer.pack(final=True):
            yield _batch(rows)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(pack, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _ARROW, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_ARROW)
