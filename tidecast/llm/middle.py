"""Fill-in-middle transformation by secondary-sort assembly.

A text is cut into units (lines), two seeded cuts make a prefix, a middle and a suffix, and the
three are put out in the order of a form with sentinels between them: ``plain`` is the text,
``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle.

No task needs a whole output. The first step emits pieces of whole units of at most ``chunk`` bytes
(a longer unit is cut) keyed by document and place in the output; one shuffle with a sort inside
the partitions brings the pieces of a document together in output order (the DataFrame form of
``repartitionAndSortWithinPartitions``), and they stream into a running digest. The same pass reads
the output back, knowing the form alone: it looks for the sentinels, takes them out and emits what
lies between keyed by its place in the text. As a document stays in its partition, putting it back
is a second sort there and no second shuffle; the restored pieces stream into the second digest.
The key is the row, so a hot source or a thousand copies are dealt out like other rows.

Defined cases: a null text is an empty text; an empty text, and one that holds a sentinel, are
plain (null counts of characters); a null id is cut by the hash of the seed alone; repeated rows
are transformed each, alike; units of any length; texts of any number of units; other columns are
ignored; an empty table gives an empty result. Rows are told apart by their place in the input, so
the input is to be read in a stable order, as a table is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import bounded_batches

CHUNK = 1 << 16
BATCH = 8 << 20

#: Pieces in output order. Place -1 is the row's head: it has the counts and no bytes.
PIECES = (
    "row long, place int, doc_id long, form string, n long, prefix_chars long, middle_chars long,"
    " data binary"
)
#: Pieces in the order of the text; the head also has the digest of the output.
RESTORED = (
    "row long, part int, place int, doc_id long, form string, n long, prefix_chars long,"
    " middle_chars long, output_sha256 string, data binary"
)
DIGESTS = (
    "row long, doc_id long, n long, form string, prefix_chars long, middle_chars long,"
    " output_sha256 string, restored_sha256 string"
)


@dataclass(frozen=True)
class Middle:
    """What is cut and how: percentages of cut documents and, among them, of the form spm."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    sentinels: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    chunk: int = CHUNK

    def marks(self) -> dict[str, bytes]:
        return {k: s.encode() for k, s in zip("PSM", self.sentinels, strict=True)}


#: Order of the parts in the output, by form, and their order in the text.
ORDERS = {"plain": "T", "psm": "PSM", "spm": "SPM"}
TEXT_ORDER = {"T": 0, "P": 0, "M": 1, "S": 2}


def hashes(seed: int, doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of the hash of seed and id."""
    of = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    digest = hashlib.sha256(of).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def unit_ends(raw: bytes) -> np.ndarray:
    """Where each line ends, line break included."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    return ends if raw.endswith(b"\n") or not raw else np.append(ends, len(raw))


def code_points(raw: bytes) -> int:
    return int(((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80).sum())


def plan(raw: bytes, doc_id: int | None, how: Middle) -> tuple[str, np.ndarray, int, int]:
    """Form, unit ends and the bytes before which prefix and middle end."""
    ends = unit_ends(raw)
    h1, h2, h3, h4 = hashes(how.seed, doc_id)
    if not raw or h3 % 100 >= how.rate or any(m in raw for m in how.marks().values()):
        return "plain", ends, 0, 0
    low, high = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    starts = np.concatenate([[0], ends])
    return "spm" if h4 % 100 < how.spm else "psm", ends, int(starts[low]), int(starts[high])


def chunks(raw: bytes, ends: np.ndarray, lo: int, hi: int, size: int) -> Iterator[bytes]:
    """``raw[lo:hi]`` in pieces of whole units, as many as fit into ``size`` bytes."""
    while lo < hi:
        at = int(np.searchsorted(ends, lo + size, side="right")) - 1
        cut = int(ends[at]) if at >= 0 else 0
        cut = min(hi, cut if cut > lo else lo + size)
        yield raw[lo:cut]
        lo = cut


class _Rows:
    """Collects rows into record batches of bounded size."""

    def __init__(self, ddl: str, limit: int = BATCH):
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        self.schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(","))])
        self.rows, self.size, self.limit = [], 0, limit

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= self.limit:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _cutter(how: Middle):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, marks = _Rows(PIECES), how.marks()
        for b in batches:
            for row, doc_id, raw in zip(*(b.column(k) for k in range(3)), strict=True):
                row, doc_id, raw = row.as_py(), doc_id.as_py(), raw.as_py() or b""
                form, ends, low, high = plan(raw, doc_id, how)
                spans = {"T": (0, len(raw)), "P": (0, low), "M": (low, high), "S": (high, len(raw))}
                counts = (None, None)
                if form != "plain":
                    counts = (code_points(raw[:low]), code_points(raw[low:high]))
                yield from out.add((row, -1, doc_id, form, len(ends), *counts, None), 0)
                place = 0
                for part in ORDERS[form]:
                    lead = marks.get(part, b"")
                    for data in chunks(raw, ends, *spans[part], how.chunk):
                        data, lead = lead + data, b""
                        yield from out.add((row, place, *[None] * 5, data), len(data))
                        place += 1
                    if lead:
                        yield from out.add((row, place, *[None] * 5, lead), len(lead))
                        place += 1
        yield from out.rest()

    return cut


class Reader:
    """Takes the sentinels of a form out of a streamed output and tells the part of each piece."""

    def __init__(self, form: str, marks: dict[str, bytes]):
        self.parts = list(ORDERS[form])
        self.marks, self.held = marks, b""
        self.part = self.parts.pop(0) if form == "plain" else None

    def feed(self, data: bytes) -> Iterator[tuple[str, bytes]]:
        self.held += data
        while self.parts:
            mark = self.marks[self.parts[0]]
            at = self.held.find(mark)
            if at < 0:  # the end may be the beginning of the sentinel
                keep = len(mark) - 1
                done, self.held = self.held[: max(0, len(self.held) - keep)], self.held[-keep:]
                if done:
                    yield self.part, done
                return
            if at:
                yield self.part, self.held[:at]
            self.held, self.part = self.held[at + len(mark) :], self.parts.pop(0)
        if self.held:
            yield self.part, self.held
            self.held = b""

    def end(self) -> Iterator[tuple[str, bytes]]:
        if self.held:
            yield self.part, self.held


def _assembler(how: Middle):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in output order: digest of the output, pieces keyed by their place in the text."""
        out, marks = _Rows(RESTORED), how.marks()
        head = reader = digest = None
        place = 0

        def emit(found):
            nonlocal place
            for part, data in found:
                key = (head[0], TEXT_ORDER[part], place)
                place += 1
                yield from out.add((*key, *[None] * 6, data), len(data))

        def close():
            if head:
                yield from emit(reader.end())
                yield from out.add((head[0], -1, 0, *head[2:7], digest.hexdigest(), None), 64)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[1] < 0:
                    yield from close()
                    head, digest, place = row, hashlib.sha256(), 0
                    reader = Reader(row[3], marks)
                else:
                    digest.update(row[7])
                    yield from emit(reader.feed(row[7]))
        yield from close()
        yield from out.rest()

    return assemble


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of the text: one row per document with both digests."""
    out = _Rows(DIGESTS)
    head = digest = None

    def close():
        if head:
            row, doc_id, form, n, prefix, middle, made = (*head[:1], *head[3:9])
            both = (made, digest.hexdigest())
            yield from out.add((row, doc_id, n, form, prefix, middle, *both), 256)

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[1] < 0:
                yield from close()
                head, digest = row, hashlib.sha256()
            else:
                digest.update(row[9])
    yield from close()
    yield from out.rest()


def middle_pieces(docs: DataFrame, how: Middle = Middle(), text: str = "text") -> DataFrame:
    """Pieces of all outputs: those of a row in one partition and in output order, after a row
    (``place`` -1) with its form and counts."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(text).cast("binary").alias("raw"),
    )
    pieces = rows.mapInArrow(_cutter(how), PIECES)
    return pieces.repartition("row").sortWithinPartitions("row", "place")


def middle_digests(pieces: DataFrame, how: Middle = Middle()) -> DataFrame:
    """One row per document: id, counts, form, digests of the output and of the restored text."""
    back = pieces.mapInArrow(_assembler(how), RESTORED)
    return back.sortWithinPartitions("row", "part", "place").mapInArrow(_restore, DIGESTS)


def middle_texts(pieces: DataFrame) -> DataFrame:
    """row, doc_id, form, output: the whole outputs, for texts that fit into a row."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows("row long, doc_id long, form string, output string")
        head, parts = None, []

        def close():
            if head:
                made = b"".join(parts)
                yield from out.add((head[0], head[2], head[3], made.decode()), len(made))

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[1] < 0:
                    yield from close()
                    head, parts = row, []
                else:
                    parts.append(row[7])
        yield from close()
        yield from out.rest()

    return pieces.mapInArrow(join, "row long, doc_id long, form string, output string")


def restored(output: str, form: str, how: Middle = Middle()) -> str:
    """The text of one whole output, from the output and its form alone."""
    reader = Reader(form, how.marks())
    found = [*reader.feed(output.encode()), *reader.end()]
    found.sort(key=lambda x: TEXT_ORDER[x[0]])
    return b"".join(data for _, data in found).decode()
