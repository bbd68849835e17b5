"""Removal of repeated byte strings with a distributed sparse suffix array.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed. Strings
are never compared one by one over the corpus; the work narrows down in four steps:

1. Sampling of suffixes. Every window of ``length`` bytes has one anchor, the leftmost minimum of the
   hashes of its ``LEAD``-byte grams. Anchors depend on the window alone, so equal windows have equal
   anchors, and neighbouring windows share one (about one anchor in 180 bytes). A run is the
   windows of one anchor; its leading gram and a hash of all its bytes are kept.
2. Runs whose leading gram occurs once are unique. Runs with equal bytes are repeats as a whole.
   Only runs that share a gram but not all bytes go on, one of each content.
3. Such a run is cut into blocks of up to 32 windows that share a core. The suffixes that begin at
   the cores are range-partitioned by their leading tokens with sampled splitters; every bucket is
   sorted by multikey quicksort, eight-byte token by token, only tied suffixes going on to the next
   token. Ties over the whole core are sorted on by the bytes left and right of it, window
   by window; windows that stay tied are equal.
4. A core that lies at the edge of a bucket may go on in the next one, so digests of its windows are
   compared across buckets.

Texts are shuffled only for documents that have candidate runs or repeats. Hot content is collapsed
(equal texts, runs and blocks) by partial aggregation before it is shuffled, and what is left of a
hot passage is split by the range partitioning.

Defined cases: a null text is empty; texts shorter than ``length`` keep all bytes; strings may overlap
and may repeat inside one document; equal texts of at least ``length`` bytes are removed whole; rows
with equal ids are documents of their own; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import bounded_batches, materialize
from tidecast.llm.exact import may_repeat, repeat_filter
from tidecast.llm.jaccard import id_filter

LEAD = 32
BLOCK = 32
TOKEN = 8
_CHUNK = 1 << 19
_PLACE = np.uint64((1 << 24) - 1)
_TABLE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _kinds(schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()
    }
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``LEAD``-byte gram, by doubling."""
    h, width = _TABLE[codes], 1
    for step in _STEPS:
        h = h[:-width] * np.uint64(step) + h[width:]
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(_STEPS[0])
    h ^= h >> np.uint64(32)
    return h


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of each ``width`` neighbouring hashes."""
    n = len(hashes)
    key = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (low & _PLACE).astype(np.int64)


RUNS = "kind int, doc_id long, tid binary, size long, digest binary, lo long, n int, off int, key long, whole long"


def _runs(length: int):
    schema = _kinds(RUNS)
    width = length - LEAD + 1

    def of_chunk(texts: list[tuple[bytes, bytes, int]]):
        """Runs of pieces (tid, bytes, place of the piece in its text)."""
        raw = b"".join(t for _, t, _ in texts)
        codes = np.frombuffer(raw, dtype=np.uint8)
        hashes = gram_hashes(codes)
        at = anchors(hashes, width)
        sizes = np.array([len(t) for _, t, _ in texts])
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
        inside = np.arange(len(at)) <= (begin + sizes - length)[owner]
        change = np.ones(len(at), dtype=bool)
        change[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        n = np.diff(np.append(first, len(at)))
        good = inside[first]
        first, n = first[good], n[good]
        anchor, own = at[first], owner[first]
        view = memoryview(raw)
        digest = xxhash.xxh3_64_intdigest
        whole = [
            digest(view[lo:hi]) - (1 << 63)
            for lo, hi in zip(first.tolist(), (first + n + length - 1).tolist(), strict=True)
        ]
        tids = [texts[k][0] for k in own.tolist()]
        shift = np.array([p for _, _, p in texts]) - begin
        return (
            tids,
            first + shift[own],
            n,
            anchor - first,
            hashes[anchor].view(np.int64),
            whole,
        )

    def emit(texts):
        tids, lo, n, off, key, whole = of_chunk(texts)
        k = len(tids)
        empty = [None] * k
        return _batch(
            schema, [np.ones(k, np.int32), empty, tids, empty, empty, lo, n, off, key, whole]
        )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document (kind 0) and the runs of every text, once per task (kind 1)."""
        seen: set[bytes] = set()
        held, size = [], 0
        for b in batches:
            docs = []
            for text in b.column(1).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                tid = xxhash.xxh3_128_digest(raw)
                docs.append((tid, len(raw), hashlib.sha256(raw).digest()))
                if len(raw) < length or tid in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(tid)
                step = _CHUNK * 4
                for p in range(0, len(raw) - length + 1, step):
                    piece = raw[p : p + step + length - 1]
                    held.append((tid, piece, p))
                    size += len(piece)
                    if size >= _CHUNK:
                        yield emit(held)
                        held, size = [], 0
            if docs:
                none = [None] * len(docs)
                tids, sizes, digests = zip(*docs, strict=True)
                yield _batch(
                    schema,
                    [
                        np.zeros(len(docs), np.int32), b.column(0), tids, sizes, digests,
                        none, none, none, none, none,
                    ],
                )
        if held:
            yield emit(held)

    return runs


def _texts_of(shared):
    schema = _kinds("tid binary, raw binary")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes of the texts that the filter lets through, each once per task."""
        packed, seen = shared.value, set()
        last = len(packed) * 8 - 1
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                raw = (text or "").encode("utf-8", "surrogatepass")
                tid = xxhash.xxh3_128_digest(raw)
                at = int.from_bytes(tid[:8], "big") & last
                if packed[at >> 3] >> (at & 7) & 1 and tid not in seen:
                    if len(seen) < 1 << 20:
                        seen.add(tid)
                    rows.append((tid, raw))
            if rows:
                yield _batch(schema, zip(*rows, strict=True))

    return texts


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tid, raw) of the texts whose tid is in ``wanted`` (and perhaps of a few others)."""
    low = F.conv(F.substring(F.hex("tid"), 3, 14), 16, 10).cast("long")
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select(low.alias("low")), "low"))
    found = docs.select("text").mapInArrow(_texts_of(shared), "tid binary, raw binary")
    return found.groupBy("tid").agg(F.first("raw").alias("raw"))


BLOCKS = "core binary, content binary, tid binary, place long, low int, high int, suffix binary, lead binary"


def _blocks(length: int, wide: bool, test=None):
    """Blocks of candidate runs. The narrow form has only the digest of each core."""
    schema = _kinds(BLOCKS if wide else "core binary")
    core_length = length - BLOCK + 1

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = test.value if wide else None
        for b in batches:
            rows = []
            for tid, raw, runs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for run in runs:
                    anchor = run["lo"] + run["off"]
                    least, most = run["off"] - run["n"] + 1, run["off"]
                    for k in range(least // BLOCK, most // BLOCK + 1):
                        place = anchor - BLOCK * k
                        low, high = max(least - BLOCK * k, 0), min(most - BLOCK * k, BLOCK - 1)
                        core = hashlib.sha256(raw[place : place + core_length]).digest()
                        if not wide:
                            rows.append((core,))
                        elif _passes(bits, core):
                            suffix = raw[place : place - low + length]
                            lead = raw[place - high : place]
                            content = xxhash.xxh3_128_digest(
                                suffix + lead + bytes((len(suffix) & 255, low, high))
                            )
                            rows.append((core, content, tid, place, low, high, suffix, lead))
                if len(rows) >= 4096:
                    yield _batch(schema, zip(*rows, strict=True))
                    rows = []
            if rows:
                yield _batch(schema, zip(*rows, strict=True))

    return blocks


def _passes(bits: np.ndarray, digest: bytes) -> bool:
    last = len(bits) * 8 - 1
    for p in (int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:16], "little")):
        p &= last
        if not bits[p >> 3] >> (p & 7) & 1:
            return False
    return True


def multikey_ties(tokens: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort that stops early: rows tied over all tokens, and their tie numbers.

    Each pass splits the ties by one more token; rows that are alone in their tie are done.
    """
    rows = np.arange(len(tokens))
    tie = np.zeros(len(tokens), dtype=np.int64) if group is None else group
    for depth in range(-1, tokens.shape[1]):
        if depth >= 0:
            keys = tokens[rows, depth]
            order = np.lexsort((keys, tie))
            rows, tie, keys = rows[order], tie[order], keys[order]
            new = (tie[1:] != tie[:-1]) | (keys[1:] != keys[:-1])
        else:
            order = np.argsort(tie, kind="stable")
            rows, tie = rows[order], tie[order]
            new = tie[1:] != tie[:-1]
        if not len(rows):
            break
        tie = np.concatenate([[0], np.cumsum(new)])
        size = np.bincount(tie)
        stays = size[tie] > 1
        rows, tie = rows[stays], tie[stays]
    return rows, tie


def _tokens(parts: list[bytes], width: int) -> np.ndarray:
    """Big-endian eight-byte tokens of equally padded strings, one row each."""
    width = -(-width // TOKEN) * TOKEN
    raw = b"".join(p.ljust(width, b"\0") for p in parts)
    return np.frombuffer(raw, dtype=">u8").reshape(len(parts), width // TOKEN).astype(np.uint64)


def repeated_windows(
    suffixes: list[bytes], leads: list[bytes], low: np.ndarray, high: np.ndarray, length: int
) -> np.ndarray:
    """Per block of one bucket, the bits of its windows that another block has as well."""
    core = length - BLOCK + 1
    masks = np.zeros(len(suffixes), dtype=np.int64)
    rows, tie = multikey_ties(_tokens([s[:core] for s in suffixes], core))
    if not len(rows):
        return masks
    before = np.frombuffer(
        b"".join(leads[k].rjust(BLOCK, b"\0") for k in rows), dtype=np.uint8
    ).reshape(-1, BLOCK)
    after = np.frombuffer(
        b"".join(suffixes[k][core:].ljust(BLOCK, b"\0") for k in rows), dtype=np.uint8
    ).reshape(-1, BLOCK)
    for shift in range(BLOCK):  # the window that starts ``shift`` bytes before the core
        own = np.flatnonzero((low[rows] <= shift) & (shift <= high[rows]))
        around = np.concatenate([before[own], after[own]], axis=1)
        around[:, : BLOCK - shift] = 0
        around[:, BLOCK + BLOCK - 1 - shift :] = 0
        tokens = np.ascontiguousarray(around).view(">u8").astype(np.uint64)
        tied, _ = multikey_ties(tokens, tie[own])
        masks[rows[own[tied]]] |= 1 << shift
    return masks


SORTED = "kind int, content binary, mask long, digest binary"


def _bucket(length: int):
    schema = _kinds(SORTED)
    core = length - BLOCK + 1

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Masks of the bucket's blocks (kind 0), and window digests at its edges (kind 1)."""
        columns = [[], [], [], [], []]
        for b in batches:
            for held, c in zip(columns, b.columns, strict=True):
                held += c.to_pylist()
        content, suffix, lead, low, high = columns
        if not content:
            return
        masks = repeated_windows(suffix, lead, np.array(low), np.array(high), length)
        some = np.flatnonzero(masks)
        none = [None] * len(some)
        yield _batch(
            schema, [np.zeros(len(some), np.int32), [content[k] for k in some], masks[some], none]
        )
        edges = {min(s[:core] for s in suffix), max(s[:core] for s in suffix)}
        rows = []
        for k, s in enumerate(suffix):
            if s[:core] in edges:
                for shift in range(low[k], high[k] + 1):
                    window = lead[k][len(lead[k]) - shift :] + s[: length - shift]
                    rows.append((1, content[k], 1 << shift, xxhash.xxh3_128_digest(window)))
            if len(rows) >= 8192:
                yield _batch(schema, zip(*rows, strict=True))
                rows = []
        if rows:
            yield _batch(schema, zip(*rows, strict=True))

    return sort


def _window_masks(contents: DataFrame, length: int, per_bucket: int) -> DataFrame:
    """(content, mask): repeated windows of every distinct block content that has any."""
    rows = contents.count()
    buckets = max(1, -(-rows // per_bucket))
    sorted_ = materialize(
        contents.select("content", "suffix", "lead", "low", "high")
        .repartitionByRange(buckets, "suffix", "lead")
        .mapInArrow(_bucket(length), SORTED),
        "substring-sorted",
    )
    edges = sorted_.where("kind = 1")
    again = edges.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1")
    across = edges.join(materialize(again, "substring-edges"), "digest").select("content", "mask")
    return (
        sorted_.where("kind = 0")
        .select("content", "mask")
        .union(across)
        .groupBy("content")
        .agg(F.bit_or("mask").alias("mask"))
    )


def merged_spans(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal covered byte ranges, from (first start, number of starts) of repeated strings."""
    out: list[list[int]] = []
    for lo, n in sorted(starts):
        end = lo + n + length - 1
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [(a, b) for a, b in out]


CUT = "tid binary, n_removed long, n_spans long, kept_sha256 string, spans binary"


def _cut(length: int):
    schema = _kinds(CUT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for tid, raw, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
                starts = []
                for f in found:
                    if f["mask"] is None:
                        starts.append((f["lo"], f["n"]))
                    else:
                        starts += [(f["lo"] - k, 1) for k in range(BLOCK) if f["mask"] >> k & 1]
                spans, kept, at = merged_spans(starts, length), hashlib.sha256(), 0
                for lo, hi in spans:
                    kept.update(raw[at:lo])
                    at = hi
                kept.update(raw[at:])
                removed = sum(hi - lo for lo, hi in spans)
                packed = np.array(spans, dtype="<i8").tobytes()
                rows.append((tid, removed, len(spans), kept.hexdigest(), packed))
            if rows:
                yield _batch(schema, zip(*rows, strict=True))

    return cut


def repeated_spans(
    docs: DataFrame, length: int = 400, per_bucket: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): rows has doc_id, tid, size and digest of every document; cuts has, for each
    text with something to remove, tid, n_removed, n_spans, kept_sha256 and the spans as pairs of
    little-endian 64-bit byte places."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    everything = materialize(docs.mapInArrow(_runs(length), RUNS), "substring-runs")
    rows = everything.where("kind = 0").select("doc_id", "tid", "size", "digest")
    runs = everything.where("kind = 1").select("tid", "lo", "n", "off", "key", "whole")
    grams = materialize(
        runs.groupBy("key")
        .agg(F.count("*").alias("times"), (F.min("whole") == F.max("whole")).alias("same"))
        .where("times > 1")
        .select("key", "same"),
        "substring-grams",
    )
    matched = materialize(runs.join(grams, "key"), "substring-matched")
    detail = materialize(
        matched.where("not same")
        .groupBy("key", "whole")
        .agg(F.count("*").alias("times"), F.min(F.struct("tid", "lo", "n", "off")).alias("run")),
        "substring-detail",
    )
    equal = matched.where("not same").join(
        detail.where("times > 1").select("key", "whole"), ["key", "whole"], "left_semi"
    )
    whole_runs = matched.where("same").select("tid", "lo", "n").union(
        equal.select("tid", "lo", "n")
    )
    by_text = materialize(
        detail.select("run.*")
        .groupBy("tid")
        .agg(F.collect_list(F.struct("lo", "n", "off")).alias("runs")),
        "substring-candidates",
    )
    located = materialize(
        texts_of(docs, by_text).join(by_text, "tid").select("tid", "raw", "runs"),
        "substring-located",
    )
    cores = located.mapInArrow(_blocks(length, wide=False), "core binary")
    cores = materialize(cores, "substring-cores")
    bits = docs.sparkSession.sparkContext.broadcast(repeat_filter(cores, "core"))
    blocks = materialize(
        located.mapInArrow(_blocks(length, wide=True, test=bits), BLOCKS), "substring-blocks"
    )
    contents = materialize(
        blocks.groupBy("content").agg(
            F.count("*").alias("times"),
            F.first(F.struct("suffix", "lead", "low", "high")).alias("b"),
        ).select("content", "times", "b.*"),
        "substring-contents",
    )
    masks = _window_masks(contents, length, per_bucket)
    full = contents.where("times > 1").select(
        "content", F.lit((1 << BLOCK) - 1).cast("long").alias("mask")
    )
    masks = materialize(
        masks.union(full).groupBy("content").agg(F.bit_or("mask").alias("mask")),
        "substring-masks",
    )
    inside = F.expr(f"mask & (shiftleft(1L, high + 1) - shiftleft(1L, low))")
    single = (
        blocks.select("content", "tid", "place", "low", "high")
        .join(masks, "content")
        .select("tid", F.col("place").alias("lo"), F.lit(None).cast("int").alias("n"), inside.alias("mask"))
    )
    found = whole_runs.withColumn("mask", F.lit(None).cast("long")).unionByName(single)
    by_text = materialize(
        found.groupBy("tid").agg(F.collect_list(F.struct("lo", "n", "mask")).alias("found")),
        "substring-found",
    )
    cuts = texts_of(docs, by_text).join(by_text, "tid").select("tid", "raw", "found")
    return rows, materialize(cuts.mapInArrow(_cut(length), CUT), "substring-cuts")


def without_repeats(docs: DataFrame, length: int = 400, per_bucket: int = 20_000) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, cuts = repeated_spans(docs, length, per_bucket)
    copies = materialize(
        rows.where(F.col("size") >= length)
        .groupBy("tid")
        .agg(F.count("*").alias("copies"))
        .where("copies > 1"),
        "substring-copies",
    )
    found = materialize(
        cuts.drop("spans").join(copies, "tid", "full_outer"), "substring-result"
    )
    copied = F.col("copies").isNotNull()
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(found, "tid", "left").select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.when(copied, F.col("size")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.lit(nothing))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
        .alias("kept_sha256"),
    )
