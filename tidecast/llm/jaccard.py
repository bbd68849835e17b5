"""N-gram Jaccard join with set-relation skipping.

A document's set holds the hashes of its distinct word shingles. Equal sets are one class from the
start. Then, in this order:

* Relations first. Every set looks for one close relative, the most ordinary set it shares a
  minimum hash with, and the overlap of the two is counted. Sets that such links join have their
  answers from them: they are in one component, and none of their pairs is looked at again.
* Index lists for everything else. Tokens are ordered from rare to frequent and the first
  ``n - ceil(t n) + 1`` tokens of a set are indexed with their positions, so linked sets share an
  indexed token. A list is cut into blocks by position; a block whose best position cannot leave
  enough tokens for the required overlap is skipped, and so is a pair whose sets are related or
  have the same token before this one, as the list of that token has the pair already.
* The remaining pairs are first bounded by parity bitmaps (about one bit a token, whose differences
  are differences of the sets) and then decided by their exact overlap.

Frequency is counted over all documents: stretches of four million tokens report the tokens they
hold more than once, and the sums order the ``FREQUENT`` most frequent tokens last, which is all
that is broadcast (1.2 MB). A token in a share of 1/4000 of the documents or more does not escape
that; the order only decides how many candidates there are, never the result. Lists that may hold
more than a 256th of the documents are dealt over tiles of a salt.

Only components and classes are returned, never all pairs of a class.

Defined cases: null, empty and blank texts have an empty set, are linked with nothing and are their
own component; fewer words than a shingle make one shingle; repeated rows and equal sets are in one
component; a null id is never the smallest of a component unless all are null; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.common import bounded_batches, materialize
from tidecast.llm.components import components

FREQUENT = 1 << 17
LEAST_COUNT = 16
STRETCH = 1 << 22
MIN_HASHES = 4
TILES = 8
SMALL_LIST = 48
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)
_REMEMBERED = 400_000


#: Random values of bytes (those of A-Z are those of a-z) and the powers that place them: the hash
#: of a word is the sum of its bytes' values times the powers of their places in the word.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_VALUES = np.random.default_rng(20_024).integers(0, 1 << 64, 256, dtype=np.uint64)[_FOLD]
_SOLID = np.ones(256, dtype=bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Places:
    """Powers of the base and of its inverse (modulo 2^64), as many as the longest block needs."""

    def __init__(self):
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def need(self, n: int) -> None:
        if n > len(self.up):
            size = max(_BLOCK, 1 << (n - 1).bit_length())
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)


def _block_hashes(codes: np.ndarray, places: _Places) -> np.ndarray:
    n = len(codes)
    places.need(n)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = _SOLID[codes]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[codes] * places.up[:n], out=sums[1:])
    starts, ends = edges[::2], edges[1::2]
    return (sums[ends] - sums[starts]) * places.down[starts]


def word_hashes(raw: bytes, places: _Places) -> np.ndarray:
    """64-bit hashes of all words of a text, in order; blocks end between words."""
    codes = np.frombuffer(raw, dtype=np.uint8)
    if len(codes) <= _BLOCK:
        return _block_hashes(codes, places)
    found, lo = [], 0
    while lo < len(codes):
        hi, size = len(codes), _BLOCK
        while lo + size < len(codes):
            blank = np.flatnonzero(~_SOLID[codes[lo : lo + size]])
            if len(blank):
                hi = lo + int(blank[-1]) + 1
                break
            size *= 2  # one word is longer than the block
        found.append(_block_hashes(codes[lo:hi], places))
        lo = hi
    return np.concatenate(found)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text. It keeps no words: a worker that is used
    again by other work holds nothing of the texts it has seen."""

    def __init__(self, words: int):
        self.words = words
        self.places = _Places()

    def __call__(self, text: str | None) -> np.ndarray:
        h = word_hashes((text or "").encode("utf-8", "surrogatepass"), self.places)
        if not len(h):
            return h
        if len(h) < self.words:
            whole = xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h))
            return np.array([whole], dtype=np.uint64)
        n = len(h) - self.words + 1
        mixed = np.full(n, 0x27D4EB2F165667C5, dtype=np.uint64)
        for k in range(self.words):
            mixed = (mixed ^ h[k : k + n]) * _MULTIPLIERS[0]
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def set_id(tokens: np.ndarray) -> int:
    """64-bit signed id of a whole set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _columns(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))])


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


SIZED = "kind int, doc_id long, sid long, n long"
SKETCHED = "sid long, n int, rare int, mins binary, bits binary, prefix binary, hot binary"


class Repeats:
    """Collects tokens into one array and tells which come more than once, and how often. The array
    is sorted in place and used again, so a worker holds it once and no copies."""

    def __init__(self, size: int = STRETCH):
        self.tokens, self.size = np.empty(size, dtype=np.uint64), 0

    def add(self, tokens: np.ndarray) -> bool:
        """False if there is no room for them before what is held is taken out."""
        if self.size and self.size + len(tokens) > len(self.tokens):
            return False
        if len(tokens) > len(self.tokens):
            self.tokens = np.empty(len(tokens), dtype=np.uint64)
        self.tokens[self.size : self.size + len(tokens)] = tokens
        self.size += len(tokens)
        return True

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, counts) of what is held more than once; nothing is held afterwards."""
        held, self.size = self.tokens[: self.size], 0
        held.sort()
        same = np.flatnonzero(held[1:] == held[:-1])
        first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
        counts = np.diff(first, append=len(same)) + 1
        return held[same[first]], counts


def _sized(words: int):
    schema = _columns(SIZED)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per document (kind 0), and tokens that occur again in a stretch (kind 1)."""
        shingles, seen, held = Shingler(words), set(), Repeats()

        def again():
            tokens, counts = held.take()
            k = len(tokens)
            kinds = np.ones(k, np.int32)
            return _batch(schema, kinds, [None] * k, tokens.view(np.int64), counts)

        for b in batches:
            ids, sizes = [], []
            for text in b.column(1).to_pylist():
                tokens = shingles(text)
                sizes.append(len(tokens))
                ids.append(set_id(tokens))
                if ids[-1] not in seen:  # equal sets count once, as they are compared once
                    if len(seen) < _REMEMBERED:
                        seen.add(ids[-1])
                    if not held.add(tokens):
                        yield again()
                        held.add(tokens)
            yield _batch(schema, np.zeros(len(ids), np.int32), b.column(0), ids, sizes)
        if held.size:
            yield again()

    return sized


def parity_bits(tokens: np.ndarray) -> bytes:
    """One bit per range of hashes, set if the set has an odd number of tokens there; as many
    ranges as tokens, rounded up to a power of two (at least 64)."""
    power = max(6, int(len(tokens) - 1).bit_length())
    at = (tokens >> np.uint64(64 - power)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=1 << power) & 1).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the tokens that only one of two sets has, from their parity bits."""
    a, b = sorted((np.unpackbits(np.frombuffer(z, dtype=np.uint8)) for z in (x, y)), key=len)
    while len(b) > len(a):
        b = b[0::2] ^ b[1::2]
    return int((a ^ b).sum())


def _sketched(words: int, percent: int, shared):
    """Per distinct set of a task: size, rare tokens, minimum hashes, bits and indexed tokens."""
    schema = _columns(SKETCHED)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(words), set()
        frequent, levels = shared.value
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                tokens = shingles(text)
                if not len(tokens) or (sid := set_id(tokens)) in seen:
                    continue
                if len(seen) < _REMEMBERED:
                    seen.add(sid)
                at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                level = np.where(frequent[at] == tokens, levels[at], 0).astype(np.uint8)
                keep = prefix_length(len(tokens), percent)
                order = np.argsort(level, kind="stable")[:keep]  # tokens are sorted by hash
                mins = [(tokens * m).min() for m in _MULTIPLIERS[:MIN_HASHES]]
                rows.append(
                    (
                        sid,
                        len(tokens),
                        int((level == 0).sum()),
                        np.array(mins, dtype="<u8").tobytes(),
                        parity_bits(tokens),
                        tokens[order].astype("<u8").tobytes(),
                        level[order].tobytes(),
                    )
                )
            if rows:
                yield _batch(schema, *zip(*rows, strict=True))

    return sketch


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimum hashes of each set as rows."""
    schema = _columns("sid long, n int, rare int, place int, value long")
    for b in batches:
        d = b.to_pydict()
        k = len(d["sid"])
        if k:
            mins = np.frombuffer(b"".join(d["mins"]), dtype="<i8")
            yield _batch(
                schema,
                *(np.repeat(d[c], MIN_HASHES) for c in ("sid", "n", "rare")),
                np.tile(np.arange(MIN_HASHES, dtype=np.int32), k),
                mins,
            )


def relatives(sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each set at most one other set, that with the most equal minimum hashes among
    the most ordinary (fewest rare tokens) sets of each hash."""
    mins = sketches.select("sid", "n", "rare", "mins").mapInArrow(
        _exploded, "sid long, n int, rare int, place int, value long"
    )
    best = materialize(
        mins.groupBy("place", "value")
        .agg(F.min(F.struct("rare", "sid", "n")).alias("best"), F.count("*").alias("size"))
        .where("size > 1")
        .select(
            "place", "value", F.col("best.sid").alias("b"), F.col("best.n").alias("bn")
        ),
        "jaccard-best",
    )
    close = F.least("n", "bn") * 100 >= F.greatest("n", "bn") * percent
    close &= F.col("sid") != F.col("b")
    return (
        mins.join(best, ["place", "value"])
        .where(close)
        .groupBy("sid", "b")
        .agg(F.count("*").alias("same"))
        .groupBy("sid")
        .agg(F.max(F.struct("same", "b")).alias("best"))
        .select(F.col("sid").alias("a"), F.col("best.b").alias("b"))
    )


POSTINGS = "token long, tile int, sid long, n int, place int, star long, before long"


def _postings(batches: Iterator[pa.RecordBatch], tiled: int) -> Iterator[pa.RecordBatch]:
    """Indexed tokens with positions; those of level ``tiled`` or more go to every tile of the
    set's salt."""
    schema = _columns(POSTINGS)
    for b in batches:
        d = b.to_pydict()
        if not d["sid"]:
            continue
        length = np.array([len(h) for h in d["hot"]])
        row = np.repeat(np.arange(len(length)), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        token = np.frombuffer(b"".join(d["prefix"]), dtype="<i8")
        before = np.concatenate([token[:1], token[:-1]])
        before[place == 0] = np.array(d["sid"])  # the first token of a set has none before it
        hot = np.frombuffer(b"".join(d["hot"]), dtype=np.uint8) >= tiled
        tile = np.zeros(len(row), dtype=np.int32)
        if hot.any():
            salt = np.array(d["sid"])[row] % TILES
            at = np.flatnonzero(hot)
            others = np.tile(np.arange(TILES), len(at))
            own = np.repeat(salt[at], TILES)
            low, high = np.minimum(own, others), np.maximum(own, others)
            cold = np.flatnonzero(~hot)
            tile = np.concatenate([tile[cold], 1 + low * TILES + high]).astype(np.int32)
            pick = np.concatenate([cold, np.repeat(at, TILES)])
            row, place, token, before = row[pick], place[pick], token[pick], before[pick]
        sid, n, star = (np.array(d[c])[row] for c in ("sid", "n", "star"))
        for lo in range(0, len(row), 1 << 18):
            s = slice(lo, lo + (1 << 18))
            yield _batch(schema, token[s], tile[s], sid[s], n[s], place[s], star[s], before[s])


def _passing(percent: int, n, left, star, salt, tile, before, i, j) -> np.ndarray:
    """Which pairs (i, j) of one list may be linked, are not related and are new."""
    a, b = n[i], n[j]
    need = -(-percent * (a + b) // (100 + percent))  # least overlap that reaches the threshold
    ok = (np.minimum(left[i], left[j]) >= need) & (star[i] != star[j])
    ok &= before[i] != before[j]
    one_salt = (tile[i] == 0) | (salt[i] != salt[j]) | (tile[i] == 1 + salt[i] * (TILES + 1))
    return ok & one_salt


def list_pairs(percent: int, token, tile, sid, n, place, star, before) -> np.ndarray:
    """Distinct pairs (a < b) of sets from whole lists, sorted by token, tile and n."""
    left, salt = n - place, sid % TILES
    first = np.flatnonzero(
        np.concatenate([[True], (token[1:] != token[:-1]) | (tile[1:] != tile[:-1])])
    )
    last = np.append(first[1:], len(token))
    size = last - first
    args = (percent, n, left, star, salt, tile, before)
    found = [np.empty((0, 2), dtype=np.int64)]

    def keep(i, j):
        ok = _passing(*args, i, j)
        a, b = sid[i[ok]], sid[j[ok]]
        other = a != b
        a, b = a[other], b[other]
        if len(a):
            found.append(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))

    end = np.repeat(last, size)
    small = np.repeat(size <= SMALL_LIST, size)
    i = np.flatnonzero(small)
    for step in range(1, SMALL_LIST):  # each entry with the one ``step`` behind it
        i = i[i + step < end[i]]
        if not len(i):
            break
        keep(i, i + step)
    for lo, hi in zip(first[size > SMALL_LIST], last[size > SMALL_LIST], strict=True):
        blocks = [np.arange(x, min(x + 256, hi)) for x in range(lo, hi, 256)]
        best = [left[x].max() for x in blocks]
        for p, x in enumerate(blocks):
            for q in range(p, len(blocks)):
                y = blocks[q]
                if n[y[0]] * percent > n[x[-1]] * 100:
                    break  # sizes only grow from here
                need = -(-percent * (n[x[0]] + n[y[0]]) // (100 + percent))
                if min(best[p], best[q]) < need:
                    continue  # no position in these blocks leaves enough tokens
                i, j = np.repeat(x, len(y)), np.tile(y, len(x))
                if p == q:
                    i, j = i[i < j], j[i < j]
                keep(i, j)
        if sum(map(len, found)) > 1 << 20:
            found = [np.unique(np.concatenate(found), axis=0)]
    return np.unique(np.concatenate(found), axis=0)


def _candidates(percent: int):
    schema = _columns("a long, b long")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lists come sorted; the list that a buffer ends in is kept for the next one."""
        parts, rows, held = [], 0, 0

        def closed(final: bool):
            nonlocal parts, rows, held
            d = [np.concatenate(x) for x in zip(*parts, strict=True)]
            open_list = (d[0] == d[0][-1]) & (d[1] == d[1][-1])
            cut = len(d[0]) if final else int(np.argmax(open_list))
            parts, rows = [[x[cut:] for x in d]], len(d[0]) - cut
            held = rows
            out = list_pairs(percent, *(x[:cut] for x in d)) if cut else []
            if len(out):
                yield _batch(schema, out[:, 0], out[:, 1])

        for b in batches:
            if b.num_rows:
                parts.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
                rows += b.num_rows
                if rows - held >= max(1 << 18, held):
                    yield from closed(final=False)
        if rows:
            yield from closed(final=True)

    return pairs


def id_filter(ids: DataFrame, column: str, bits: int = 1 << 25) -> np.ndarray:
    """A packed bit filter of long ids with a fixed size (4 MB); hits may be false."""
    page = 1 << 15

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _columns("page int, at binary")
        at = [np.empty(0, dtype=np.int64)]
        for b in batches:
            at.append(np.unique(b.column(0).to_numpy(zero_copy_only=False) & (bits - 1)))
        at = np.unique(np.concatenate(at))
        for p in np.unique(at // page):
            own = (at[at // page == p] % page).astype("<u2").tobytes()
            yield _batch(schema, [p], [own])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _columns("page int, bits binary")
        now, found = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["page"] != now:
                    if now is not None:
                        yield _batch(schema, [now], [np.packbits(found, bitorder="little").tobytes()])
                    now, found = r["page"], np.zeros(page, dtype=bool)
                found[np.frombuffer(r["at"], dtype="<u2")] = True
        if now is not None:
            yield _batch(schema, [now], [np.packbits(found, bitorder="little").tobytes()])

    pages = (
        ids.select(column)
        .mapInArrow(mark, "page int, at binary")
        .repartition("page")
        .sortWithinPartitions("page")
        .mapInArrow(merge, "page int, bits binary")
        .collect()
    )
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for r in pages:
        packed[r["page"] * page // 8 :][: page // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return packed


def _sets_of(words: int, shared):
    schema = _columns("sid long, tokens binary")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole sets of the documents that the filter lets through, each once per task."""
        shingles, seen, packed = Shingler(words), set(), shared.value
        last = len(packed) * 8 - 1
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                tokens = shingles(text)
                sid = set_id(tokens)
                at = sid & last
                if len(tokens) and packed[at >> 3] >> (at & 7) & 1 and sid not in seen:
                    if len(seen) < _REMEMBERED:
                        seen.add(sid)
                    rows.append((sid, tokens.astype("<u8").tobytes()))
            if rows:
                yield _batch(schema, *zip(*rows, strict=True))

    return sets


def _overlaps(percent: int):
    schema = _columns("a long, b long")

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (b, salt, a), the set b itself (a null) first: one set is held."""
        right, key = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                tokens = np.frombuffer(r["tokens"], dtype="<u8")
                if r["a"] is None:
                    right, key = tokens, r["b"]
                    continue
                if key != r["b"]:
                    raise RuntimeError("a pair came without its second set")
                both = len(np.intersect1d(tokens, right, assume_unique=True))
                if 100 * both >= percent * (len(tokens) + len(right) - both):
                    rows.append((r["a"], r["b"]))
            if rows:
                yield _batch(schema, *zip(*rows, strict=True))

    return overlaps


def _bounded(percent: int):
    schema = _columns("a long, b long")

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose parity bits do not rule them out."""
        for b in batches:
            rows = []
            for a, other, n, m, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                need = -(-percent * (n + m) // (100 + percent))
                if least_difference(x, y) <= n + m - 2 * need:
                    rows.append((a, other))
            if rows:
                yield _batch(schema, *zip(*rows, strict=True))

    return bounded


def linked_pairs(
    docs: DataFrame,
    sketches: DataFrame,
    pairs: DataFrame,
    words: int,
    percent: int,
    salts: int = 16,
) -> DataFrame:
    """The pairs (a, b) of set ids whose sets reach the threshold, by exact overlap."""
    spark = docs.sparkSession
    one = sketches.select(F.col("sid").alias("a"), F.col("n").alias("an"), F.col("bits").alias("x"))
    two = sketches.select(F.col("sid").alias("b"), F.col("n").alias("bn"), F.col("bits").alias("y"))
    pairs = materialize(
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", "an", "bn", "x", "y")
        .mapInArrow(_bounded(percent), "a long, b long"),
        "jaccard-bounded",
    )
    ids = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid")))
    shared = spark.sparkContext.broadcast(id_filter(ids, "sid"))
    sets = docs.select("text").mapInArrow(_sets_of(words, shared), "sid long, tokens binary")
    sets = materialize(
        sets.groupBy("sid").agg(F.first("tokens").alias("tokens")), "jaccard-sets"
    )
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(salts)).cast("int"))
    left = salted.join(sets.withColumnRenamed("sid", "a"), "a").select("b", "salt", "a", "tokens")
    right = (
        salted.select("b", "salt")
        .distinct()
        .join(sets.withColumnRenamed("sid", "b"), "b")
        .select("b", "salt", F.lit(None).cast("long").alias("a"), "tokens")
    )
    rows = left.unionByName(right).repartition("b", "salt").sortWithinPartitions("b", "salt", "a")
    return materialize(rows.mapInArrow(_overlaps(percent), "a long, b long"), "jaccard-linked")


def _level(count: int) -> int:
    """Place of a frequent token in the order: four steps per doubling."""
    return min(250, int(np.log2(count) * 4))


def _set_components(docs: DataFrame, sized: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of the set ids that are linked."""
    found = (
        sized.where("kind = 1")
        .groupBy(F.col("sid").alias("token"))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
        .orderBy(F.desc("n"), "token")
        .limit(FREQUENT)
        .collect()
    )
    frequent = np.array([r["token"] for r in found] + [0], dtype=np.int64).view(np.uint64)
    levels = np.array([_level(r["n"]) for r in found] + [0], dtype=np.uint8)
    order = np.argsort(frequent, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], levels[order]))
    tiled = _level(max(4096, sized.where("kind = 0").count() // 256))
    sketches = docs.select("text").mapInArrow(_sketched(words, percent, shared), SKETCHED)
    others = [c for c in (x.split()[0] for x in SKETCHED.split(", ")) if c != "sid"]
    sketches = materialize(
        sketches.groupBy("sid").agg(F.first(F.struct(*others)).alias("s")).select("sid", "s.*"),
        "jaccard-sketches",
    )
    near = materialize(relatives(sketches, percent), "jaccard-relatives")
    stars = linked_pairs(docs, sketches, near, words, percent)
    star_of = components(stars, "a", "b").select(
        F.col("node").alias("sid"), F.col("component").alias("star")
    )
    star_of = materialize(star_of, "jaccard-stars")
    indexed = sketches.join(star_of, "sid", "left").select(
        "sid", "n", "prefix", "hot", F.coalesce("star", "sid").alias("star")
    )
    lists = (
        indexed.mapInArrow(lambda b: _postings(b, tiled), POSTINGS)
        .repartition("token", "tile")
        .sortWithinPartitions("token", "tile", "n")
    )
    found = lists.mapInArrow(_candidates(percent), "a long, b long").distinct()
    found = materialize(found, "jaccard-candidates")
    cross = linked_pairs(docs, sketches, found, words, percent)
    return components(stars.union(cross), "a", "b")


def _named_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, sid, n and component_id of every document."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sized = materialize(docs.mapInArrow(_sized(words), SIZED), "jaccard-sized")
    groups = _set_components(docs, sized, words, percent)
    rows = sized.where("kind = 0")
    classes = (
        rows.where("n > 0")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("low"))
        .join(groups.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("component", F.coalesce("component", "sid"))
    )
    classes = materialize(classes, "jaccard-classes")
    lowest = materialize(
        classes.groupBy("component").agg(F.min("low").alias("component_id")), "jaccard-lowest"
    )
    named = materialize(
        classes.join(lowest, "component").select("sid", "component_id"), "jaccard-named"
    )
    return rows.join(named, "sid", "left").select(
        "doc_id", "sid", "n", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return _named_components(docs, words, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns.

    Rows that repeat both an id and a set are one document and stay or go together.
    """
    named = _named_components(docs, words, percent)
    gone = (
        named.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("__id"), F.col("sid").alias("__set"))
        .distinct()
    )

    @F.pandas_udf(T.LongType())
    def set_of(texts: pd.Series) -> pd.Series:
        shingles = Shingler(words)
        return pd.Series([set_id(shingles(t)) for t in texts], dtype="int64")

    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (set_of("text") == F.col("__set"))
    return docs.join(materialize(gone, "jaccard-gone"), same, "left_anti")
