"""Spelling variant grouping by k-d trees over letter-count vectors.

Words are counted over all texts (a task adds up its own words before the shuffle). One inserted,
deleted or replaced letter moves the vector of letter counts by at most one letter each way, so its
L1 distance is at most two, and with the lengths known the letters that one word has over the other
and lacks are bounded one by one. Neighbours are found by box-pruned range searches per pair of
lengths:

* A top tree per length is made on the driver from a bounded sample of the words (``SAMPLE``). Its
  leaves are cells, as many as the counted words ask for. A word is stored in the one cell of its
  vector; as a query it is sent to every cell of its own length, one less and one more, whose box
  it can reach within the bounds. Words of one vector cannot be parted by a tree: such a leaf is
  dealt over tiles by hash, and its queries go to all of them.
* In a cell, a second tree over its words answers the queries in batches. What is left at a leaf is
  compared by the counts in unary, folded into 128 bits (never above the true distance), and then
  letter by letter.

A cell reports for each query its number of neighbours and the best of them, never the pairs, so a
word with many neighbours is one row a cell. Forms are followed by pointer doubling; a form has at
least ``factor`` times the occurrences, so the rounds are bounded by the logarithm of the largest
count.

Defined cases: a null text has no words; a null id counts as an empty one in the hash; repeated
rows are counted each; words of any length (those of ``BAND`` letters or more share one tree); ties
of the best neighbour go to the smallest word in code-point order; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import bounded_batches, materialize

LETTERS = 26 + 64
BAND = 48
SAMPLE = 1 << 16
MAX_CELLS = 1 << 12
PER_CELL = 1 << 15
LEAF = 32
ROWS_AT_ONCE = 1 << 14
CANDIDATES_AT_ONCE = 1 << 19
_HELD_WORDS = 1 << 18
_LEVELS = 4
_CODES = np.full(256, 255, dtype=np.uint8)
_CODES[ord("a") : ord("z") + 1] = np.arange(26)
_CODES[0xC0:] = np.arange(26, LETTERS)
#: The bit of the k-th occurrence of a letter.
_BITS = np.stack(
    [np.eye(128, dtype=np.float32)[(np.arange(LETTERS) + 37 * k) % 128] for k in range(_LEVELS)]
)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``ROWS_AT_ONCE`` rows: searches of many words at once share their steps."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= ROWS_AT_ONCE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _counter(least_length: int, misspelt: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def batch(held: dict) -> pa.RecordBatch:
        columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = Counter(run.findall((raw.as_py() or b"").lower().decode()))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % misspelt == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= _HELD_WORDS:
                    yield batch(held)
                    held = {}
        if held:
            yield batch(held)

    return count


def word_counts(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    misspelt: int = 31,
    text: str = "text",
) -> DataFrame:
    """(word, n) of runs of letters, A-Z lowered; a run whose hash with the id is divisible by
    ``misspelt`` loses the letter that the hash points at."""
    bounded_batches(docs.sparkSession)
    # lowering bytes of UTF-8 changes A-Z alone
    raw = docs.select(F.col("doc_id").cast("string"), F.col(text).cast("binary").alias("raw"))
    return (
        raw.mapInArrow(_counter(least_length, misspelt), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all letters, one word after the other, and the lengths."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    return _CODES[np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)], lengths


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of counts per word; above 255 a count stays there, which only shortens distances."""
    codes, lengths = letter_codes(words)
    at = np.repeat(np.arange(len(words)), lengths) * LETTERS + codes
    counts = np.bincount(at, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)
    return np.minimum(counts, 255).astype(np.int16)


def signatures(counts: np.ndarray) -> np.ndarray:
    """Counts in unary (up to four of a letter), folded into two 64-bit words by parity."""
    bits = sum((counts > k).astype(np.float32) @ _BITS[k] for k in range(_LEVELS))
    odd = np.asarray(bits).astype(np.int64).reshape(len(counts), 128) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.uint64)


@dataclass
class Tree:
    """A k-d tree over count vectors: inner nodes split one letter's count at a threshold."""

    letter: list[int] = field(default_factory=list)
    upto: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)  # the left child follows its parent
    leaf: list[int] = field(default_factory=list)  # number of the leaf, -1 at inner nodes
    members: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def build(cls, vectors: np.ndarray, leaf_size: int) -> Tree:
        tree, open_nodes = cls(), [(np.arange(len(vectors)), -1)]
        while open_nodes:
            rows, parent = open_nodes.pop()
            node = len(tree.leaf)
            if parent >= 0:
                tree.right[parent] = node
            split = cls._split(vectors[rows]) if len(rows) > leaf_size else None
            tree.letter.append(split[0] if split else -1)
            tree.upto.append(split[1] if split else -1)
            tree.right.append(-1)
            tree.leaf.append(-1 if split else len(tree.members))
            if split:
                low = vectors[rows, split[0]] <= split[1]
                open_nodes += [(rows[~low], node), (rows[low], -1)]
            else:
                tree.members.append(rows)
        return tree

    @staticmethod
    def _split(x: np.ndarray) -> tuple[int, int] | None:
        """The most even split among the letters that vary most; None if all rows are equal."""
        spread = x.var(axis=0)
        best = None
        for letter in np.argsort(-spread)[:4]:
            if spread[letter] > 0:
                values, n = np.unique(x[:, letter], return_counts=True)
                below = np.cumsum(n)[:-1]
                k = int(np.argmin(np.abs(2 * below - len(x))))
                uneven = abs(2 * int(below[k]) - len(x))
                if best is None or uneven < best[0]:
                    best = (uneven, int(letter), int(values[k]))
        return best[1:] if best else None

    def reach(
        self, vectors: np.ndarray, over: int, lack: int
    ) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``vectors``) for every box within reach: a query may have at most
        ``over`` letters more and ``lack`` letters less than what the box holds."""
        n = len(vectors)
        lo, hi = np.zeros(LETTERS, np.int16), np.full(LETTERS, 256, np.int16)
        start = (0, np.arange(n), np.zeros(n, np.int16), np.zeros(n, np.int16), lo, hi)
        todo = [start]
        while todo:
            node, rows, more, less, lo, hi = todo.pop()
            if self.leaf[node] >= 0:
                yield self.leaf[node], rows
                continue
            j, upto = self.letter[node], self.upto[node]
            q = vectors[rows, j]
            more_left = more + np.maximum(q - upto, 0) - np.maximum(q - hi[j], 0)
            less_right = less + np.maximum(upto + 1 - q, 0) - np.maximum(lo[j] - q, 0)
            left, right = more_left <= over, less_right <= lack
            if left.any():
                down = hi.copy()
                down[j] = upto
                todo.append((node + 1, rows[left], more_left[left], less[left], lo, down))
            if right.any():
                up = lo.copy()
                up[j] = upto + 1
                todo.append(
                    (self.right[node], rows[right], more[right], less_right[right], up, hi)
                )

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        out = np.zeros(len(vectors), dtype=np.int64)
        for leaf, rows in self.reach(vectors, 0, 0):
            out[rows] = leaf  # a box that holds the vector is the only one without a distance
        return out


#: Bounds (over, lack) by the length of the stored words less that of the query.
BOUNDS = {0: (1, 1), 1: (0, 1), -1: (1, 0)}


@dataclass
class Cells:
    """The top trees: by length group, the tree and the first cell and tiles of every leaf."""

    trees: dict[int, tuple[Tree, np.ndarray, np.ndarray]]
    count: int


def plan_cells(sample: list[str], counts: dict[int, int], per_cell: int) -> Cells:
    """Trees from a sample, with about ``per_cell`` words a leaf, or more beyond ``MAX_CELLS``."""
    per_cell = max(per_cell, -(-sum(counts.values()) // MAX_CELLS))
    groups: dict[int, list[str]] = {g: [] for g in counts}
    for word in sample:
        groups[min(len(word), BAND)].append(word)
    trees, cells = {}, 0
    for g, words in sorted(groups.items()):
        vectors = letter_counts(words) if words else np.zeros((0, LETTERS), np.int16)
        wanted = max(1, -(-counts[g] // per_cell))
        tree = Tree.build(vectors, max(1, len(words) // wanted))
        share = np.array([len(m) for m in tree.members]) / max(1, len(words))
        tiles = np.maximum(1, np.ceil(share * counts[g] / (4 * per_cell))).astype(np.int64)
        first = cells + np.cumsum(tiles) - tiles
        trees[g] = (tree, first, tiles)
        cells += int(tiles.sum())
    return Cells(trees, cells)


def _router(shared):
    schema = pa.schema(
        [("cell", pa.int32()), ("query", pa.bool_()), ("word", pa.string()), ("n", pa.int64())]
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value.trees
        for b in _gathered(batches):
            words = b.column(0).to_pylist()
            group = np.minimum([len(w) for w in words], BAND)
            tile = np.array([zlib.crc32(w.encode()) for w in words])
            vectors = letter_counts(words)
            cells, rows, queries = [], [], []
            for g in np.unique(group):
                own = np.flatnonzero(group == g)
                for step, (over, lack) in BOUNDS.items():
                    if g + step not in trees:
                        continue
                    tree, first, tiles = trees[g + step]
                    if not step:
                        home = tree.home(vectors[own])
                        cells.append(first[home] + tile[own] % tiles[home])
                        rows.append(own)
                        queries.append(np.zeros(len(own), bool))
                    for leaf, hit in tree.reach(vectors[own], over, lack):
                        for k in range(tiles[leaf]):
                            cells.append(np.full(len(hit), first[leaf] + k))
                            rows.append(own[hit])
                            queries.append(np.ones(len(hit), bool))
            rows = np.concatenate(rows)
            cells, queries = np.concatenate(cells), np.concatenate(queries)
            for lo in range(0, len(rows), 1 << 16):
                at = rows[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells[lo : lo + (1 << 16)], pa.int32()),
                        pa.array(queries[lo : lo + (1 << 16)], pa.bool_()),
                        b.column(0).take(pa.array(at)),
                        b.column(1).take(pa.array(at)),
                    ],
                    schema=schema,
                )

    return route


def one_edit(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced letter?"""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def _same_but_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _one_more(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is ``b`` the word ``a`` with one letter more? Rows are padded alike."""
    first = (a != b).argmax(axis=1)
    behind = np.arange(a.shape[1] - 1) >= first[:, None]
    return ~((a[:, :-1] != b[:, 1:]) & behind).any(axis=1)


class Words:
    """Words with what comparing them takes; ``n`` may be left out."""

    def __init__(self, words: list[str], n: list[int] | None = None):
        self.words = words
        self.n = np.array(n if n is not None else [], dtype=np.int64)
        self.counts = letter_counts(words)
        self.bits = signatures(self.counts)
        codes, self.lengths = letter_codes(words)
        self.padded = np.full((len(words), BAND + 2), 255, dtype=np.uint8)
        at = np.arange(len(codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        rows = np.repeat(np.arange(len(words)), self.lengths)
        short = at < BAND + 2
        self.padded[rows[short], at[short]] = codes[short]


def near(q: Words, i: np.ndarray, d: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (q[i], d[j]) differ by one letter?"""
    out = np.zeros(len(i), dtype=bool)
    if not len(i):
        return out
    most = max(int(q.lengths.max()), int(d.lengths.max()))
    width = min(most, BAND) + 2
    a, b = q.padded[:, :width], d.padded[:, :width]
    step = (d.lengths[j] - q.lengths[i]).astype(np.int8) if most < 100 else d.lengths[j] - q.lengths[i]
    short = np.ones(len(i), dtype=bool)
    if most > BAND:
        short = np.maximum(d.lengths[j], q.lengths[i]) <= BAND
        for k in np.flatnonzero(~short & (np.abs(step) <= 1)):
            out[k] = one_edit(q.words[i[k]], d.words[j[k]])
    for value, test in ((0, _same_but_one), (1, _one_more), (-1, lambda x, y: _one_more(y, x))):
        at = np.flatnonzero((step == value) & short)
        if len(at):
            out[at] = test(a[i[at]], b[j[at]])
    return out


def cell_answers(stored: Words, tree: Tree, q: Words) -> tuple[np.ndarray, ...]:
    """(query, neighbours, best stored word) of queries with neighbours among ``stored``, which are
    in code-point order."""
    group = min(int(stored.lengths[0]), BAND)
    step = group - np.minimum(q.lengths, BAND)
    pairs, held, size = [(np.empty(0, np.int64),) * 2], [], 0

    def verified():
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        ok = near(q, i, stored, j)
        held.clear()
        return i[ok], j[ok]

    for value, (over, lack) in BOUNDS.items():
        own = np.flatnonzero(step == value)
        if not len(own):
            continue
        for leaf, hit in tree.reach(q.counts[own], over, lack):
            rows, members = own[hit], tree.members[leaf]
            for lo in range(0, len(members), 256):  # equal vectors may share a large leaf
                some = members[lo : lo + 256]
                apart = np.bitwise_count(q.bits[rows, 0, None] ^ stored.bits[some, 0])
                apart += np.bitwise_count(q.bits[rows, 1, None] ^ stored.bits[some, 1])
                a, b = np.nonzero(apart <= 2)
                held.append((rows[a], some[b]))
                size += len(a)
                if size >= CANDIDATES_AT_ONCE:
                    pairs.append(verified())
                    size = 0
    if held:
        pairs.append(verified())
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.lexsort((j, -stored.n[j], i))
    i, j = i[order], j[order]
    query, first, size = np.unique(i, return_index=True, return_counts=True)
    return query, size, j[first]


ANSWERS = "word string, n_near long, best_n long, best string"


def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by cell, stored words first and in order, then queries."""
    schema = pa.schema(
        [("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
    )
    cell, words, n, ready = None, [], [], None
    for b in _gathered(batches):
        cells = b.column(0).to_numpy()
        query = b.column(1).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(
            np.concatenate([[True], (np.diff(cells) != 0) | (query[1:] != query[:-1])])
        )
        for lo, hi in zip(starts, [*starts[1:], len(cells)], strict=True):
            if cells[lo] != cell:
                cell, words, n, ready = cells[lo], [], [], None
            here = b.column(2).slice(lo, hi - lo)
            if not query[lo]:
                words += here.to_pylist()
                n += b.column(3).slice(lo, hi - lo).to_pylist()
                continue
            if not words:
                continue
            if ready is None:
                stored = Words(words, n)
                ready = stored, Tree.build(stored.counts, LEAF)
            stored, tree = ready
            q, size, best = cell_answers(stored, tree, Words(here.to_pylist()))
            if len(q):
                yield pa.RecordBatch.from_arrays(
                    [
                        here.take(pa.array(q)),
                        pa.array(size, pa.int64()),
                        pa.array(stored.n[best], pa.int64()),
                        pa.array([words[k] for k in best], pa.string()),
                    ],
                    schema=schema,
                )


def neighbours(words: DataFrame, per_cell: int = PER_CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, best_n, best) of a table of distinct words with counts: how many words are
    one letter away, and the one with the largest count."""
    spark = words.sparkSession
    group = F.least(F.length("word"), F.lit(BAND))
    counts = {r["g"]: r["n"] for r in words.groupBy(group.alias("g")).agg(F.count("*").alias("n")).collect()}
    every = max(1, -(-sum(counts.values()) // sample))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect()
    cells = plan_cells(sorted(r["word"] for r in some), counts, per_cell)
    shared = spark.sparkContext.broadcast(cells)
    routed = words.select("word", "n").mapInArrow(
        _router(shared), "cell int, query boolean, word string, n long"
    )
    found = (
        routed.repartition("cell")
        .sortWithinPartitions("cell", "query", "word")
        .mapInArrow(_searcher, ANSWERS)
    )
    none = F.lit(None)
    all_words = words.select(
        "word",
        "n",
        F.lit(0).cast("long").alias("n_near"),
        none.cast("long").alias("best_n"),
        none.cast("string").alias("best"),
    )
    rows = all_words.unionByName(found.withColumn("n", none.cast("long")))
    best = F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("word"))
    return (
        rows.groupBy("word")
        .agg(
            F.max("n").alias("n"),
            F.sum("n_near").alias("n_near"),
            F.min(F.when(F.col("best").isNotNull(), best)).alias("found"),
        )
        .select(
            "word",
            "n",
            "n_near",
            (-F.col("found.order")).alias("best_n"),
            F.col("found.word").alias("best"),
        )
    )


def follow(links: DataFrame, steps: int) -> DataFrame:
    """(word, root): the end of the chain of (word, form) that each word is on, for chains of at
    most ``steps`` links."""
    roots = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = materialize(
            roots.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ),
            "variants-roots",
        )
    return roots


def spelling_variants(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    factor: int = 10,
    misspelt: int = 31,
    per_cell: int = PER_CELL,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root. The form of a word is its neighbour
    of largest count, if that is at least ``factor`` times its own (``factor`` above 1)."""
    words = materialize(word_counts(docs, least_length, least_count, misspelt), "variants-words")
    has_form = F.col("best_n") >= F.col("n") * factor
    table = materialize(
        neighbours(words, per_cell).select(
            "word",
            "n",
            "n_near",
            F.when(has_form, F.col("best")).alias("form"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    links = table.where("form is not null").select("word", "form")
    most = table.agg(F.max("n")).first()[0] or least_count
    steps = math.ceil(math.log(max(most / least_count, 1), factor)) + 1
    return table.join(follow(links, steps), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )
