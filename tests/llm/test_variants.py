from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from tidecast.llm import queries
from tidecast.llm.variants import (
    BAND,
    BOUNDS,
    Tree,
    Words,
    follow,
    letter_counts,
    near,
    neighbours,
    one_edit,
    plan_cells,
    signatures,
    spelling_variants,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, misspelt=31, least=7, twice=2) -> dict[str, int]:
    counts = Counter()
    for k, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % misspelt == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= twice}


def plain_near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows, factor=10, **kw) -> list[tuple]:
    counts = plain_counts(rows, **kw)
    found = {}
    for w, n in counts.items():
        other = [v for v in counts if plain_near(w, v)]
        best = min(other, key=lambda v: (-counts[v], v), default=None)
        has = best is not None and counts[best] >= factor * n
        found[w] = (n, len(other), best if has else None, counts[best] if has else None)
    out = []
    for w, row in found.items():
        root = w
        while found[root][2]:
            root = found[root][2]
        out.append((w, *row, root))
    return sorted(out)


def fixture(seed: int) -> list:
    rng = random.Random(seed)
    bases = ["".join(rng.choices("abcdeéÀ×", k=rng.randint(7, 11))) for _ in range(40)]
    words = []
    for base in bases:
        words += [base] * rng.choice([2, 30, 300])
        for _ in range(6):
            k = rng.randrange(len(base))
            c = rng.choice("abcdeéz")
            other = rng.choice([base[:k] + c + base[k + 1 :], base[:k] + base[k + 1 :], base[:k] + c + base[k:]])
            words += [other] * rng.randint(1, 4)
    words += ["Short", "it", "LONGWORD", "longword", "ÉLONGWORD", "élongword"] * 3
    words += ["x" * 60, "x" * 60, "x" * 61, "x" * 61, "x" * 59 + "y", "x" * 59 + "y", "q" * 300, "q" * 300, "q" * 301, "q" * 301]
    words += ["abcdefgh"[i:] + "abcdefgh"[:i] for i in range(8)] * 2  # one vector, different orders
    rng.shuffle(words)
    rows = [(k, " ".join(words[k * 9 : k * 9 + 9])) for k in range(len(words) // 9 + 1)]
    return rows + [(-1, None), (-2, ""), (None, "nullword nullword"), (5, "twinrow"), (5, "twinrow")]


def test_against_brute_force(spark, documents):
    for seed, per_cell in ((1, 4096), (2, 8)):
        rows = fixture(seed)
        got = spelling_variants(documents(rows, word="w", n=1, cell=2), per_cell=per_cell).collect()
        assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in got) == brute(rows)


def test_equals_its_sql(spark, documents, tmp_path):
    rows = [(k, t) for k, t in fixture(3) if k is not None]
    documents(rows).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op12_spelling_variants"])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_one_vector_over_many_tiles(spark):
    """Anagrams cannot be parted by counts: their leaf is dealt over tiles, nothing is lost."""
    rng = random.Random(8)
    words = sorted({"".join(rng.sample("aabbccdde", 9)) for _ in range(900)} | {"aabbccddea", "aabbccdd"})
    cells = plan_cells(words, Counter(len(w) for w in words), 16)
    assert max(int(t.max()) for _, _, t in cells.trees.values()) > 1
    df = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in neighbours(df, per_cell=16).collect()}
    for w in words:
        other = [v for v in words if plain_near(w, v)]
        best = max(other, key=words.index, default=None)
        assert got[w] == (len(other), best)


def test_reach_loses_no_neighbour():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcé", k=rng.randint(7, 9))) for _ in range(1500)})
    by_length = {n: [w for w in words if len(w) == n] for n in (7, 8, 9)}
    tests = skipped = 0
    for n, stored in by_length.items():
        tree = Tree.build(letter_counts(stored), 16)
        assert sorted(np.concatenate(tree.members)) == list(range(len(stored)))
        assert all(k in tree.members[leaf] for k, leaf in enumerate(tree.home(letter_counts(stored))))
        for step, (over, lack) in BOUNDS.items():
            asking = by_length.get(n - step, [])
            seen = {(int(q), int(d)) for leaf, rows in tree.reach(letter_counts(asking), over, lack) for q in rows for d in tree.members[leaf]}
            for i, a in enumerate(asking):
                for j, b in enumerate(stored):
                    if plain_near(a, b):
                        assert (i, j) in seen
                        tests += 1
            skipped += len(asking) * len(stored) - len(seen)
    assert tests > 100 and skipped > 100_000


def test_comparisons_agree():
    rng = random.Random(5)
    words = ["".join(rng.choices("abé", k=rng.randint(BAND - 2, BAND + 2))) for _ in range(5)]
    words += ["".join(rng.choices("abé", k=rng.randint(1, 5))) for _ in range(150)]
    words += [w[:k] + w[k + 1 :] for w in words[:5] for k in (0, 20, 45)]
    w = Words(words)
    i, j = (x.ravel() for x in np.meshgrid(*[np.arange(len(words))] * 2))
    want = np.array([plain_near(words[a], words[b]) for a, b in zip(i, j, strict=True)])
    assert (near(w, i, w, j) == want).all()
    assert [one_edit(words[a], words[b]) for a, b in zip(i, j, strict=True)] == want.tolist()
    bits = signatures(letter_counts(words))
    apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1)
    assert (apart[want] <= 2).all()


def test_chains_and_empty_table(spark, documents):
    links = spark.createDataFrame([(str(k), str(k + 1)) for k in range(9)], "word string, form string")
    assert {r.root for r in follow(links, 9).collect()} == {"9"}
    assert follow(links.limit(0), 1).count() == 0
    assert spelling_variants(documents([])).count() == 0
    assert spelling_variants(documents(["one two", None])).count() == 0
