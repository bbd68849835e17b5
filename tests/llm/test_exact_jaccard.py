from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np

from tidecast.llm import jaccard
from tidecast.llm.components import components
from tidecast.llm.exact import drop_exact_copies, exact_groups
from tidecast.llm.jaccard import (
    Repeats,
    _Places,
    drop_near_copies,
    list_pairs,
    near_components,
    prefix_length,
    word_hashes,
)


def lowered(text):
    return (text or "").encode().lower()


def test_exact_groups_match_a_plain_grouping(spark, documents):
    rng = random.Random(5)
    texts = [rng.choice(["Ab c", "ab C", "É x", "é x", "", None]) for _ in range(60)]
    texts += [f"only {k}" for k in range(500)] + ["long " * 30_000] * 2
    df = documents(texts, digest="d", row=1, again=True, size=2)
    got = {r.doc_id: r for r in exact_groups(df).collect()}
    groups: dict[bytes, list[int]] = {}
    for k, t in enumerate(texts):
        groups.setdefault(lowered(t), []).append(k)
    for same in groups.values():
        for k in same:
            r = got[k]
            assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), k == max(same))
            assert r.text_sha256 == hashlib.sha256(lowered(texts[k])).hexdigest()
    assert sorted(r.doc_id for r in drop_exact_copies(df).collect()) == sorted(
        max(s) for s in groups.values()
    )
    assert drop_exact_copies(df).columns == df.columns


def test_exact_stays_right_when_the_filter_is_full(spark, documents):
    texts = [f"text {k % 700}" for k in range(1000)]
    got = exact_groups(documents(texts), bits_per_row=1, max_bits=1).collect()
    assert sum(r.kept for r in got) == 700


def test_exact_with_repeated_and_null_ids(spark, documents):
    df = documents([(1, "A"), (1, "a"), (None, "a"), (None, "b"), (2, None), (3, "")])
    got = exact_groups(df).collect()
    assert sum(r.kept for r in got if r.text_sha256 == hashlib.sha256(b"a").hexdigest()) == 1
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in drop_exact_copies(df).collect())
    assert kept == [(False, 1), (False, 3), (True, 0)]
    assert exact_groups(documents([])).count() == 0
    assert drop_exact_copies(documents([])).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(1, 60)]
    star = [(100, 100 + k) for k in range(1, 40)] + [(139, 100), (139, 139)]
    rows = spark.createDataFrame(path + star, "u long, v long")
    got = {r.node: r.component for r in components(rows).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 140)}
    assert components(rows.where("u < 0")).count() == 0


def shingle_set(text, words):
    w = lowered(text).split()
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def brute(texts, words, percent):
    sets = [shingle_set(t, words) for t in texts]
    low = list(range(len(texts)))
    linked = True
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(texts)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while linked:
        linked = False
        for a, b in pairs:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                linked = True
    return [(k, len(s), low[k]) for k, s in enumerate(sets)]


def near_fixture(seed: int):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdef", k=4)) for _ in range(300)]
    line = " ".join(rng.choices(vocabulary, k=12))
    texts = [None, "", "  \t\n ", "one", "ONE", "one two", "one two x", "a b c"]
    for _ in range(5):
        base = rng.choices(vocabulary, k=rng.randint(60, 200))
        texts += [" ".join(base)] * 2
        for _ in range(14):  # from links to just no links
            words = list(base)
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words[: len(words) - rng.randint(0, 8)]))
    texts += [f"{line} " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(60)]
    return texts


def test_near_components_against_all_pairs(spark, documents):
    texts = near_fixture(11)
    df = documents(texts, sid=1, star=2, kind=1)
    for words, percent in ((3, 90), (5, 80)):
        got = sorted(map(tuple, near_components(df, words, percent).collect()))
        assert got == brute(texts, words, percent)
    kept = {r.doc_id for r in drop_near_copies(df, 5, 80).collect()}
    assert kept == {k for k, _, low in brute(texts, 5, 80) if k == low}
    assert drop_near_copies(df, 5, 80).columns == df.columns
    assert near_components(documents([])).count() == 0


def test_lists_lose_no_pair(monkeypatch):
    """Small lists, blocks and tiles of frequent tokens find every similar pair of sets."""
    rng = np.random.default_rng(4)
    base = np.sort(rng.choice(5000, 60, replace=False))
    sets = []
    for _ in range(400):
        s = set(base.tolist())
        for x in rng.choice(base, rng.integers(0, 5), replace=False):
            s.discard(int(x))
        s |= {int(x) for x in rng.integers(5000, 5400, rng.integers(0, 4))}
        sets.append(np.array(sorted(s, key=lambda t: (t < 5000, t))))
    sets = list({tuple(s): s for s in sets}.values())
    for tiles in (False, True):
        rows = []
        for sid, s in enumerate(sets):
            prefix = s[: prefix_length(len(s), 90)].tolist()
            for place, token in enumerate(prefix):
                before = prefix[place - 1] if place else -1 - sid
                own = sid % jaccard.TILES
                for other in range(jaccard.TILES) if tiles else [None]:
                    tile = 0 if other is None else 1 + min(own, other) * jaccard.TILES + max(own, other)
                    rows.append((token, tile, len(s), sid, place, before))
        rows.sort()
        token, tile, n, sid, place, before = (np.array(c) for c in zip(*rows, strict=True))
        found = {tuple(p) for p in list_pairs(90, token, tile, sid, n, place, sid, before).tolist()}
        want = {
            (a, b)
            for a, b in itertools.combinations(range(len(sets)), 2)
            if 100 * (both := len(set(sets[a]) & set(sets[b])))
            >= 90 * (len(sets[a]) + len(sets[b]) - both)
        }
        assert want <= found and want


def test_repeats_of_a_stretch():
    rng = np.random.default_rng(3)
    for n, size in ((0, 8), (1, 8), (8, 8), (500, 1000), (3000, 1000)):
        x = rng.integers(0, 300, n).astype(np.uint64)
        held = Repeats(size)
        assert held.add(x)
        tokens, counts = held.take()
        values, times = np.unique(x, return_counts=True)
        assert tokens.tolist() == values[times > 1].tolist() and counts.tolist() == times[times > 1].tolist()
        assert held.size == 0
    held = Repeats(4)
    assert held.add(np.array([1, 1], np.uint64)) and not held.add(np.array([1, 2, 3], np.uint64))
    assert held.take()[1].tolist() == [2] and held.add(np.array([1, 2, 3], np.uint64))


def test_word_hashes_do_not_depend_on_blocks():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcXYZé", k=rng.randint(1, 9))) for _ in range(30_000)] + ["w" * 200_000, "end"]
    text = " ".join(words) + "\n\t x"
    whole = word_hashes(text.encode(), _Places())
    alone = {w: int(word_hashes(w.encode(), _Places())[0]) for w in {*words, "x"}}
    assert whole.tolist() == [alone[w] for w in [*words, "x"]]
    assert len(set(alone.values())) == len({w.encode().lower() for w in alone})
    assert len(word_hashes(b"", _Places())) == len(word_hashes(b" \n\x0b ", _Places())) == 0
