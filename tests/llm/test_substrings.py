from __future__ import annotations

import hashlib
import random

from tidecast.llm.substrings import merged_spans, without_repeats


def brute(texts: list[str | None], length: int) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raws:
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for k, b in enumerate(raws):
        covered = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                covered[s : s + length] = b"\1" * length
        spans = sum(covered[i] and not (i and covered[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        out.append((k, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))


def fixture(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    base = prose(rng, 60)
    texts: list[str | None] = [None, "", "short", base, base, prose(rng, 80)]
    passage = prose(rng, 12)
    for _ in range(40):  # near copies, and one passage in many contexts
        words = base.split()
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = "X" * rng.randint(1, 9)
        texts.append(" ".join(words))
        texts.append(prose(rng, rng.randint(0, 6)) + passage[rng.randint(0, 5) :] + prose(rng, 5))
    texts += ["ab" * 120, "ab" * 70 + "c" + "ab" * 70, "a" * 300, "a" * 79, "a" * 80]
    texts.append(prose(rng, 20) + base[10:200] + prose(rng, 20) + base[10:200])
    texts.append("é" * 200)
    return texts


def test_against_brute_force(spark, documents):
    for seed in (1, 2):
        texts = fixture(seed)
        got = without_repeats(documents(texts), length=80, per_bucket=40)
        assert sorted(map(tuple, got.collect())) == brute(texts, 80)


def test_repeated_ids_extra_columns_and_empty_table(spark, documents):
    text = "x y " * 60
    df = documents([(1, text), (1, text), (None, "unlike " * 5)], size=3, tid="t", digest="d")
    rows = without_repeats(df, length=80).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in rows) == [
        (0, 0, 0),
        (1, len(text), 1),
        (1, len(text), 1),
    ]
    assert without_repeats(documents([]), length=80).count() == 0


def test_merged_spans():
    assert merged_spans([(5, 2), (0, 1), (40, 1)], 10) == [(0, 16), (40, 50)]
    assert merged_spans([(0, 1), (10, 1)], 10) == [(0, 20)]
